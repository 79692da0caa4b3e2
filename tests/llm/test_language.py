import re
from collections import Counter

from pyspark.sql import functions as F

from parcelry.llm import language


def grams(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    padded = " " + " ".join(words) + " " if words else ""
    found = Counter(padded[i : i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1))
    return {g: n for g, n in found.items() if g.strip() and not (len(g) == 3 and g[1] == " ")}


def spelled(code):
    out = ""
    while code:
        out, code = chr(code & (1 << 21) - 1) + out, code >> 21
    return out


def ranked(counts, size):
    order = sorted(counts, key=lambda g: (-counts[g], [ord(c) for c in g]))
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return sorted(order, key=lambda g: (-counts[g], code(g)))[:size]


def test_counts_of_n_grams():
    texts = ["Hello, wörld! ab", "", "123 !!", "a b  c", "ß漢 字x", "x", "Ünï-cödé x"]
    text, gram, count = language._grams(texts)
    found = {}
    for t, g, n in zip(text.tolist(), gram.tolist(), count.tolist()):
        found.setdefault(t, {})[spelled(g)] = n
    assert [found.get(i, {}) for i in range(len(texts))] == [grams(t) for t in texts]


def test_out_of_place_distance_against_brute_force(spark):
    learn = [("the cat and the dog", "en"), ("the end of this thing", "en"), ("der hund und die katze", "de"), ("das ende von allem", "de"), (None, "de"), ("no language", None)]
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(learn)], "doc_id long, text string, lang string")
    asked = ["the dog", "der hund", "und das", "", None, "42", "qqq"]
    table = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    size = 20
    profiles = {}
    for lang in ("en", "de"):
        total = Counter()
        for t, x in learn:
            if t and x == lang:
                total.update(grams(t))
        profiles[lang] = ranked(total, size)
    found = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language.predict(table, "doc_id", language.learn(docs, size), size).collect()}
    for i, text in enumerate(asked):
        own = ranked(grams(text or ""), size)
        if not own:
            assert found[i] == ("und", 0.0)
            continue
        far = {x: sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(own)) for x, p in profiles.items()}
        best = min(far, key=lambda x: (far[x], x))
        assert found[i] == (best, round(1 - far[best] / (len(own) * size), 9))


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.lit("xx"))
    found = language.identify(docs, F.lit(True)).collect()
    assert len(found) == docs.count()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add(r.lang_pred)
    assert by[1] == by[2] == by[5] == by[9] == {"und"} and by[6] == {"xx"}
    assert {r.lang_pred for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(no_docs.withColumn("lang", F.lit("xx")), F.lit(True)).collect() == []


def test_marks_alone_are_no_letters_and_all_planes_count(spark):
    learn = spark.createDataFrame([(1, "the cat \U00030005", "en"), (2, "die katze", "de")], "doc_id long, text string, lang string")
    profiles = language.learn(learn)
    asked = ["\u0301\u0308", "a\u0301", "\U00030005", "\U0001F600", None]
    table = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(table, "doc_id", profiles).collect()}
    assert found[0] == found[3] == found[4] == ("und", 0.0)
    assert found[1][0] != "und" and found[2][0] == "en" and found[2][1] > 0


def test_equal_distances_go_to_the_language_that_sorts_first(spark):
    learn = spark.createDataFrame([(1, "same words", "xx"), (2, "same words", "aa")], "doc_id long, text string, lang string")
    table = spark.createDataFrame([(1, "same"), (2, "zzz")], "doc_id long, text string")
    found = language.predict(table, "doc_id", language.learn(learn)).collect()
    assert {r["lang_pred"] for r in found} == {"aa"}


def test_profiles_are_limited_before_the_last_sort(spark):
    learn = spark.createDataFrame([(1, "same words", "xx")], "doc_id long, text string, lang string")
    assert "WindowGroupLimit" in language.learn(learn)._jdf.queryExecution().executedPlan().toString()
