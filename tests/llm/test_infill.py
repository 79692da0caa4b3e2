"""Fill-in-the-middle forms against plain string slices, and their way back."""

import hashlib
import random
import re

from parcelry.llm import infill


def brute(key, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(lines)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def made():
    draw = random.Random(4)
    signs = ["a", "é\n", "\n", "<", "P>", "<S", ">", "漢字", " ", "\r\n", "M", "x" * 50]
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    return [*texts, "", None, "\n", "no break", "one\n", "<P>", "a<M>b\n", "<", "<<S", "long\n" * 40_000, "y" * 200_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_against_slices(make_docs):
    texts = made()
    docs = make_docs(texts)
    rows = {r.doc_id: r for r in infill.digests(docs).collect()}
    forms = {r.doc_id: r for r in infill.restore(infill.transform(docs)).collect()}
    for i, text in enumerate(texts):
        n, form, prefix, middle, output = brute(i, text)
        r, t = rows[i], forms[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(text or ""))
        assert (t.form, t.output, t.restored) == (form, output, text or "")
        buffers = [(text or "").encode(), b"<P><S><M>"]
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in t.pieces).decode() == output
    assert {r.form for r in rows.values()} == {"plain", "psm", "spm"}


def test_rates(make_docs):
    docs = make_docs([f"a\nb{i}\n" for i in range(50)])
    plain = infill.digests(docs, options=infill.Options(rate=0)).collect()
    assert {r.form for r in plain} == {"plain"} and all(r.output_sha256 == r.restored_sha256 for r in plain)
    assert {r.form for r in infill.digests(docs, options=infill.Options(spm_rate=0)).collect()} == {"psm"}
    other = infill.digests(docs, options=infill.Options(seed=8)).collect()
    assert [r.output_sha256 for r in other] != [r.output_sha256 for r in infill.digests(docs).collect()]


def test_cuts_split_descriptors():
    table = infill.PieceTable({0: memoryview(b"abcdef")}, [infill.Piece(0, 0, 4), infill.Piece(0, 4, 2)])
    assert [bytes(p) for p in table.cut(0, 2, 2, 6).parts()] == [b"", b"ab", b"", b"cd", b"ef", b""]
    assert table.cut(4).permuted([2, 0]).bytes() == b"efabcd" and table.digest() == sha("abcdef")


def test_odd_rows(odd_docs, no_docs):
    found = infill.digests(odd_docs)
    assert set(found.columns) >= set(odd_docs.columns) and found.columns.count("n") == 1
    for r in found.collect():
        n, form, prefix, middle, output = brute(r.doc_id, r.text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, prefix, middle, sha(output), sha(r.text or ""))
        assert r.row == "row" and r.key == "key"
    assert infill.digests(no_docs).collect() == [] and infill.restore(infill.transform(no_docs)).collect() == []
