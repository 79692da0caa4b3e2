"""The operators over the given tables. Each callable takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.llm import (
    decontaminate,
    infill,
    language,
    licenses,
    nearcopies,
    parsing,
    pieces,
    prefix_trie,
    quality,
    secrets,
    substrings,
    suffixes,
    toxicity,
)
from parcelry.llm.common import crc_mod, table
from parcelry.llm.oracles import BYTES_SQL, INFILL_SQL, SECRETS_SQL, TRIE_SQL, WORDS_SQL


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    found = language.identify(docs, F.coalesce(~held_out, F.lit(False)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.compare_edited(table(spark, folder, "documents"))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Each document that holds a license notice, with the notice and how much of it."""
    found = licenses.scan(table(spark, folder, "documents"), licenses.templates(spark))
    return found.select("doc_id", "template", F.round("containment", 6).alias("containment"))


def _classified(spark, folder, model, label, threshold):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    weights = model.fit(docs, labels, label, ~held_out)
    return model.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder, quality, "quality", 0.3)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Each document that holds a benchmark item, with the item and how much of it."""
    found = decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.round("containment", 6).alias("containment"))


def op8_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """The group of near copies of every document."""
    return nearcopies.groups(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder, toxicity, "toxic", 0.5)


def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each text's sampled pieces and of what they decode to."""
    vocabulary = pieces.read_vocabulary(pieces.MODEL)
    encoded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), vocabulary)
    decoded = pieces.decode(encoded, vocabulary)
    return decoded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.trie(table(spark, folder, "conversations"))


def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Number, digest and list of each document's secrets."""
    found = secrets.find(table(spark, folder, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(kinds))

    counts = [F.size(of([kind])).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select("doc_id", *counts, F.sha2(listed(of(base)), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Form, cuts and digests of each document's fill-in-the-middle form and of the text restored from it."""
    found = infill.digests(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_suffixes,
        op3_substrings,
        op4_fingerprints,
        op5_licenses,
        op6_quality,
        op7_decontamination,
        op8_near_copies,
        op9_toxicity,
        op10_pieces,
        op11_prefix_trie,
        op12_secrets,
        op13_fill_in_middle,
    )
}
#: The share of an item's distinct shingles of five words that stand anywhere in a document; a shorter item is one
#: shingle of all its words.
_CONTAINMENT_SQL = """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, {words} AS w
    FROM documents WHERE text IS NOT NULL
), i AS (
    SELECT {item}, row_number() OVER () AS i, {words} AS w
    FROM {items} WHERE text IS NOT NULL AND {item} IS NOT NULL
), ig AS (
    SELECT DISTINCT {item}, i, least(len(w), 5) AS k, unnest(list_transform(range(greatest(len(w) - 4, 1)), lambda p: array_to_string(w[p + 1 : p + 5], ' '))) AS g
    FROM i WHERE len(w) > 0
), sized AS (
    SELECT *, count(*) OVER (PARTITION BY i) AS size_of FROM ig
), dg AS (
    SELECT DISTINCT doc_id, r, k, unnest(list_transform(range(greatest(len(w) - k + 1, 0)), lambda p: array_to_string(w[p + 1 : p + k], ' '))) AS g
    FROM d, (SELECT DISTINCT k FROM ig)
), share AS (
    SELECT doc_id, r, {item}, i, count(*) / any_value(size_of) AS part FROM dg JOIN sized USING (k, g) GROUP BY ALL
)
SELECT doc_id, {item}, round(part, 6) AS containment FROM share WHERE part >= 0.8
"""
DECONTAMINATION_SQL = _CONTAINMENT_SQL.format(
    item="item_id", items="benchmark", words=r"list_filter(string_split_regex(lower(text), '[\x09-\x0D ]+'), lambda x: x <> '')"
)
_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(*(v.replace("'", "''") for v in row)) for row in licenses.TEMPLATES)
LICENSES_SQL = _CONTAINMENT_SQL.format(
    item="template",
    items=f"(VALUES {_TEMPLATE_ROWS}) AS t(template, text)",
    words=r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')",
)

ORACLE: dict[str, str] = {
    "op2_suffixes": BYTES_SQL,
    "op3_substrings": WORDS_SQL,
    "op5_licenses": LICENSES_SQL,
    "op7_decontamination": DECONTAMINATION_SQL,
    "op11_prefix_trie": TRIE_SQL,
    "op12_secrets": SECRETS_SQL,
    "op13_fill_in_middle": INFILL_SQL,
}
