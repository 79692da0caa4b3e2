"""DuckDB SQL of repeated bytes and words, the trie, the secrets and the fill-in-the-middle forms."""

from __future__ import annotations

from parcelry.llm import secrets

#: Every byte's 200-byte string by its digest; starts that overlap or touch join to spans, and what lies between is kept.
BYTES_SQL = """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents
), starts AS (
    SELECT r, unnest(runs) AS run, generate_subscripts(runs, 1) - 1 AS p
    FROM (SELECT r, list_transform(range(greatest(octet_length(b) - 199, 0)), lambda p: md5(b[p + 1 : p + 200])) AS runs FROM d)
), again AS (
    SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY run) AS n FROM starts) WHERE n > 1
), marked AS (
    SELECT r, p, coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p) > 200, true)::INT AS fresh FROM again
), spans AS (
    SELECT r, min(p) AS first, max(p) + 200 AS last FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS span FROM marked) GROUP BY r, span
), edges AS (
    SELECT r, first, last FROM spans UNION ALL SELECT r, octet_length(b), NULL FROM d
), kept AS (
    SELECT r, first, last, coalesce(lag(last) OVER (PARTITION BY r ORDER BY first, last NULLS LAST), 0) AS begin FROM edges
)
SELECT doc_id, octet_length(any_value(b)) AS n_bytes, coalesce(sum(last - first), 0)::BIGINT AS n_removed, count(last) AS n_spans,
    sha256(unhex(string_agg(hex(b[begin + 1 : first]), '' ORDER BY first, last NULLS LAST))) AS kept_sha256
FROM kept JOIN d USING (r) GROUP BY doc_id, r
"""

#: Every window of 20 words as text; all but its first place cover the words that go.
WORDS_SQL = """
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x09-\\x0D ]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
    SELECT doc_id, unnest(runs) AS run, generate_subscripts(runs, 1) AS p
    FROM (SELECT doc_id, list_transform(range(greatest(len(w) - 19, 0)), lambda p: array_to_string(w[p + 1 : p + 20], ' ')) AS runs FROM d)
), later AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

#: CRC-32 bit by bit: each byte goes in by XOR and is followed by eight shifts.
_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split({text}, ''),
    lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])))::BIGINT[],
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295)"""

TRIE_SQL = f"""
WITH own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 20 AS base, {_CRC32.format(text="c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM own)
), joined AS (
    SELECT v.c, 0 AS own, o.t, role, text FROM convs v JOIN own o ON o.c = v.base WHERE o.t <= v.h
    UNION ALL SELECT v.c, 1, o.t, role, text FROM convs v JOIN own o ON o.c = v.c WHERE o.t > v.h
), turns AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, t) AS depth FROM joined
), paths AS (
    SELECT c, depth, text, list([role, text]) OVER (PARTITION BY c ORDER BY depth) AS path FROM turns
    UNION ALL SELECT c, 0, '', [] FROM convs
), passed AS (
    SELECT c, depth, text, min(c) OVER (PARTITION BY depth, path) AS node, max(depth) OVER (PARTITION BY c) AS size FROM paths
), nodes AS (
    SELECT node, depth, count(*) AS n_convs, any_value(len(list_filter(string_split_regex(text, '[\\x09-\\x0D ]+'), lambda x: x <> ''))) AS words,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = depth), '')) AS ends_sha256
    FROM passed GROUP BY node, depth
), edges AS (
    SELECT n.*, p.node AS up FROM nodes n LEFT JOIN passed p ON p.c = n.node AND p.depth = n.depth - 1
), children AS (
    SELECT up, depth - 1 AS depth, count(*) AS n FROM edges WHERE up IS NOT NULL GROUP BY ALL
), valued AS (
    SELECT e.*, coalesce(k.n, 0) AS n_children FROM edges e LEFT JOIN children k ON k.up = e.node AND k.depth = e.depth
), totals AS (
    SELECT p.node, p.depth, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.words)::BIGINT AS saved_tokens
    FROM valued v JOIN passed p ON p.c = v.node AND p.depth <= v.depth GROUP BY ALL
)
SELECT node AS conv_id, depth, up AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM valued JOIN totals USING (node, depth)
"""


def _spans_of(rank: int, rule: secrets.Rule) -> str:
    """Matches of one rule: the text is cut before each match, and lengths add up to places."""
    pattern = ("(?i)" if rule.either_case else "") + rule.pattern.replace("'", "''")
    marked = f"regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(2), 'g')"
    value = f"length(regexp_extract(split_part(part, chr(2), 1), '{pattern}', 2))" if rule.least_value else "0"
    return f"""
    SELECT r, {rank} AS rank, '{rule.kind}' AS kind, first, first + size AS last FROM (
        SELECT r, i, length(split_part(part, chr(2), 1)) AS size, {value} AS own,
            sum(length(replace(part, chr(2), ''))) OVER (PARTITION BY r ORDER BY i) - length(replace(part, chr(2), '')) AS first
        FROM (SELECT r, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (SELECT r, string_split({marked}, chr(1)) AS parts FROM d))
    ) WHERE i > 1 AND size >= {rule.least} AND own >= {rule.least_value}"""


_BASE = ", ".join(f"'{r.kind}'" for r in secrets.BASE)
SECRETS_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents
), s AS ({" UNION ALL ".join(_spans_of(i, r) for i, r in enumerate(secrets.RULES))}
), listed AS (
    SELECT r, *EXCLUDE r FROM (SELECT r,
        {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)},
        string_agg(kind || ':' || first::BIGINT || ':' || last::BIGINT, ',' ORDER BY first, rank) FILTER (kind IN ({_BASE})) AS base,
        string_agg(kind || ':' || first::BIGINT || ':' || last::BIGINT, ',' ORDER BY first, rank) AS spans
    FROM s GROUP BY r)
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""


def _eight(group: int) -> str:
    """An 8-digit group of the hex digest `h` as a number."""
    return f"list_sum(list_transform(range(8), lambda i: (strpos('0123456789abcdef', substr(h, {8 * group + 1} + i, 1)) - 1) * (16 ** (7 - i))::BIGINT))::BIGINT"


INFILL_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), c AS (
    SELECT doc_id, t, u, {", ".join(f"{_eight(k)} AS h{k + 1}" for k in range(4))} FROM d
), f AS (
    SELECT doc_id, t, len(u) AS n, array_to_string(u[1 : least(h1 % (len(u) + 1), h2 % (len(u) + 1))], '') AS p,
        array_to_string(u[least(h1 % (len(u) + 1), h2 % (len(u) + 1)) + 1 : greatest(h1 % (len(u) + 1), h2 % (len(u) + 1))], '') AS m,
        array_to_string(u[greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) + 1 : len(u)], '') AS s,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
            WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM f
"""
