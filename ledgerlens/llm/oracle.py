"""The queries of the corpus operators as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_VECTORS = """
ints AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT rid, p, list_slice(c, p * (len(c) // 8) + 1, (p + 1) * (len(c) // 8)) AS v
  FROM ints, range(8) AS position(p)),
seeds AS (
  SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, c) - 1 AS e FROM ints),
book0 AS MATERIALIZED (
  SELECT p, e, v FROM seeds JOIN parts USING (rid) WHERE e < 16)"""

_SQUARES = "list_sum(list_transform(list_zip(parts.v, book.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _assigned(name: str, book: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT rid, p, v, e, d FROM (
    SELECT rid, parts.p, parts.v, e, {_SQUARES} AS d,
      row_number() OVER (PARTITION BY rid, parts.p ORDER BY {_SQUARES}, e) AS place
    FROM parts JOIN {book} AS book ON parts.p = book.p)
  WHERE place = 1)"""


def _updated(name: str, book: str, assigned: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  WITH numbers AS (SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {assigned}),
  sums AS (SELECT p, e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM numbers GROUP BY p, e, i),
  means AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM sums GROUP BY p, e)
  SELECT book.p, book.e, coalesce(means.v, book.v) AS v
  FROM {book} AS book LEFT JOIN means ON book.p = means.p AND book.e = means.e)"""


def vector_codes(rounds: int = 6) -> str:
    steps = [_VECTORS]
    for at in range(rounds):
        steps.append(_assigned(f"near{at}", f"book{at}"))
        steps.append(_updated(f"book{at + 1}", f"book{at}", f"near{at}"))
    steps.append(_assigned("final", f"book{rounds}"))
    steps.append("""
coded AS MATERIALIZED (
  SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM final GROUP BY rid)""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, code, error,
  CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM ints JOIN coded USING (rid)"""


# The CRC of a text of ASCII characters, bit by bit from its reflected polynomial.
_CRC = """xor(list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
  lambda crc, code: list_reduce(
    list_prepend(xor(crc, code), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda v, step: xor(v >> 1, (v & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""

CONVERSATION_TRIE = f"""
WITH turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
plans AS MATERIALIZED (
  SELECT conv_id, {_CRC} % 4 AS h, conv_id - conv_id % 20 AS family
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
  SELECT plans.conv_id, place AS depth, role, text
  FROM plans JOIN turns ON turns.conv_id = family AND place <= h),
taken AS (SELECT conv_id, count(*) AS n FROM heads GROUP BY conv_id),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT conv_id, place - h + coalesce(n, 0), role, text
  FROM turns JOIN plans USING (conv_id) LEFT JOIN taken USING (conv_id) WHERE place > h),
paths AS MATERIALIZED (
  SELECT conv_id, coalesce(path, []) AS path FROM plans LEFT JOIN (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY depth) AS path
    FROM rebuilt GROUP BY conv_id) USING (conv_id)),
prefixes AS (
  SELECT conv_id, depth, path[1:depth] AS node, depth = len(path) AS is_end
  FROM (SELECT *, unnest(range(len(path) + 1)) AS depth FROM paths)),
nodes AS MATERIALIZED (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN is_end THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), ''))
      AS ends_sha256,
    CASE WHEN depth = 0 THEN 0
      ELSE (count(*) - 1) * len(regexp_extract_all(node[depth].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM prefixes GROUP BY node, depth),
children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS MATERIALIZED (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
subtrees AS (
  SELECT node[1:up] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted) GROUP BY ALL)
SELECT counted.conv_id, counted.depth, parent.conv_id AS parent_conv_id, counted.n_convs,
  counted.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, counted.ends_sha256
FROM counted JOIN subtrees USING (node)
  LEFT JOIN nodes AS parent ON counted.depth > 0 AND parent.node = counted.node[1:counted.depth - 1]"""

ORACLE: dict[str, str] = {
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_vector_codes": vector_codes(),
}
