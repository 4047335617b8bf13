"""The queries of this package that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from linkweave.llm.mixing import CIRCLE, GOLDEN_STEP, REPEATS, SLOT_UNITS, SLOTS, WEIGHTS

_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

MIXING_SQL = f"""WITH sized AS (SELECT doc_id, source, CAST(coalesce(
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, source_size * {REPEATS} AS most, row_number() OVER by_name - 1 AS source_no,
    {list(WEIGHTS)}[(row_number() OVER by_name - 1) % {len(WEIGHTS)} + 1] AS weight
  FROM sources WINDOW by_name AS (ORDER BY source NULLS LAST)),
levels AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(most) OVER before, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighted WINDOW before AS (ORDER BY most / weight, source NULLS LAST {_BEFORE})),
fixed AS (SELECT min_by(level, place) AS level FROM levels WHERE level <= most / weight),
targets AS (SELECT source, source_no, source_size,
    least(CAST(most AS DOUBLE), weight * fixed.level) AS target,
    greatest(1, CAST(sum(source_size) OVER () AS BIGINT) // {SLOTS}) AS block
  FROM levels CROSS JOIN fixed),
asked AS (SELECT *, CAST(CASE WHEN source_size > 0
    THEN round(target * blocks / source_size * {SLOT_UNITS}) ELSE 0 END AS BIGINT) AS wanted
  FROM (SELECT *, CAST(ceil(source_size / block) AS BIGINT) AS blocks FROM targets)),
arcs AS (SELECT *, CAST(sum(wanted) OVER () AS BIGINT) AS units,
    CAST(coalesce(sum(wanted) OVER (ORDER BY source_no {_BEFORE}), 0) AS BIGINT) AS below FROM asked),
shares AS (SELECT *, below * {CIRCLE} // units AS low, (below + wanted) * {CIRCLE} // units AS high
  FROM arcs WHERE wanted > 0),
slots AS (SELECT slot, slot * {GOLDEN_STEP} % {CIRCLE} AS point FROM
  (SELECT unnest(range((SELECT (max(units) + {SLOT_UNITS - 1}) // {SLOT_UNITS} FROM arcs))) AS slot)),
ranks AS (SELECT source_no, blocks,
    row_number() OVER (PARTITION BY source_no ORDER BY slot) - 1 AS rank
  FROM slots JOIN shares ON point >= low AND point < high),
uses AS (SELECT source_no, rank % blocks AS block_no, count(*) AS uses FROM ranks
  WHERE rank < blocks * {REPEATS} GROUP BY ALL),
streams AS (SELECT d.doc_id, size, a.source_no, a.source_size, a.target, a.blocks,
    CAST(coalesce(sum(size) OVER (PARTITION BY a.source_no
      ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, size {_BEFORE}), 0)
      AS BIGINT) AS start
  FROM sized d JOIN asked a ON d.source IS NOT DISTINCT FROM a.source),
spread AS (SELECT *, unnest(range(((start + 1) * blocks - 1) // source_size,
    ((start + size) * blocks - 1) // source_size + 1)) AS block_no FROM streams WHERE size > 0),
parts AS (SELECT s.*, coalesce(uses, 0) * (
    least(start + size, (s.block_no + 1) * source_size // blocks)
      - greatest(start, s.block_no * source_size // blocks)) AS part
  FROM spread s LEFT JOIN uses u ON u.source_no = s.source_no AND u.block_no = s.block_no)
SELECT doc_id, size, source_size, target, CAST(sum(part) AS BIGINT) AS taken
FROM parts GROUP BY doc_id, size, source_size, target, source_no, start
UNION ALL SELECT doc_id, size, source_size, target, CAST(0 AS BIGINT) FROM streams WHERE size = 0"""

# The list has, for each byte, the byte and eight shifts of the remainder.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda k: list_concat(
      [CAST(ascii(CAST(conv_id AS VARCHAR)[k]) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1
      THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END), 4294967295::BIGINT)"""

TRIE_SQL = f"""WITH hashed AS (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place
  FROM hashed),
own AS (SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS n, {_CRC} % 6 AS opening
  FROM turns GROUP BY conv_id),
plan AS (SELECT o.*, least(o.opening, coalesce(b.n, 0)) AS taken
  FROM own o LEFT JOIN own b ON b.conv_id = o.base),
members AS (SELECT *, taken + greatest(n - opening, 0) AS n_turns FROM plan),
rebuilt AS (SELECT m.conv_id, place - opening + taken AS depth, digest, size, n_turns
  FROM turns t JOIN members m ON t.conv_id = m.conv_id WHERE place > opening
  UNION ALL SELECT m.conv_id, place, digest, size, n_turns
  FROM turns t JOIN members m ON t.conv_id = m.base WHERE place <= taken),
prefixes AS (SELECT conv_id, depth, size, n_turns,
    array_to_string(list(digest) OVER (PARTITION BY conv_id ORDER BY depth), '') AS node
  FROM rebuilt UNION ALL SELECT conv_id, 0, 0, n_turns, '' FROM members),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * max(size) AS saved, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ','
      ORDER BY conv_id) FILTER (depth = n_turns), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth),
family AS (SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.children, 0) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.node = left(n.node, (n.depth - 1) * 64)
  LEFT JOIN (SELECT left(node, (depth - 1) * 64) AS node, count(*) AS children FROM nodes
    WHERE depth > 0 GROUP BY 1) c ON c.node = n.node),
upward AS (SELECT p.node,
    sum(CASE WHEN f.conv_id = p.conv_id AND n_children = 0 THEN 1 ELSE 0 END) OVER w AS leaves,
    sum(CASE WHEN f.conv_id = p.conv_id THEN saved ELSE 0 END) OVER w AS saved
  FROM prefixes p JOIN family f ON f.node = p.node
  WINDOW w AS (PARTITION BY p.conv_id ORDER BY p.depth DESC)),
sums AS (SELECT node, CAST(sum(leaves) AS BIGINT) AS n_leaves,
    CAST(sum(saved) AS BIGINT) AS saved_tokens FROM upward GROUP BY node)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves,
  saved_tokens, ends_sha256 FROM family JOIN sums ON sums.node = family.node"""

LLM_SQL: dict[str, str] = {"op5_source_mixing": MIXING_SQL, "op13_prefix_trie": TRIE_SQL}
