"""SQL for the queries that SQL can express, over the tables' whole rows."""

from __future__ import annotations

# Words: runs of anything but space and 0x09 to 0x0D.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LINE_FREQUENCY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
l AS (SELECT doc_id, source, text, pos, line FROM (
        SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d) x
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
n AS (SELECT *, regexp_replace(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))), '[0-9]', '0', 'g')
        AS plain FROM l),
h AS (SELECT source, count(DISTINCT text) AS docs FROM n GROUP BY 1),
f AS (SELECT n.source, plain FROM n JOIN h ON n.source IS NOT DISTINCT FROM h.source GROUP BY n.source, plain, docs
      HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.01 * docs),
c AS (SELECT n.doc_id, n.text, n.source, sum(length(n.plain) - length(replace(n.plain, ' ', '')) + 1) AS common
      FROM n JOIN f ON n.source IS NOT DISTINCT FROM f.source AND n.plain = f.plain GROUP BY 1, 2, 3),
dup AS (SELECT doc_id, text, count(*) - count(DISTINCT line) AS n_dup FROM l GROUP BY 1, 2),
w AS (SELECT doc_id, text, unnest(range(1, len(words) - 6)) AS i, words FROM d WHERE len(words) >= 8),
g AS (SELECT doc_id, text, i, array_to_string(words[i:i + 7], chr(10)) AS gram FROM w),
r AS (SELECT *, count(*) OVER (PARTITION BY doc_id, text, gram) AS n FROM g),
s AS (SELECT doc_id, text, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id, text ORDER BY i) - i, 8)) AS own
      FROM r WHERE n > 1),
rep AS (SELECT doc_id, text, sum(own) AS n_rep FROM s GROUP BY 1, 2),
m AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(common, 0) AS BIGINT) AS n_common_words
      FROM d LEFT JOIN dup ON d.doc_id = dup.doc_id AND d.text = dup.text
      LEFT JOIN rep ON d.doc_id = rep.doc_id AND d.text = rep.text
      LEFT JOIN c ON d.doc_id = c.doc_id AND d.text = c.text AND d.source IS NOT DISTINCT FROM c.source)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_common_words <= 0.8 * n_words AS kept
FROM m
"""

TOP_K = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1]) END) AS s FROM d),
z AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
-- each pair within the threshold shares a shingle among the rarest fifth (and one) of either set
k AS (SELECT s, count(*) AS df FROM g GROUP BY 1),
o AS (SELECT g.doc_id, g.s, z.n, row_number() OVER (PARTITION BY g.doc_id ORDER BY k.df, g.s) AS place
  FROM g JOIN k USING (s) JOIN z USING (doc_id)),
x AS (SELECT * FROM o WHERE place <= n - ceil(0.8 * n) + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m FROM x a JOIN x b
  ON a.s = b.s AND a.doc_id < b.doc_id WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
e AS (SELECT a, b FROM cand JOIN g ga ON ga.doc_id = a JOIN g gb ON gb.doc_id = b AND ga.s = gb.s
  GROUP BY a, b, n, m HAVING 100 * count(*) >= 80 * (n + m - count(*))),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
walk AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT w.a, t.b FROM walk w JOIN both_ways t ON w.b = t.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM d LEFT JOIN z USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY 1) c USING (doc_id)
"""


def _fraction(key: str, name: str) -> str:
    return f"((('0x' || substr(md5({key} || ':' || {name}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)"


def _level(key: str, children: list[tuple[str, float]]) -> str:
    draws = ", ".join(f"{{'draw': -ln({_fraction(key, repr(n))}) / {w}, 'name': {n!r}}}" for n, w in children)
    return f"list_min([{draws}]).name"


def _tree(extra: int) -> str:
    """Shard by three draws: regions of 12, racks of 4, and ``extra`` regions of one shard."""
    regions = [("g0", 12.0), ("g1", 12.0)] + [("new24", 1.0)] * extra
    racks = " ".join(f"WHEN 'g{g}' THEN {_level('k', [(f'g{g}r{r}', 4.0) for r in range(3 * g, 3 * g + 3)])}"
                     for g in range(2))
    shards = " ".join(f"WHEN 'g{r // 3}r{r}' THEN {_level('k', [(f's{s}', 1.0) for s in range(4 * r, 4 * r + 4)])}"
                      for r in range(6))
    region = _level("k", sorted(regions))
    rack = f"CASE {region} {racks} ELSE 'new24r' END"
    return f"CAST(substr(CASE {rack} {shards} ELSE 's24' END, 2) AS INTEGER)"


HASH_TREE = f"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS step FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE step = 8),
d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc AS (SELECT doc_id, k, CAST(length(h) // 2 + 8 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      regexp_extract_all(h, '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]))) AS text_crc32 FROM d, tab),
p AS (SELECT *, {_tree(0)} AS shard, {_tree(1)} AS grown_shard FROM crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard FROM p
"""


def _lloyd(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Every part against every entry, round by round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min({{'d': d, 'k': k}}) AS m FROM (
    SELECT r, x.p, k, x, CAST(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)
      AS d FROM x JOIN b{i} b ON x.p = b.p) y GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (SELECT p, m.k AS k, j, CAST(sum(x[j]) AS BIGINT) AS s, count(*) AS n
  FROM a{i}, unnest(range(1, len(x) + 1)) u(j) GROUP BY 1, 2, 3),
m{i} AS (SELECT p, k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS e FROM s{i} GROUP BY 1, 2),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.e, b.e) AS e FROM b{i} b LEFT JOIN m{i} m ON m.p = b.p AND m.k = b.k)""")
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
  FROM v, unnest(range({parts})) u(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS k, x AS e FROM x WHERE r <= {entries}),{",".join(steps)},
c AS (SELECT r, string_agg(printf('%02x', m.k), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r),
f AS (SELECT p, k, j, e[j] AS c FROM b{rounds}, unnest(range(1, len(e) + 1)) u(j)),
h AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, k, j)) AS codebooks_sha256 FROM f)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c JOIN v ON c.r = v.r, h
"""



_CRC_TABLE = """bits AS (SELECT i, i AS c, 0 AS step FROM range(256) t(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE step = 8)"""


def _crc32(text: str) -> str:
    """CRC of a text by ``_CRC_TABLE``."""
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      regexp_extract_all(hex(encode({text})), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])))"""


STRUCTURE_REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS draw
  FROM conversations, tab),
e AS (SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
    CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d, unnest(CASE draw WHEN 3 THEN [0, 1] ELSE [0] END) u(copy) WHERE draw <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM e),
f AS MATERIALIZED (SELECT *, left(role, 1) AS x, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM o),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
    count_if(i > 1 AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
follow(q, x, t) AS (VALUES ('0', 's', 'S'), ('0', 'u', 'U'), ('S', 'u', 'U'), ('U', 'a', 'A'), ('A', 'u', 'U')),
state AS (SELECT unnest(['0', 'S', 'U', 'A']) AS q),
insertion AS (SELECT q, q AS t, 0 AS c, '' AS a FROM state UNION ALL SELECT q, t, 5, 'I' FROM follow WHERE x <> 's'),
edit AS (SELECT q, '' AS x, q AS t, 2 AS c, 'D' AS a FROM state UNION ALL SELECT q, x, t, 0, 'K' FROM follow
  UNION ALL SELECT q, x, t, 1, 'R' FROM follow WHERE x <> 's'),
-- an insertion twice in a row never pays, so one before each row and one at the end are enough
walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS q, {{'c': 0, 'a': ''}} AS w FROM n UNION ALL
  SELECT walk.conv_id, f.i, edit.t, min({{'c': w.c + insertion.c + edit.c
      + CASE WHEN edit.a <> 'D' AND fault = 3 THEN 5 ELSE 0 END, 'a': w.a || insertion.a || edit.a}})
  FROM walk JOIN f ON f.conv_id IS NOT DISTINCT FROM walk.conv_id AND f.i = walk.i + 1
  JOIN insertion ON insertion.q = walk.q JOIN edit ON edit.q = insertion.t AND (edit.a = 'D'
    OR (fault NOT IN (1, 2) AND (edit.a = 'R' OR edit.x = f.x))) GROUP BY 1, 2, 3),
b AS (SELECT walk.conv_id, min({{'c': w.c + insertion.c, 'a': w.a || insertion.a}}) AS w
  FROM walk JOIN n ON n.conv_id IS NOT DISTINCT FROM walk.conv_id AND n.n = walk.i
  JOIN insertion ON insertion.q = walk.q WHERE insertion.t IN ('0', 'A') GROUP BY 1),
l AS (SELECT conv_id, p, w.a[p] AS letter, length(replace(w.a[:p], 'I', '')) AS i,
    length(replace(w.a[:p], 'D', '')) AS out FROM b, unnest(range(1, length(w.a) + 1)) u(p)),
k AS (SELECT l.*, f.role, f.text, max(CAST(letter = 'K' AND out = 1 AND x = 's' AS INTEGER))
    OVER (PARTITION BY l.conv_id) AS led
  FROM l LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND letter <> 'I' WHERE letter <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (out - led) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p)) AS digest FROM k GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(w.c, 0) AS BIGINT) AS cost,
  coalesce(w.a, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLES = {
    "op6_line_frequency": LINE_FREQUENCY,
    "op7_mtree": TOP_K,
    "op8_minmax_dedup": NEAR_DUPLICATES,
    "op10_hash_tree": HASH_TREE,
    "op12_dual_tree_codes": _lloyd(),
    "op13_structure_repair": STRUCTURE_REPAIR,
}
