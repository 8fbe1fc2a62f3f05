"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.c, d.c) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""

OP9 = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
  FROM (SELECT win.doc_id, i FROM win JOIN first USING (g) WHERE win.doc_id > m)),
every AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.j) AS t
  FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j WHERE g.j IS NULL GROUP BY e.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

# The windows of the fluid mix, then earliest deadline first, slot by slot.
OP4 = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, coalesce('s:' || source, 'null') AS key,
         CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) % 1024 AS bucket FROM documents),
place AS (
  SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY key ORDER BY bucket, doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
room AS (SELECT CAST(greatest(32768, ceil(sum(n_chars) / 200000)) AS BIGINT) AS room FROM d),
src AS (
  SELECT key, n, room, row_number() OVER (ORDER BY key) - 1 AS no, sqrt(n) AS w
  FROM (SELECT key, any_value(room) AS room, CAST(greatest(1, ceil(sum(n_chars) / any_value(room))) AS BIGINT) AS n
        FROM d, room GROUP BY key)),
block AS (
  SELECT s.key, s.no, s.b,
         CAST(floor(sum(least(CAST(j.n AS DOUBLE), j.w * (s.b / s.w))) + 1e-6) AS BIGINT) AS release,
         CAST(ceil(sum(least(CAST(j.n AS DOUBLE), j.w * ((s.b + 1) / s.w))) - 1e-6) AS BIGINT) AS deadline
  FROM (SELECT *, unnest(range(n)) AS b FROM src) s, src j GROUP BY s.key, s.no, s.b),
job AS (
  SELECT list(r ORDER BY no) AS r, list(d ORDER BY no) AS d, CAST(sum(len(r)) AS BIGINT) AS slots
  FROM (SELECT no, list(release ORDER BY b) AS r, list(deadline ORDER BY b) AS d FROM block GROUP BY no)),
run AS (
  SELECT CAST(-1 AS BIGINT) AS t, [CAST(0 AS BIGINT) FOR x IN r] AS done, CAST(NULL AS BIGINT) AS no, CAST(NULL AS BIGINT) AS b FROM job
  UNION ALL
  SELECT t + 1, [done[s + 1] + CAST(s = pick AS BIGINT) FOR s IN range(len(done))], pick, done[pick + 1]
  FROM (SELECT t, done, list_min([d[s + 1][done[s + 1] + 1] * 100000 + s FOR s IN range(len(done))
                                  IF done[s + 1] < len(r[s + 1]) AND r[s + 1][done[s + 1] + 1] <= t + 1]) % 100000 AS pick
        FROM run, job WHERE t + 1 < slots))
SELECT doc_id, source, n_chars, block.b AS block, t // 1000 AS period, t AS slot, release, deadline
FROM (SELECT *, least(CAST(before AS BIGINT) // room, n - 1) AS own FROM place JOIN src USING (key)) x
JOIN block ON block.no = x.no AND block.b = own JOIN run ON run.no = x.no AND run.b = own
"""

_NEAREST = """(
  SELECT r, arg_min(k, d * 64 + k) AS k, min(d) AS d
  FROM (SELECT v.r, m.k, list_inner_product(v.c, v.c) - 2 * list_inner_product(v.c, m.c) + list_inner_product(m.c, m.c) AS d
        FROM v, {m} m) GROUP BY r)"""
_ROUND = """
n{i} AS MATERIALIZED {near},
m{i} AS MATERIALIZED (
  SELECT m.k, coalesce(x.c, m.c) AS c
  FROM {m} m LEFT JOIN (
    SELECT k, list(floor(s / n) ORDER BY j) AS c
    FROM (SELECT k, j, sum(x) AS s, count(*) AS n
          FROM (SELECT k, unnest(c) AS x, unnest(range(64)) AS j FROM n{i} JOIN v USING (r)) GROUP BY k, j) GROUP BY k) x USING (k)),"""
OP12 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS c FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, c) - 1 AS k, c
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, c FROM v ORDER BY h, c LIMIT 40)),""" + "".join(
    _ROUND.format(i=i, m=f"m{i - 1}", near=_NEAREST.format(m=f"m{i - 1}")) for i in range(1, 6)) + f"""
near AS MATERIALIZED {_NEAREST.format(m="m5")}""" + """
SELECT vec_id, CAST(near.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(x AS BIGINT) FOR x IN m5.c], ',')) AS centroid_sha256
FROM near JOIN v USING (r) JOIN m5 ON m5.k = near.k
"""

# CRC-32 by its table: eight halvings of each byte, then one step per byte of the word.
OP13 = r"""
WITH crc AS (
  SELECT [list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b) FOR b IN range(256)] AS t),
every AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (
  SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT r, text FROM every UNION ALL SELECT -1, text FROM benchmark)),
hashed AS (
  SELECT w, xor(list_reduce([CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT) FOR i IN range(length(hex(w)) // 2)],
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words), crc),
feature AS MATERIALIZED (SELECT r, bucket FROM words JOIN hashed USING (w)),
counted AS (SELECT bucket, count(*) FILTER (r >= 0) AS s, count(*) FILTER (r < 0) AS t FROM feature GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE))) AS g FROM counted),
doc AS (SELECT r, count(*) AS n, sum(g) AS weight FROM feature JOIN gain USING (bucket) WHERE r >= 0 GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) + 0.5::DOUBLE)
                                                         / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM every LEFT JOIN doc USING (r)),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(drawn.rank AS BIGINT) AS rank
FROM scored LEFT JOIN drawn ON drawn.r = scored.r AND drawn.rank <= 10 * total // 100
"""

ORACLE: dict[str, str] = {"op4_pfair_mix": OP4,
                           "op1_voronoi_knn": OP1, "op9_superkmer_dedup": OP9,
                           "op12_threshold_clusters": OP12, "op13_ranked_resample": OP13}
