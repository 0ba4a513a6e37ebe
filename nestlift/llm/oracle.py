"""DuckDB SQL for the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

_WORDS = r"len(regexp_extract_all({}, '[^\x20\x09-\x0D]+'))"

# highest quotients by listing every bid; the blocks taken follow the seeded systematic choice
_MIX = rf"""
WITH raw AS (SELECT doc_id, source, coalesce({_WORDS.format('text')}, 0)::BIGINT AS size FROM documents),
  src AS (SELECT source, sum(size)::BIGINT AS source_size FROM raw GROUP BY source),
  w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
      2.0::DOUBLE * source_size AS most FROM src),
  f AS (SELECT *, most / weight AS full_at, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
      coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
      sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM w),
  v AS (SELECT *, (budget - full_before) / open_weight AS level FROM f),
  t AS (SELECT source, source_size, CASE WHEN z.final IS NULL THEN most ELSE least(most, z.final * weight) END AS target
    FROM v LEFT JOIN (SELECT level AS final FROM v WHERE full_at >= level ORDER BY full_at, level LIMIT 1) z ON TRUE),
  bids AS (SELECT source, target / (2 * k + 1) AS bid, k FROM t, generate_series(0, (source_size // 16 + 2)::BIGINT) g(k)
    WHERE target > 0),
  won AS (SELECT source, count(*) AS quota FROM
    (SELECT * FROM bids ORDER BY bid DESC, source NULLS LAST, k LIMIT (SELECT round(sum(target) / 32)::BIGINT FROM t))
    GROUP BY source),
  s AS (SELECT t.*, coalesce(won.quota, 0) AS source_quota,
      least(4096, greatest(1, ceil(source_size / 100000.0)))::BIGINT AS shards
    FROM t LEFT JOIN won ON won.source IS NOT DISTINCT FROM t.source),
  d AS (SELECT raw.doc_id, raw.size, s.*,
      ('0x' || substr(md5('11:' || coalesce(raw.doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS spot
    FROM raw JOIN s ON raw.source IS NOT DISTINCT FROM s.source),
  e AS (SELECT *, spot % shards AS shard FROM d),
  h AS (SELECT source, shard, any_value(source_quota) AS source_quota, sum(size)::BIGINT AS shard_size
    FROM e GROUP BY source, shard),
  hb AS (SELECT source, shard, source_quota, row_number() OVER (PARTITION BY source
      ORDER BY shard_size::DOUBLE / (2 * k + 1) DESC, shard, k) AS place
    FROM h, generate_series(0, (shard_size // 16 + 2)::BIGINT) g(k) WHERE shard_size > 0),
  hq AS (SELECT source, shard, count(*) AS quota FROM hb WHERE place <= source_quota GROUP BY source, shard),
  b AS (SELECT h.source, h.shard, ceil(shard_size / 32.0)::BIGINT AS blocks, coalesce(hq.quota, 0) AS quota
    FROM h LEFT JOIN hq ON hq.source IS NOT DISTINCT FROM h.source AND hq.shard = h.shard),
  q AS (SELECT source, shard, blocks, least(quota, 2 * blocks) AS quota,
      ('0x' || substr(md5('11:' || coalesce(source, 'null') || ':' || shard::VARCHAR), 1, 15))::BIGINT
        % greatest(1, blocks) AS start FROM b),
  p AS (SELECT e.*, q.blocks, q.quota, q.start, (sum(e.size) OVER (PARTITION BY e.source, e.shard
      ORDER BY e.spot, e.doc_id, e.size ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
    FROM e JOIN q ON q.source IS NOT DISTINCT FROM e.source AND q.shard = e.shard),
  x AS (SELECT *, stop - size AS begin, quota % greatest(1, blocks) AS rest, greatest(1, blocks) AS n FROM p)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
    (quota // n) * size
    + 32 * ((stop // 32 + start) * rest // n - (begin // 32 + start) * rest // n)
    + ((stop // 32 + 1 + start) * rest // n - (stop // 32 + start) * rest // n) * (stop % 32)
    - ((begin // 32 + 1 + start) * rest // n - (begin // 32 + start) * rest // n) * (begin % 32)
  END::BIGINT AS taken
FROM x"""

# a run is deleted if it has 50 words or more and an earlier copy; it is enough to look at the shortest
# such runs that start or end at each line with a word
_LINES = rf"""
WITH cut AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
  worded AS (SELECT doc_id, line, pos, {_WORDS.format('line')} AS words FROM cut WHERE {_WORDS.format('line')} > 0),
  placed AS (SELECT *, row_number() OVER w - 1 AS i, sum(words) OVER w AS total FROM worded
    WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
  lists AS (SELECT doc_id, list(line ORDER BY i) AS lines FROM placed GROUP BY doc_id),
  spans AS (
    SELECT a.doc_id, a.i AS i, min(b.i) AS j FROM placed a JOIN placed b
      ON b.doc_id = a.doc_id AND b.i BETWEEN a.i AND a.i + 49 AND b.total - a.total + a.words >= 50 GROUP BY a.doc_id, a.i
    UNION
    SELECT b.doc_id, max(a.i), b.i FROM placed a JOIN placed b
      ON b.doc_id = a.doc_id AND a.i BETWEEN b.i - 49 AND b.i AND b.total - a.total + a.words >= 50 GROUP BY b.doc_id, b.i),
  runs AS (SELECT s.*, list_slice(l.lines, s.i + 1, s.j + 1) AS run FROM spans s JOIN lists l USING (doc_id)),
  later AS (SELECT doc_id, i, j FROM
    (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS copy FROM runs) WHERE copy > 1),
  gone AS (SELECT DISTINCT p.doc_id, p.i, p.pos FROM placed p JOIN later r ON r.doc_id = p.doc_id AND p.i BETWEEN r.i AND r.j),
  isles AS (SELECT doc_id, min(pos) AS p0, max(pos) AS p1 FROM
    (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS isle FROM gone) GROUP BY doc_id, isle),
  kept AS (SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.pos) AS text FROM cut c
    WHERE NOT EXISTS (SELECT 1 FROM isles x WHERE x.doc_id = c.doc_id AND c.pos BETWEEN x.p0 AND x.p1) GROUP BY c.doc_id),
  told AS (SELECT doc_id, sum(p1 - p0 + 1) AS n, '[' || string_agg('[' || p0 || ',' || p1 || ']', ',' ORDER BY p0) || ']' AS runs
    FROM isles GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN t.doc_id IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text,
  coalesce(t.n, 0)::INTEGER AS deleted_lines, t.runs AS deleted_runs
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN told t ON t.doc_id = d.doc_id"""

# every pair of groups meets on every kept term, without runs
_DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  groups AS (SELECT DISTINCT lang, source FROM d),
  t AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
  v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
  c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, source, term),
  k AS (SELECT g.lang, g.source, kept.term, kept.total, coalesce(c.n, 0)::HUGEINT AS n
    FROM groups g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
  s AS (SELECT lang, source, sum(n)::HUGEINT AS own FROM k GROUP BY lang, source),
  p AS (SELECT k.*, 1 + (1000000000 * (k.n + 1)) // (s.own + v.v) AS p, 1 + (1000000000 * (k.total + 1)) // (v.n + v.v) AS q
    FROM k JOIN s USING (lang, source) JOIN v USING (lang)),
  sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source),
  pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
  terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
  ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""



def _clusters(k: int = 40, rounds: int = 5, width: int = 64, seed: int = 2) -> str:
    """Every vector against every centroid, one pair of steps per round."""
    parts = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
      FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}),
  c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), x) - 1 AS c, x FROM e WHERE vec_id IS NOT NULL
    ORDER BY sha256('{seed}:' || vec_id), x LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM
    (SELECT e.rid, c{i}.c, list_sum(list_transform(list_zip(e.x, c{i}.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM e, c{i}) GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.x, o.x) AS x FROM c{i} o LEFT JOIN
    (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS x FROM
      (SELECT a.c, u.j, sum(u.v)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} a
        JOIN (SELECT rid, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM e) u USING (rid) GROUP BY a.c, u.j)
      GROUP BY c) n ON n.c = o.c)""")
    return "WITH " + ",\n  ".join(parts) + f"""
SELECT e.vec_id, a.c::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(z.x, lambda v: v::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM e JOIN a{rounds} a USING (rid) JOIN c{rounds} z ON z.c = a.c"""


ORACLE: dict[str, str] = {
    "op9_source_mixing": _MIX,
    "op10_line_dedup": _LINES,
    "op11_source_divergence": _DIVERGENCE,
    "op13_centroid_clustering": _clusters(),
}
