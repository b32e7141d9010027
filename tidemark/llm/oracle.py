"""DuckDB SQL of the queries that SQL can express."""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix' || doc_id) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER AS weight,
             3 * source_size AS most FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s)
                 - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
x AS (SELECT arg_min(level, most / weight) AS level FROM l WHERE most >= level * weight),
t AS (SELECT source, source_size, weight, least(most::DOUBLE, x.level * weight) AS target FROM w, x),
p AS (SELECT d.*, source_size, weight, target,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT p.*, copy, (copy * source_size + upto)::DOUBLE / target AS v
      FROM p, (SELECT unnest([0, 1, 2]) AS copy) WHERE size > 0),
r AS (SELECT doc_id, size, sum(size) OVER (ORDER BY v, key, doc_id, copy
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM c),
k AS (SELECT doc_id, sum(size) AS taken FROM r WHERE run <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT p.doc_id, p.size::BIGINT AS size, source_size, target, coalesce(taken, 0)::BIGINT AS taken,
       source, weight
FROM p LEFT JOIN k USING (doc_id)"""


def _license_sql() -> str:
    """Phrases by comparing words at every place, templates by comparing every block with each."""
    import math

    from tidemark.llm.license_join import BLOCK, PHRASES, TEMPLATES, THRESHOLD
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    phrases = ", ".join(f"({quoted(p.split())}, {len(p.split())}, '{label}')" for p, label in PHRASES)
    templates = ", ".join(f"({quoted(sorted(set(t.split())))}, {math.ceil(THRESHOLD * len(set(t.split())) - 1e-9)}, '{label}')"
                          for label, t in TEMPLATES)
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{word}') AS ws FROM d),
p AS (SELECT * FROM (VALUES {phrases}) AS v(ph, n, label)),
hits AS (SELECT doc_id, label, i FROM w, p, unnest(list_filter(range(1, len(ws) + 1), lambda k: ws[k] = ph[1])) AS u(i)
         WHERE ws[i:i + n - 1] = ph),
b AS (SELECT doc_id, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word,
             list(DISTINCT label) AS base FROM hits GROUP BY doc_id),
lines AS (SELECT doc_id, regexp_extract_all(line, '{word}') AS ws
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
blocks AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) > {BLOCK} THEN ws[i + 1:i + {BLOCK}] ELSE ws END AS b
           FROM lines, unnest(CASE WHEN len(ws) > {BLOCK} THEN range(0, len(ws) - {BLOCK // 2}, {BLOCK // 2}) ELSE [0] END) AS u(i)),
t AS (SELECT * FROM (VALUES {templates}) AS v(tw, need, label)),
m AS (SELECT doc_id, label, len(list_intersect(b, tw)) / len(tw) AS c
      FROM blocks, t WHERE len(list_intersect(b, tw)) >= need),
g AS (SELECT doc_id, list(DISTINCT label) AS met, max(c) AS score FROM m GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(met, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN g USING (doc_id)"""


OP7 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
               ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, b.y FROM r JOIN both_ways b ON r.y = b.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) ON x = d.doc_id"""

SQL = {"op4_license_scan": _license_sql(), "op5_fair_mix": OP5, "op7_ngram_jaccard": OP7}
