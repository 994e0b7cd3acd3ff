"""The queries that SQL can express, in DuckDB SQL."""

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 2 * source_size::DOUBLE AS most,
         row_number() OVER (ORDER BY 2 * source_size::DOUBLE / weight, source ASC NULLS LAST) AS rank,
         (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
           - coalesce(sum(2 * source_size::DOUBLE) OVER (ORDER BY 2 * source_size::DOUBLE / weight, source ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 2 * source_size::DOUBLE / weight, source ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM sources),
free AS (SELECT min(rank) AS rank, arg_min(level, rank) AS level FROM filled WHERE most > level * weight),
aims AS (
  SELECT f.source, source_size, CASE WHEN f.rank >= r.rank THEN r.level * weight ELSE most END AS target
  FROM filled f, free r),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END::BIGINT AS whole,
         target - CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END * source_size AS budget
  FROM aims),
places AS (
  SELECT source, place, size, sum(size) OVER (PARTITION BY source ORDER BY place) AS until
  FROM (SELECT source, place, sum(size) AS size FROM sized GROUP BY source, place)),
passed AS (
  SELECT b.source, min(place) AS place, min(until) AS until, arg_min(size, place) AS size
  FROM places p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
  WHERE budget > 0 AND until > budget GROUP BY b.source),
below AS (
  SELECT b.source, source_size, target, whole,
         CASE WHEN budget <= 0 THEN 0 WHEN p.place IS NULL THEN 281474976710656
              ELSE p.place + (p.until - budget <= budget - (p.until - p.size))::BIGINT END AS below
  FROM budgets b LEFT JOIN passed p ON p.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size > 0 THEN (whole + (place < below)::BIGINT) * size ELSE 0 END::BIGINT AS taken
FROM sized s JOIN below b ON s.source IS NOT DISTINCT FROM b.source
"""

OP5 = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id ASC NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id ASC NULLS LAST) AS place
  FROM texts)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

OP11 = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INT AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLES = {"op11_hard_negatives": OP11, "op5_exact_dedup": OP5, "op7_mixing": OP7}
