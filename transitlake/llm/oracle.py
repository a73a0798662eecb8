"""DuckDB SQL for those queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {
    "op1_benchmark_decontamination": r"""
WITH iw AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0
), dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), grams AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
), hit AS (SELECT r, i, n, item FROM grams JOIN win USING (n, s)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
""",
    "op7_substring_dedup": r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM dw WHERE len(w) >= 35)
), again AS (SELECT r, i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)
), gone AS (SELECT r, list(DISTINCT p) AS ps FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM again) GROUP BY r
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY p) AS k FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM dw) AS a
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT r, unnest(ps) AS p FROM gone) AS g WHERE g.r = a.r AND g.p = a.p) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM dw LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
""",
}
