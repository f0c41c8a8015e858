"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontamination, html_extraction, importance, license_scan, packing, quality_rules, sharding, simhash, spelling_variants, substring_dedup, suffix_dedup, toxicity, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": substring_dedup.query,
        "op2_toxicity": toxicity.query,
        "op3_suffix_dedup": suffix_dedup.query,
        "op4_packing": packing.query,
        "op5_importance_resampling": importance.query,
        "op6_simhash": simhash.query,
        "op7_html_extraction": html_extraction.query,
        "op8_quality_rules": quality_rules.query,
        "op9_decontamination": decontamination.query,
        "op10_sharding": sharding.query,
        "op11_license_scan": license_scan.query,
        "op12_vector_codes": vector_codes.query,
        "op13_spelling_variants": spelling_variants.query,
    }


_OP1 = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM t),
k AS (SELECT doc_id, i, n, word,
             md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS h
      FROM w),
many AS (SELECT h FROM k WHERE i <= n - 34 GROUP BY h HAVING count(*) > 1),
f AS (SELECT k.*, CASE WHEN i <= n - 34 AND h IN (SELECT h FROM many) THEN 1 ELSE 0 END AS starts FROM k),
c AS (SELECT doc_id, i, word,
             max(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
      FROM f),
g AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN g USING (doc_id)
"""


_OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
least_id AS (SELECT s, min(doc_id) AS lo FROM w GROUP BY s),
hit AS (SELECT doc_id, i FROM w JOIN least_id USING (s) WHERE lo < doc_id),
fresh AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS f FROM hit),
numbered AS (SELECT doc_id, i, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM fresh),
span AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, k),
gap AS (SELECT doc_id, k, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 0) AS prev FROM span),
cut AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, string_agg(substr(x, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY k) AS head, max(b) AS last
        FROM gap JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

_OP9 = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
items AS (SELECT item_id, w, len(w) AS n FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
item_words AS (SELECT item_id, n, unnest(w) AS word, unnest(range(n)) AS k FROM items),
doc_words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs),
hits AS (SELECT doc_id, item_id, i - k AS diagonal FROM doc_words JOIN item_words USING (word) GROUP BY doc_id, item_id, i - k, n HAVING 5 * count(*) >= 4 * least(n, 13)),
laid AS (SELECT doc_id, item_id, diagonal, least(n, 13) AS need, doc_start, j, dw[j + 1] = iw[j - diagonal + 1] AS same
         FROM (SELECT *, unnest(range(doc_start, least(diagonal + n, len(dw)))) AS j
               FROM (SELECT doc_id, item_id, diagonal, n, greatest(diagonal, 0) AS doc_start, docs.w AS dw, items.w AS iw FROM hits JOIN items USING (item_id) JOIN docs USING (doc_id)))),
balance AS (SELECT doc_id, item_id, diagonal, need, j + 1 AS j, sum(CASE WHEN same THEN 1 ELSE -4 END) OVER w AS p, sum(same::INT) OVER w AS ok
            FROM laid WINDOW w AS (PARTITION BY doc_id, item_id, diagonal ORDER BY j)
            UNION ALL SELECT DISTINCT doc_id, item_id, diagonal, need, doc_start, 0, 0 FROM laid),
pairs AS (SELECT e.doc_id, e.item_id, e.j - s.j AS n_words, e.ok - s.ok AS n_agree, s.j AS doc_start, e.p - s.p AS gained,
                 row_number() OVER (PARTITION BY e.doc_id, e.item_id, e.diagonal, e.j ORDER BY s.p, s.j) AS k
          FROM balance e JOIN balance s ON e.doc_id = s.doc_id AND e.item_id = s.item_id AND e.diagonal = s.diagonal AND e.j - s.j >= e.need),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_agree DESC, n_words, doc_start) AS r FROM pairs WHERE k = 1 AND gained >= 0)
SELECT doc_id, item_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_agree AS BIGINT) AS n_agree, CAST(doc_start AS BIGINT) AS doc_start,
       round(n_agree::DOUBLE / n_words, 6) AS share
FROM best WHERE r = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": _OP1, "op3_suffix_dedup": _OP3, "op9_decontamination": _OP9, "op11_license_scan": license_scan.sql(), "op12_vector_codes": vector_codes.sql()}
