"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

from .queries import URL_DAYS, URL_LIST

_ENTRIES = ", ".join(f"('{k}', '{c}', DATE '{d}', {str(x).lower()})" for k, c, d, x in URL_LIST)

SQL: dict[str, str] = {
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op7_url_filter": rf"""
        WITH entries(list_key, category, day, listed) AS (VALUES {_ENTRIES}),
        spans AS (
            SELECT list_key, category, day AS valid_from, valid_to FROM (
                SELECT *, lead(day) OVER (PARTITION BY list_key, category ORDER BY day) AS valid_to FROM entries)
            WHERE listed),
        c AS (
            SELECT page_id, url,
                   rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
                   lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]+)', 1)) AS segment,
                   DATE '2024-01-01' + CAST(page_id % {URL_DAYS} AS INTEGER) AS fetched_on
            FROM pages),
        found AS (
            SELECT c.page_id, s.list_key, s.category, s.valid_from,
                   row_number() OVER (PARTITION BY c.page_id ORDER BY length(s.list_key) DESC, s.valid_from DESC, s.category) AS n
            FROM c JOIN spans s ON s.valid_from <= c.fetched_on AND (s.valid_to IS NULL OR s.valid_to > c.fetched_on)
                AND c.host <> '' AND (c.host = s.list_key OR ends_with(c.host, '.' || s.list_key)
                    OR c.host || c.segment = s.list_key OR ends_with(c.host || c.segment, '.' || s.list_key)))
        SELECT c.page_id, c.url, c.host, CAST(c.fetched_on AS VARCHAR) AS fetched_on, f.list_key IS NOT NULL AS blocked,
               f.list_key, f.category, CAST(f.valid_from AS VARCHAR) AS valid_from
        FROM c LEFT JOIN found f ON f.page_id = c.page_id AND f.n = 1""",
    "op9_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
        low AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
        bad AS (SELECT DISTINCT win.doc_id, win.i + k AS pos FROM win JOIN low USING (h), unnest(range(0, 50)) AS t(k) WHERE win.doc_id > low.m),
        gone AS (SELECT doc_id, list(pos) AS p FROM bad GROUP BY doc_id),
        word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM d),
        kept AS (
            SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.pos) AS t
            FROM word LEFT JOIN bad ON bad.doc_id = word.doc_id AND bad.pos = word.pos WHERE bad.pos IS NULL GROUP BY word.doc_id)
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(len(gone.p), 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept ON kept.doc_id = d.doc_id""",
}
