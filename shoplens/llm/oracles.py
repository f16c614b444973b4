"""DuckDB SQL of the queries that SQL can express (the others are held against brute force)."""

OP4 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest FROM p
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
"""

SQL = {"op4_warc_salvage": OP4}
