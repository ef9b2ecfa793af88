"""Queries on ``pages``: op1 and op10."""

from __future__ import annotations

from spanload.llm import url_filter, warc
from spanload.llm.common import read_table
from spanload.llm.queries import register

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))

OP1_SQL = r"""
WITH p AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r(rule, rhost, rpath, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
         ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), j AS (
  SELECT p.*, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '')
                   || regexp_replace(path, '/+$', '') END AS k,
    (SELECT arg_max(r.rule, length(r.rule)) FROM r
      WHERE (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)) AS rule
  FROM p
), listed AS (SELECT DISTINCT k FROM j WHERE url LIKE '%utm\_source=%' ESCAPE '\' AND k IS NOT NULL)
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN (SELECT r.verdict FROM r WHERE r.rule = j.rule)
       WHEN k IN (SELECT k FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""


@register("op1_url_filters", OP1_SQL)
def op1(spark, sf_dir):
    """Every page's URL; the list holds the URLs that campaign links (``utm_source``) name."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where("url like '%utm\\\\_source=%'").select("url")
    return url_filter.filter_urls(pages, listed, RULES).select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@register("op10_warc", OP10_SQL)
def op10(spark, sf_dir):
    """All pages into archives, and every record read back from them."""
    manifest = warc.write(read_table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
