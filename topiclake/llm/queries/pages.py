"""Queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.llm import urls, warc, wrappers
from topiclake.llm.queries import query
from topiclake.llm.tables import table

_OP10 = """
WITH digit AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS d FROM pages
), page AS (
  SELECT page_id, strlen(html) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(d, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest
  FROM digit
), first AS (SELECT payload_digest, min(page_id) AS first_id FROM page GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM page JOIN first USING (payload_digest)
"""


@query("op10_warc", _OP10)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _op8_sql() -> str:
    keep = f"{urls.DAMPING}"
    parts = [
        """WITH cut AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), rules(rule, verdict, h, p) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
    ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), ruled AS (
  SELECT n.page_id, n.host, n.path, n.html, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS ruled
  FROM named n LEFT JOIN rules r ON (n.host = r.h OR ends_with(n.host, '.' || r.h)) AND starts_with(n.path, r.p)
  GROUP BY n.page_id, n.host, n.path, n.html
), start AS (
  SELECT host, (1 - KEEP) * avg(CAST(coalesce(ruled, '') = 'allow' AS INTEGER)) AS trust,
    (1 - KEEP) * avg(CAST(coalesce(ruled, '') = 'block' AS INTEGER)) AS distrust FROM ruled WHERE host <> '' GROUP BY host
), raw AS (
  SELECT host AS source, unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?\\s*([^"''\\s>]+)', 1)) AS l FROM ruled
), outward AS (
  SELECT source, CASE WHEN starts_with(l, '//') THEN substr(l, 3) ELSE substr(l, instr(l, '://') + 3) END AS rest
  FROM raw WHERE starts_with(l, '//') OR regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://')
), pair AS (
  SELECT source, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM outward
), counted AS (
  SELECT source, target, count(*) AS links FROM pair WHERE source <> target AND source <> '' AND target <> '' GROUP BY source, target
), edge AS (
  SELECT source, target, links / sum(links) OVER (PARTITION BY source) AS follow, links / sum(links) OVER (PARTITION BY target) AS back FROM counted
), r0 AS (SELECT * FROM start)""".replace("KEEP", keep)
    ]
    for i in range(1, urls.ROUNDS + 1):
        parts.append(f"""r{i} AS (
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT * FROM start
    UNION ALL SELECT target, {keep} * trust * follow, 0 FROM edge JOIN r{i - 1} ON source = host
    UNION ALL SELECT source, 0, {keep} * distrust * back FROM edge JOIN r{i - 1} ON target = host) GROUP BY host
)""")
    return ", ".join(parts) + f"""
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.ruled, CASE WHEN s.distrust - s.trust > {urls.THRESHOLD} * (1 - {keep}) THEN 'block' END, 'allow') AS verdict
FROM ruled r LEFT JOIN r{urls.ROUNDS} s ON s.host = r.host"""


@query("op8_url_filter", _op8_sql())
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"))


@query("op13_html_extraction")
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = wrappers.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
