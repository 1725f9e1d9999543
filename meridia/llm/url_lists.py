"""Dated lists derived from the pages' own addresses, for the registered query, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.llm import url_filter

# A page's fetch day, a host's and an address's list history follow from hashes of what is in the table.
DAYS = 720
START = "2024-01-01"


def captures(pages: DataFrame) -> DataFrame:
    day = F.pmod(F.col("page_id") * 7919, F.lit(DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(START).cast("date"), day).alias("fetched"))


def _digits(value: str, begin: int, length: int) -> Column:
    return F.conv(F.substring(F.md5(F.col(value).cast("binary")), begin, length), 16, 10).cast("int")


def entries(pages: DataFrame) -> DataFrame:
    """Hosts on a block list that are taken off and put on again, parent domains, sections and single addresses."""
    urls = pages.select("url").where("url IS NOT NULL").distinct()
    hosts = urls.select(url_filter.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    start = F.lit(START).cast("date")
    hosts = hosts.withColumn("first", _digits("host", 1, 4) % DAYS).withColumn("pick", _digits("host", 9, 1))
    sections = (
        urls.select(
            F.concat_ws(
                "/", url_filter.host_of(F.col("url")), F.regexp_extract(url_filter.rest_of(F.col("url")), "^/([^/?]+)", 1)
            ).alias("value")
        )
        .distinct()
        .withColumn("first", _digits("value", 1, 4) % DAYS)
        .withColumn("pick", _digits("value", 9, 1))
    )
    parents = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("value")).distinct()
    parents = parents.where("value <> ''").withColumn("first", _digits("value", 1, 4) % DAYS)
    pages_listed = urls.select(
        F.concat(url_filter.host_of(F.col("url")), url_filter.rest_of(F.col("url"))).alias("value")
    ).distinct()
    pages_listed = pages_listed.withColumn("first", _digits("value", 1, 4) % DAYS).where(_digits("value", 9, 1) < 2)

    def rows(table: DataFrame, name: str, effect: str, kind: str, value: str, action: str, after: int) -> DataFrame:
        return table.select(
            F.lit(name).alias("list_name"), F.lit(effect).alias("effect"), F.lit(kind).alias("kind"),
            F.col(value).alias("value"), F.lit(action).alias("action"),
            F.date_add(start, F.col("first") + after).alias("day"),
        )

    parts = [
        rows(hosts.where("pick < 10"), "hosts", "block", "domain", "host", "add", 0),
        rows(hosts.where("pick < 8"), "hosts", "block", "domain", "host", "remove", 90),
        rows(hosts.where("pick < 5"), "hosts", "block", "domain", "host", "add", 200),
        rows(hosts.where("pick > 12"), "trusted", "allow", "domain", "host", "add", 30),
        rows(parents, "parents", "block", "domain", "value", "add", 0),
        rows(parents, "parents", "block", "domain", "value", "remove", 45),
        rows(sections.where("pick < 6"), "sections", "block", "prefix", "value", "add", 0),
        rows(sections.where("pick < 3"), "sections", "block", "prefix", "value", "remove", 150),
        rows(pages_listed, "addresses", "block", "url", "value", "add", 0),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


SQL = r"""
WITH urls AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id * 7919 % 720)::INT AS fetched,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)), '.') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^#]*)', 2) AS rest
  FROM pages
), hosts AS (
  SELECT host AS value, ('0x' || substr(md5(host), 1, 4))::INT % 720 AS f, ('0x' || substr(md5(host), 9, 1))::INT AS p
  FROM (SELECT DISTINCT host FROM urls WHERE host <> '')
), sections AS (
  SELECT value, ('0x' || substr(md5(value), 1, 4))::INT % 720 AS f, ('0x' || substr(md5(value), 9, 1))::INT AS p
  FROM (SELECT DISTINCT host || '/' || regexp_extract(rest, '^/([^/?]+)', 1) AS value FROM urls WHERE host <> '')
), parents AS (
  SELECT value, ('0x' || substr(md5(value), 1, 4))::INT % 720 AS f
  FROM (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS value FROM urls) WHERE value <> ''
), listed AS (
  SELECT value, ('0x' || substr(md5(value), 1, 4))::INT % 720 AS f
  FROM (SELECT DISTINCT host || rest AS value FROM urls WHERE host <> '')
  WHERE ('0x' || substr(md5(value), 9, 1))::INT < 2
), spans AS (
  SELECT 'hosts' AS list, true AS block, 'domain' AS kind, value, f AS a,
         CASE WHEN p < 8 THEN f + 90 END AS b FROM hosts WHERE p < 10
  UNION ALL SELECT 'hosts', true, 'domain', value, f + 200, NULL FROM hosts WHERE p < 5
  UNION ALL SELECT 'trusted', false, 'domain', value, f + 30, NULL FROM hosts WHERE p > 12
  UNION ALL SELECT 'parents', true, 'domain', value, f, f + 45 FROM parents
  UNION ALL SELECT 'sections', true, 'prefix', value, f, CASE WHEN p < 3 THEN f + 150 END FROM sections WHERE p < 6
  UNION ALL SELECT 'addresses', true, 'url', value, f, NULL FROM listed
), keys AS (
  SELECT page_id, url, fetched, 'url' AS kind, host || rest AS value FROM urls WHERE host <> ''
  UNION ALL
  SELECT page_id, url, fetched, 'domain', array_to_string(labels[i:], '.')
  FROM (SELECT page_id, url, fetched, string_split(host, '.') AS labels, unnest(range(1, len(string_split(host, '.')) + 1)) AS i
        FROM urls WHERE host <> '')
  UNION ALL
  SELECT page_id, url, fetched, 'prefix', array_to_string([host] || segments[:i], '/')
  FROM (SELECT page_id, url, fetched, host, segments, unnest(range(0, len(segments) + 1)) AS i
        FROM (SELECT *, list_filter(string_split(regexp_extract(rest, '^([^?]*)', 1), '/'), lambda s: s <> '') AS segments
              FROM urls WHERE host <> ''))
), met AS (
  SELECT k.page_id, k.url, k.fetched, count(*) AS n, list_sort(list_distinct(list(list))) AS lists,
         bool_or(block) AND NOT bool_or(NOT block) AS blocked
  FROM keys k JOIN spans s USING (kind, value)
  WHERE DATE '2024-01-01' + a <= fetched AND (b IS NULL OR fetched < DATE '2024-01-01' + b)
  GROUP BY ALL
)
SELECT u.page_id, strftime(u.fetched, '%Y-%m-%d') AS fetched, coalesce(n, 0)::BIGINT AS n_entries, coalesce(array_to_string(lists, ','), '') AS lists,
       coalesce(blocked, false) AS blocked
FROM urls u LEFT JOIN met m ON u.page_id = m.page_id AND u.url = m.url AND u.fetched = m.fetched
"""
