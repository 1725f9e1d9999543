"""URL filter lists as they stood when each page was fetched.

Dated list entries (added, removed) become validity intervals. A capture is looked up under its host and the
host's parent domains, its path prefixes and its whole address; of each it finds the interval that held at
fetch time. Intervals are cut into slices of ``SLICE_DAYS``, so the join has an equality on key and slice, and
a key with a long history meets a capture with its entries of that slice only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridia.session import materialize

SLICE_DAYS = 64
DOMAIN, PREFIX, ADDRESS = "domain", "prefix", "url"
_ADDRESS = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(?::[0-9]*)?([^#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case without a final dot; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(url, _ADDRESS, 1)), F.lit("."))


def rest_of(url: Column) -> Column:
    """Path and query as written."""
    return F.regexp_extract(url, _ADDRESS, 2)


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def normal_value(kind: Column, value: Column) -> Column:
    """The form under which a list value is looked up: domains in lower case, prefixes without slashes at the end."""
    host = F.lower(F.regexp_extract(value, "^([^/]*)", 1))
    path = F.regexp_extract(value, "^[^/]*(.*)$", 1)
    prefix = F.concat_ws("/", F.concat(F.array(host), _segments(path)))
    return (
        F.when(kind == DOMAIN, F.btrim(F.lower(value), F.lit(".")))
        .when(kind == PREFIX, prefix)
        .when(kind == ADDRESS, F.concat(host, path))
    )


def intervals(entries: DataFrame) -> DataFrame:
    """``list_name, effect, kind, value, valid_from, valid_to`` from dated ``entries``.

    ``entries``: list_name, effect (block or allow), kind (domain, prefix, url), value, action (add or
    remove), day. An interval runs from the day of an addition up to the day before the removal, or is open
    (null). Of an addition and a removal on one day the addition counts; repeats change nothing. Rows with a
    null in any of these columns, or another kind or action, say nothing. Days are summed up first, so a key
    is ordered over its distinct days only.
    """
    key = ["list_name", "effect", "kind", "value"]
    rows = entries.select(
        "list_name", "effect", "kind", normal_value(F.col("kind"), F.col("value")).alias("value"), "action",
        F.col("day").cast("date").alias("day"),
    )
    rows = rows.dropna().where(F.col("action").isin("add", "remove") & (F.col("value") != ""))
    days = rows.groupBy(*key, "day").agg(F.max(F.col("action") == "add").alias("on"))
    in_order = Window.partitionBy(*key).orderBy("day")
    days = days.withColumn("was", F.coalesce(F.lag("on").over(in_order), F.lit(False))).where("on <> was")
    days = days.withColumn("valid_to", F.lead("day").over(in_order)).where("on")
    return days.select(*key, F.col("day").alias("valid_from"), "valid_to")


def _keys(url: Column, depths: dict[str, list[int]]) -> Column:
    """(kind, value) pairs under which a capture is looked up, of the depths that the lists have."""
    host, rest = host_of(url), rest_of(url)
    labels = F.split(host, r"\.")
    segments = _segments(F.regexp_extract(rest, r"^([^?]*)", 1))
    found = [F.struct(F.lit(ADDRESS).alias("kind"), F.concat(host, rest).alias("value"))]
    for n in depths[DOMAIN]:
        value = F.when(F.size(labels) >= n, F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), "."))
        found.append(F.struct(F.lit(DOMAIN).alias("kind"), value.alias("value")))
    for n in depths[PREFIX]:
        value = F.when(F.size(segments) >= n, F.concat_ws("/", F.concat(F.array(host), F.slice(segments, 1, n))))
        found.append(F.struct(F.lit(PREFIX).alias("kind"), value.alias("value")))
    return F.filter(F.array(*found), lambda k: k["value"].isNotNull() & (host != ""))


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id") -> DataFrame:
    """Lists that held each capture when it was fetched.

    ``captures``: ``key``, url, fetched (date or timestamp). Returns one row per row of it: ``key``, fetched,
    ``n_entries`` (entries that applied), ``lists`` (their names, sorted), ``blocked``: an entry with effect
    block applied and none with effect allow. A null or malformed url, or a null fetch time, meets no entry.
    Rows that share the key count each for itself; equal rows get equal results. Empty lists block nothing.
    """
    held = materialize(intervals(entries), "intervals")
    depth = F.when(F.col("kind") == DOMAIN, F.size(F.split("value", r"\."))).otherwise(F.size(F.split("value", "/")) - 1)
    got = held.where(F.col("kind").isin(DOMAIN, PREFIX)).select("kind", depth.alias("n")).distinct().collect()
    depths = {k: sorted({r.n for r in got if r.kind == k}) for k in (DOMAIN, PREFIX)}
    rows = captures.select(F.col(key).alias("key"), F.col("url").cast("string").alias("url"), F.col("fetched").cast("date").alias("day"))
    reach = rows.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    if reach.lo is None:
        held = held.limit(0)
    slice_of = lambda day: F.floor(F.unix_date(day) / SLICE_DAYS)
    first = F.greatest(slice_of(F.col("valid_from")), slice_of(F.lit(reach.lo).cast("date")))
    last = F.least(
        slice_of(F.date_sub(F.coalesce("valid_to", F.date_add(F.lit(reach.hi).cast("date"), 1)), 1)),
        slice_of(F.lit(reach.hi).cast("date")),
    )
    sliced = held.withColumn("lo", first).withColumn("hi", last).where("lo <= hi")
    sliced = sliced.withColumn("slice", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    asked = rows.where("day IS NOT NULL").distinct().withColumn("k", F.explode(_keys(F.col("url"), depths)))
    asked = asked.select("key", "url", "day", "k.kind", "k.value", slice_of(F.col("day")).alias("slice"))
    met = asked.join(sliced, ["kind", "value", "slice"]).where(
        "valid_from <= day AND (valid_to IS NULL OR day < valid_to)"
    )
    verdict = met.groupBy("key", "url", "day").agg(
        F.count("*").alias("n_entries"),
        F.array_sort(F.collect_set("list_name")).alias("lists"),
        F.max(F.col("effect") == "block").alias("hit"),
        F.max(F.col("effect") == "allow").alias("spared"),
    )
    verdict = verdict.toDF("_key", "_url", "_day", "n_entries", "lists", "hit", "spared")
    same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("url") == F.col("_url")) & (F.col("day") == F.col("_day"))
    return rows.join(verdict, same, "left").select(
        F.col("key").alias(key),
        F.col("day").alias("fetched"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.array().cast("array<string>")).alias("lists"),
        F.coalesce(F.col("hit") & ~F.col("spared"), F.lit(False)).alias("blocked"),
    )
