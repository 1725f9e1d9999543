"""From raw readings to the daily feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles

ZONE_KEYS = ["country", "zone_name", "zone_id"]
MEASURES = ["carbon_direct", "carbon_lifecycle", "cfe_percent", "re_percent"]
TEXTS = ["data_source", "data_estimation_method", "source_file"]
TARGET = "target_quantile_class"
OUTLIER_COLUMNS = [
    "iqr_outlier_count",
    "zscore_outlier_count",
    "isolation_forest_flag",
    "outlier_consensus_count",
    "outlier_consensus_flag",
]
# The order of the finished table's columns.
FEATURE_ORDER = [
    "day",
    "month",
    "year",
    "carbon_direct",
    "carbon_lifecycle",
    "cfe_percent",
    "re_percent",
    "data_source",
    "data_estimated",
    "data_estimation_method",
    "source_file",
    "estimated_hour_flag",
    "hourly_row_count",
    "estimated_hour_share",
    "hour",
    "day_of_week",
    "is_weekend",
    "carbon_intensity_gap",
    "cfe_re_gap",
]
NUMERIC_FEATURES = [c for c in FEATURE_ORDER if c not in TEXTS]
MONTHLY_COLUMNS = [c for c in NUMERIC_FEATURES if c not in ("month", "year")]


def daily_rollup(
    readings: DataFrame,
    keys: Sequence[str] = tuple(ZONE_KEYS),
    ts: str = "datetime_utc",
    measures: Sequence[str] = tuple(MEASURES),
    texts: Sequence[str] = tuple(TEXTS),
    estimated: str = "data_estimated",
) -> DataFrame:
    """One row per key and day: measures averaged, texts by their most frequent value, hours counted.

    Every aggregate combines map-side, so a zone with a third of all readings still shuffles only
    one partial row per day and task.
    """
    flag = F.col(estimated).cast("int")
    hours = F.count(F.lit(1))
    return readings.groupBy(*keys, F.to_date(ts).alias("date")).agg(
        *[F.avg(m).alias(m) for m in measures],
        *[F.mode(t, deterministic=True).alias(t) for t in texts[:1]],
        F.max(flag).alias(estimated),
        *[F.mode(t, deterministic=True).alias(t) for t in texts[1:]],
        F.sum(flag).cast("int").alias("estimated_hour_flag"),
        hours.cast("int").alias("hourly_row_count"),
        F.min(ts).alias(ts),
        (F.sum(flag) / hours).alias("estimated_hour_share"),
    )


def estimated_share(
    readings: DataFrame, by: Sequence[str], estimated: str = "data_estimated"
) -> DataFrame:
    """Estimated hours, all hours and their ratio per group."""
    return readings.groupBy(*by).agg(
        F.count_if(F.col(estimated)).alias("estimated_hour_flag"),
        F.count(F.lit(1)).alias("hourly_row_count"),
        (F.count_if(F.col(estimated)) / F.count(F.lit(1))).alias("estimated_hour_share"),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in a total order. Only one row per key and task is shuffled."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def clean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    ranges: Mapping[str, tuple[float | None, float | None]],
    at_least: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Drop repeated keys and rows whose values cannot be true.

    ``ranges`` gives the closed interval a column must lie in; ``at_least`` lists pairs whose first
    column must not be below the second. A missing value is no contradiction and stays.
    """
    possible = F.lit(True)
    for column, (low, high) in ranges.items():
        if low is not None:
            possible = possible & F.coalesce(F.col(column) >= low, F.lit(True))
        if high is not None:
            possible = possible & F.coalesce(F.col(column) <= high, F.lit(True))
    for upper, lower in at_least:
        possible = possible & F.coalesce(F.col(upper) >= F.col(lower), F.lit(True))
    return keep_first(df.where(possible), keys, order)


def impute(
    df: DataFrame, numeric: Sequence[str], texts: Sequence[str] = (), unknown: str = "Unknown"
) -> DataFrame:
    """Numeric gaps take the column's exact median, text gaps a fixed word."""
    filled = df
    if numeric:
        medians = exact_quantiles(df, numeric, [0.5])
        filled = filled.fillna({c: m[0] for c, m in medians.items() if m[0] is not None})
    return filled.fillna(unknown, subset=list(texts)) if texts else filled


def calendar_parts(df: DataFrame, date: str = "date", ts: str = "datetime_utc") -> DataFrame:
    """day, month, year, hour, day_of_week (Monday 0), is_weekend."""
    return df.withColumns(
        {
            "day": F.dayofmonth(date),
            "month": F.month(date),
            "year": F.year(date),
            "hour": F.hour(ts),
            "day_of_week": F.weekday(date),
            "is_weekend": (F.weekday(date) >= 5).cast("int"),
        }
    )


def gap_features(
    df: DataFrame,
    direct: str = "carbon_direct",
    lifecycle: str = "carbon_lifecycle",
    cfe: str = "cfe_percent",
    re: str = "re_percent",
) -> DataFrame:
    return df.withColumns(
        {
            "carbon_intensity_gap": F.col(lifecycle) - F.col(direct),
            "cfe_re_gap": F.col(cfe) - F.col(re),
        }
    )


def quantile_class(
    df: DataFrame,
    column: str = "carbon_lifecycle",
    target: str = TARGET,
    labels: Sequence[str] = ("Low", "Medium", "High"),
) -> DataFrame:
    """Ordered classes cut at the exact quantiles 1/K, 2/K, ...; a value on an edge falls below it."""
    k = len(labels)
    edges = exact_quantiles(df, [column], [i / k for i in range(1, k)])[column]
    if edges[0] is None:
        return df.withColumn(target, F.lit(None).cast("string"))
    value = F.col(column)
    choice = F.when(value.isNull(), F.lit(None).cast("string"))
    for label, edge in zip(labels, edges):
        choice = choice.when(value <= F.lit(edge), F.lit(label))
    return df.withColumn(target, choice.otherwise(F.lit(labels[-1])))


def monthly_aggregate(df: DataFrame, columns: Sequence[str] = tuple(MONTHLY_COLUMNS)) -> DataFrame:
    """Mean and sum of each column per month, and the rows counted."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.sum(c).alias(f"{c}_sum")]
    return df.groupBy("year", "month").agg(*aggs, F.count(F.lit(1)).alias("row_count_in_month_count"))


def finalize(df: DataFrame, target: str = TARGET, extra: Sequence[str] = ()) -> DataFrame:
    """The finished table: fixed column order, target last, outlier columns gone."""
    return df.select(*extra, *FEATURE_ORDER, target)


def null_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Missing values per column (and group) in long form."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot([*by, "row_count"], list(columns), "column_name", "null_count").withColumn(
        "null_share", F.try_divide("null_count", "row_count")
    )


def class_counts(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share per class, within each group."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("row_count"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return counts.withColumn("share", F.col("row_count") / F.sum("row_count").over(whole))


def class_balance_compare(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class counts and shares of two stages side by side in long form."""
    stages = before.select(F.lit("before").alias("stage"), label).unionByName(
        after.select(F.lit("after").alias("stage"), label)
    )
    return class_counts(stages, label, by=["stage"])
