"""Queries on the preparation operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meridia.functions import naming
from meridia.operators import encode, outliers, prep
from meridia.session import shared_folder
from meridia.sources import readers

from . import views
from .registry import fix, fix_sql, fixed_sql, query

_M = prep.MEASURES
_DATE = "strftime(date, '%Y-%m-%d')"
_STAMP = "strftime(datetime_utc, '%Y-%m-%d %H:%M:%S')"
_CHECKED = ["carbon_direct", "carbon_lifecycle", "cfe_percent", "re_percent", "carbon_intensity_gap", "cfe_re_gap"]


def _dates_as_text(df):
    if "date" in df.columns:
        df = df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    if "datetime_utc" in df.columns:
        df = df.withColumn("datetime_utc", F.date_format("datetime_utc", "yyyy-MM-dd HH:mm:ss"))
    return df


@query(
    "union_sources",
    """
    SELECT source_table, count(*) AS row_count, count(total) AS with_total, count(priority) AS with_priority,
           count(flag) AS with_flag, strftime(min(ts), '%Y-%m-%d') AS first_day
    FROM (SELECT o_orderkey AS id, o_orderdate AS ts, o_totalprice AS total, o_orderpriority AS priority,
                 NULL AS flag, 'orders' AS source_table FROM orders
          UNION ALL
          SELECT l_orderkey, l_shipdate, l_extendedprice, NULL, l_returnflag, 'lineitem' FROM lineitem
          UNION ALL
          SELECT event_id, ts, value, NULL, NULL, 'events' FROM events)
    GROUP BY source_table
    """,
)
def union_sources(spark, sf_dir):
    parts = {
        "orders": views.table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderdate").alias("ts"),
            F.col("o_totalprice").alias("total"),
            F.col("o_orderpriority").alias("priority"),
        ),
        "lineitem": views.table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("id"),
            F.col("l_shipdate").alias("ts"),
            F.col("l_extendedprice").alias("total"),
            F.col("l_returnflag").alias("flag"),
        ),
        "events": views.table(spark, sf_dir, "events").select(
            F.col("event_id").alias("id"), "ts", F.col("value").alias("total")
        ),
    }
    merged = readers.union_tagged(parts, tag="source_table")
    return merged.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("total").alias("with_total"),
        F.count("priority").alias("with_priority"),
        F.count("flag").alias("with_flag"),
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_day"),
    )


@query(
    "params_json",
    """
    SELECT event_id, event_type, '{"event":"' || event_type || '","k":"' || json_extract_string(props, '$.k') || '"}'
             AS params, json_extract_string(props, '$.k') AS k,
           '{"k":"' || json_extract_string(props, '$.k') || '"}' AS without_event
    FROM events
    """,
)
def params_json(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    given = naming.params_from_json(F.col("props"))
    params = naming.params_to_json(F.map_concat(given, F.create_map(F.lit("event"), F.col("event_type"))))
    written = events.select("event_id", "event_type", params.alias("params"))
    back = naming.params_from_json(F.col("params"))
    return written.withColumn("k", back["k"]).withColumn(
        "without_event", naming.params_to_json(naming.without_param(back, "event"))
    )


@query(
    "daily_rollup",
    f"""WITH {views.ROLLUP_SQL}
    SELECT {fix_sql([*_M, "estimated_hour_share"])[:-1]}, {_DATE} AS date, {_STAMP} AS datetime_utc) FROM daily0""",
)
def daily_rollup(spark, sf_dir):
    return fix(_dates_as_text(views.rolled(spark, sf_dir)), [*_M, "estimated_hour_share"])


@query(
    "estimated_share",
    f"""WITH {views.READINGS_SQL}
    SELECT zone_id, source_file, count(*) FILTER (data_estimated) AS estimated_hour_flag,
           count(*) AS hourly_row_count,
           {fixed_sql("count(*) FILTER (data_estimated) / count(*)", 6)} AS estimated_hour_share
    FROM readings GROUP BY zone_id, source_file""",
)
def estimated_share(spark, sf_dir):
    shares = prep.estimated_share(views.readings(spark, sf_dir), ["zone_id", "source_file"])
    return fix(shares, ["estimated_hour_share"], 6)


_RANGES = {"carbon_direct": (0.0, None), "cfe_percent": (0.0, 100.0), "re_percent": (1.0, 100.0)}


@query(
    "clean_daily",
    f"""WITH {views.READINGS_SQL},
    per_source AS (
      SELECT zone_id, CAST(datetime_utc AS date) AS date, data_source, avg(carbon_direct) AS carbon_direct,
             avg(carbon_lifecycle) AS carbon_lifecycle, avg(cfe_percent) AS cfe_percent,
             avg(re_percent) AS re_percent, count(*) AS hourly_row_count
      FROM readings GROUP BY 1, 2, 3),
    possible AS (
      SELECT *, row_number() OVER (PARTITION BY zone_id, date ORDER BY hourly_row_count DESC, data_source) AS rn
      FROM per_source
      WHERE carbon_direct >= 0 AND cfe_percent BETWEEN 0 AND 100 AND re_percent BETWEEN 1 AND 100
        AND carbon_lifecycle >= carbon_direct)
    SELECT {fix_sql(_M)[:-1]}, {_DATE} AS date) FROM (SELECT * EXCLUDE (rn) FROM possible WHERE rn = 1)""",
)
def clean_daily(spark, sf_dir):
    per_source = (
        views.readings(spark, sf_dir)
        .groupBy("zone_id", F.to_date("datetime_utc").alias("date"), "data_source")
        .agg(*[F.avg(m).alias(m) for m in _M], F.count(F.lit(1)).alias("hourly_row_count"))
    )
    kept = prep.clean(
        per_source,
        ["zone_id", "date"],
        [F.col("hourly_row_count").desc(), F.col("data_source")],
        _RANGES,
        at_least=[("carbon_lifecycle", "carbon_direct")],
    )
    return fix(_dates_as_text(kept), _M)


_GAPS = ["cfe_percent", "re_percent"]


@query(
    "impute",
    f"""WITH {views.READINGS_SQL},
    gaps AS (SELECT row_id, nullif(cfe_percent, 0) AS cfe_percent, nullif(re_percent, 0) AS re_percent,
                    data_estimation_method FROM readings),
    mid AS (SELECT quantile_cont(cfe_percent, 0.5) AS c, quantile_cont(re_percent, 0.5) AS r FROM gaps)
    SELECT row_id, {fixed_sql("coalesce(cfe_percent, c)")} AS cfe_percent,
           {fixed_sql("coalesce(re_percent, r)")} AS re_percent,
           coalesce(data_estimation_method, 'Unknown') AS data_estimation_method
    FROM gaps, mid""",
)
def impute(spark, sf_dir):
    gaps = views.readings(spark, sf_dir).select(
        "row_id", *[F.nullif(F.col(c), F.lit(0.0)).alias(c) for c in _GAPS], "data_estimation_method"
    )
    return fix(prep.impute(gaps, _GAPS, ["data_estimation_method"]), _GAPS)


@query(
    "calendar_parts",
    f"""WITH {views.READINGS_SQL}
    SELECT row_id, day(datetime_utc)::int AS day, month(datetime_utc)::int AS month, year(datetime_utc)::int AS year,
           hour(datetime_utc)::int AS hour, (isodow(datetime_utc) - 1)::int AS day_of_week,
           CASE WHEN isodow(datetime_utc) >= 6 THEN 1 ELSE 0 END AS is_weekend
    FROM readings""",
)
def calendar_parts(spark, sf_dir):
    parts = prep.calendar_parts(views.readings(spark, sf_dir), date="datetime_utc")
    return parts.select("row_id", "day", "month", "year", "hour", "day_of_week", "is_weekend")


@query(
    "gap_features",
    f"""WITH {views.READINGS_SQL}
    SELECT row_id, {fixed_sql("carbon_lifecycle - carbon_direct")} AS carbon_intensity_gap,
           {fixed_sql("cfe_percent - re_percent")} AS cfe_re_gap FROM readings""",
)
def gap_features(spark, sf_dir):
    gaps = prep.gap_features(views.readings(spark, sf_dir))
    return fix(gaps.select("row_id", "carbon_intensity_gap", "cfe_re_gap"), ["carbon_intensity_gap", "cfe_re_gap"])


@query(
    "quantile_class",
    f"""WITH {views.LABELED_SQL}
    SELECT row_id, {fixed_sql("carbon_lifecycle")} AS carbon_lifecycle, target_quantile_class FROM labeled""",
)
def quantile_class(spark, sf_dir):
    return fix(
        views.labeled(spark, sf_dir).select("row_id", "carbon_lifecycle", prep.TARGET), ["carbon_lifecycle"]
    )


_IQR_SQL = " + ".join(
    f"CASE WHEN {c} < {c}_1 - 1.5 * ({c}_3 - {c}_1) OR {c} > {c}_3 + 1.5 * ({c}_3 - {c}_1) THEN 1 ELSE 0 END"
    for c in _CHECKED
)
_FENCES_SQL = "fences AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in _CHECKED
)
_Z_SQL = " + ".join(
    f"CASE WHEN {c}_s > 0 AND abs(({c} - {c}_m) / {c}_s) > 2.5 THEN 1 ELSE 0 END" for c in _CHECKED
)
_MOMENTS_SQL = "moments AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _CHECKED
)
_FLAGS_SQL = f"""{views.DAILY_SQL}, {_FENCES_SQL} FROM daily), {_MOMENTS_SQL} FROM daily),
    flags AS (SELECT daily.*, {_IQR_SQL} AS iqr_outlier_count, {_Z_SQL} AS zscore_outlier_count
              FROM daily, fences, moments)"""


@query("iqr_outliers", f"WITH {_FLAGS_SQL} SELECT row_id, iqr_outlier_count FROM flags")
def iqr_outliers(spark, sf_dir):
    return outliers.iqr_outliers(views.daily(spark, sf_dir), _CHECKED).select("row_id", "iqr_outlier_count")


@query("zscore_outliers", f"WITH {_FLAGS_SQL} SELECT row_id, zscore_outlier_count FROM flags")
def zscore_outliers(spark, sf_dir):
    flagged = outliers.zscore_outliers(views.daily(spark, sf_dir), _CHECKED, limit=2.5)
    return flagged.select("row_id", "zscore_outlier_count")


@query(
    "outlier_consensus",
    f"""WITH {_FLAGS_SQL},
    fired AS (SELECT row_id, CASE WHEN iqr_outlier_count > 0 THEN 1 ELSE 0 END
                           + CASE WHEN zscore_outlier_count > 0 THEN 1 ELSE 0 END AS outlier_consensus_count FROM flags)
    SELECT *, CASE WHEN outlier_consensus_count >= 2 THEN 1 ELSE 0 END AS outlier_consensus_flag FROM fired""",
)
def outlier_consensus(spark, sf_dir):
    daily = views.daily(spark, sf_dir)
    flagged = outliers.zscore_outliers(outliers.iqr_outliers(daily, _CHECKED), _CHECKED, limit=2.5)
    both = outliers.outlier_consensus(flagged, ["iqr_outlier_count", "zscore_outlier_count"])
    return both.select("row_id", "outlier_consensus_count", "outlier_consensus_flag")


@query(
    "isolation_forest",
    f"""WITH {views.DAILY_SQL}
    SELECT row_id, true AS score_in_bounds, true AS flags_few, true AS flagged_are_highest FROM daily""",
)
def isolation_forest(spark, sf_dir):
    scored = outliers.isolation_forest(views.daily(spark, sf_dir), _CHECKED, "row_id")
    score, flag = F.col("isolation_score"), F.col("isolation_forest_flag")
    facts = scored.agg(
        (F.sum(flag) <= F.ceil(F.count("*") * 0.05)).alias("flags_few"),
        F.max(F.when(flag == 0, score)).alias("top"),
    )
    return scored.crossJoin(F.broadcast(facts)).select(
        "row_id",
        ((score > 0) & (score < 1)).alias("score_in_bounds"),
        "flags_few",
        ((flag == 1) == (score > F.col("top"))).alias("flagged_are_highest"),
    )


_MONTHLY_SQL = ", ".join(
    f"{fixed_sql(f'avg({c})')} AS {c}_mean, {fixed_sql(f'sum({c})', 2)} AS {c}_sum" for c in prep.MONTHLY_COLUMNS
)


@query(
    "monthly_aggregate",
    f"""WITH {views.DAILY_SQL}
    SELECT year, month, {_MONTHLY_SQL}, count(*) AS row_count_in_month_count FROM daily GROUP BY year, month""",
)
def monthly_aggregate(spark, sf_dir):
    monthly = prep.monthly_aggregate(views.daily(spark, sf_dir))
    means = [f"{c}_mean" for c in prep.MONTHLY_COLUMNS]
    return fix(fix(monthly, means), [f"{c}_sum" for c in prep.MONTHLY_COLUMNS], 2)


@query(
    "finalize_columns",
    f"""WITH {views.LABELED_SQL}
    SELECT {fix_sql([*_CHECKED, "estimated_hour_share"])}
    FROM (SELECT row_id, {", ".join(prep.FEATURE_ORDER)}, target_quantile_class FROM labeled)""",
)
def finalize_columns(spark, sf_dir):
    flagged = outliers.iqr_outliers(views.labeled(spark, sf_dir), _CHECKED)
    return fix(prep.finalize(flagged, extra=["row_id"]), [*_CHECKED, "estimated_hour_share"])


_PROFILED = ["carbon_direct", "carbon_lifecycle", "cfe_percent", "re_percent", *prep.TEXTS]
_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT month, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,"
    f" {fixed_sql(f'(count(*) - count({c})) / count(*)', 6)} AS null_share FROM gaps GROUP BY month"
    for c in _PROFILED
)


@query(
    "null_profile",
    f"""WITH {views.READINGS_SQL},
    gaps AS (SELECT * REPLACE (nullif(cfe_percent, 0) AS cfe_percent), month(datetime_utc)::int AS month FROM readings)
    {_PROFILE_SQL}""",
)
def null_profile(spark, sf_dir):
    gaps = views.readings(spark, sf_dir).withColumns(
        {"cfe_percent": F.nullif(F.col("cfe_percent"), F.lit(0.0)), "month": F.month("datetime_utc")}
    )
    return fix(prep.null_profile(gaps, _PROFILED, by=["month"]), ["null_share"], 6)


@query(
    "class_counts",
    f"""SELECT toxic, count(*) AS row_count,
        {fixed_sql("count(*) / (SELECT count(*) FROM labels)", 6)} AS share FROM labels GROUP BY toxic""",
)
def class_counts(spark, sf_dir):
    return fix(prep.class_counts(views.table(spark, sf_dir, "labels"), "toxic"), ["share"], 6)


@query(
    "feature_target_split",
    f"""WITH {views.LABELED_SQL}
    SELECT {fix_sql([*_CHECKED, "estimated_hour_share"])}
    FROM (SELECT row_id, target_quantile_class AS label, {", ".join(prep.FEATURE_ORDER)} FROM labeled)""",
)
def feature_target_split(spark, sf_dir):
    labeled = views.labeled(spark, sf_dir)
    features, target = encode.split_features_and_target(labeled, prep.TARGET)
    wanted = [c for c in prep.FEATURE_ORDER if c in features]
    return fix(labeled.select("row_id", F.col(target).alias("label"), *wanted), [*_CHECKED, "estimated_hour_share"])


_ROLES_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'categorical' if c in prep.TEXTS else 'numeric'}' AS role, count({c}) AS filled,"
    f" count(*) AS row_count FROM labeled"
    for c in prep.FEATURE_ORDER
)


@query("typed_columns", f"WITH {views.LABELED_SQL} {_ROLES_SQL}")
def typed_columns(spark, sf_dir):
    """Each feature with its role and its filled rows over the whole table."""
    labeled = views.labeled(spark, sf_dir).select(*prep.FEATURE_ORDER, prep.TARGET)
    numeric, texts = encode.typed_columns(labeled, [prep.TARGET])
    roles = F.create_map(
        *[F.lit(v) for c in numeric for v in (c, "numeric")], *[F.lit(v) for c in texts for v in (c, "categorical")]
    )
    profile = prep.null_profile(labeled, [*numeric, *texts])
    return profile.select(
        "column_name",
        roles[F.col("column_name")].alias("role"),
        (F.col("row_count") - F.col("null_count")).alias("filled"),
        "row_count",
    )


@query(
    "label_encode",
    f"""WITH {views.LABELED_SQL},
    codes AS (SELECT target_quantile_class, CAST(row_number() OVER (ORDER BY target_quantile_class) - 1 AS int)
                AS label_index FROM (SELECT DISTINCT target_quantile_class FROM labeled))
    SELECT row_id, target_quantile_class, label_index FROM labeled JOIN codes USING (target_quantile_class)""",
)
def label_encode(spark, sf_dir):
    encoded = encode.label_encode(views.labeled(spark, sf_dir), prep.TARGET)
    return encoded.select("row_id", prep.TARGET, "label_index")


@query(
    "ovr_binarize",
    """SELECT o_orderkey AS row_id, c AS "class", CASE WHEN o_orderstatus = c THEN 1 ELSE 0 END AS is_class
       FROM orders, (SELECT unnest(['F', 'O', 'P']) AS c)""",
)
def ovr_binarize(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "row_id")
    return encode.ovr_binarize(orders, "o_orderstatus", views.CLASSES, ["row_id"])


@query(
    "rejected_rows",
    """
    SELECT 'rejected' AS part, event_id,
           concat_ws('|', CASE WHEN event_type IS NULL THEN 'event_type:null' END, CASE WHEN k > 63 THEN 'k:range' END,
                     CASE WHEN value > 60 OR value < 1 THEN 'value:range' END) AS reasons,
           CAST(NULL AS DOUBLE) AS value
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    WHERE k > 63 OR event_type IS NULL OR value > 60 OR value < 1
    UNION ALL
    SELECT 'good', event_id, '', value
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    WHERE NOT (coalesce(k > 63, false) OR event_type IS NULL OR coalesce(value > 60 OR value < 1, false))
    """,
)
def rejected_rows(spark, sf_dir):
    """All events written as CSV and read back under a contract that some of them break."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/events-csv-{uuid.uuid4().hex}"
    k = F.get_json_object("props", "$.k").alias("k")
    events.select("event_id", "event_type", "value", k).write.option("header", True).csv(folder)
    columns = {"event_id": "bigint", "event_type": "string", "value": "double", "k": "int"}
    good, rejected = readers.read_csv_apart(
        spark, folder, {c: (c, kind) for c, kind in columns.items()}, {"value": (1.0, 60.0), "k": (None, 63)}, ["event_type"]
    )
    event = F.split("line", ",")[0].cast("long").alias("event_id")
    no_value = F.lit(None).cast("double").alias("value")
    return rejected.select(F.lit("rejected").alias("part"), event, F.array_join("reasons", "|").alias("reasons"), no_value).unionByName(
        good.select(F.lit("good").alias("part"), "event_id", F.lit("").alias("reasons"), "value")
    )
