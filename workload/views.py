"""Views over the given tables that have the shape of the operators' inputs, in Spark and in SQL.

Nothing is sampled or cut: every view holds all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.functions.hashing import hash_int, hash_key
from meridia.operators import prep
from meridia.session import materialize

CLASSES = ["F", "O", "P"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- readings: lineitem rows play hourly readings; a hundred suppliers make one zone -----------

READINGS_SQL = """
readings AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
         l_shipdate + to_hours(l_linenumber) AS datetime_utc,
         'C' || (l_suppkey // 1000) AS country,
         'Zone ' || (l_suppkey // 100) AS zone_name,
         'Z' || (l_suppkey // 100) AS zone_id,
         l_extendedprice AS carbon_direct,
         l_extendedprice * (1 + l_tax) AS carbon_lifecycle,
         100 * l_discount + 0.0 AS cfe_percent,
         100 * l_tax + 0.0 AS re_percent,
         l_returnflag AS data_source,
         l_linestatus = 'O' AS data_estimated,
         CASE WHEN l_linestatus = 'O' THEN 'MODEL' END AS data_estimation_method,
         'hourly-' || year(l_shipdate + to_hours(l_linenumber)) || '.csv' AS source_file
  FROM lineitem
)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
    zone = F.expr("l_suppkey div 100")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        ts.alias("datetime_utc"),
        F.concat(F.lit("C"), F.expr("l_suppkey div 1000")).alias("country"),
        F.concat(F.lit("Zone "), zone).alias("zone_name"),
        F.concat(F.lit("Z"), zone).alias("zone_id"),
        F.col("l_extendedprice").alias("carbon_direct"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("carbon_lifecycle"),
        (100 * F.col("l_discount") + 0.0).alias("cfe_percent"),
        (100 * F.col("l_tax") + 0.0).alias("re_percent"),
        F.col("l_returnflag").alias("data_source"),
        (F.col("l_linestatus") == "O").alias("data_estimated"),
        F.when(F.col("l_linestatus") == "O", "MODEL").alias("data_estimation_method"),
        F.concat(F.lit("hourly-"), F.year(ts), F.lit(".csv")).alias("source_file"),
    )


# --- daily: the readings rolled up, with calendar parts and gaps -------------------------------


def _mode_sql(column: str) -> str:
    return f"""
mode_{column} AS (
  SELECT country, zone_name, zone_id, date, {column} FROM (
    SELECT *, row_number() OVER (PARTITION BY country, zone_name, zone_id, date
                                 ORDER BY n DESC, {column}) AS rn
    FROM (SELECT country, zone_name, zone_id, CAST(datetime_utc AS date) AS date, {column}, count(*) AS n
          FROM readings WHERE {column} IS NOT NULL GROUP BY ALL)) WHERE rn = 1
)"""


ROLLUP_SQL = (
    READINGS_SQL
    + ","
    + ",".join(_mode_sql(c) for c in prep.TEXTS)
    + """,
rolled AS (
  SELECT country, zone_name, zone_id, CAST(datetime_utc AS date) AS date,
         avg(carbon_direct) AS carbon_direct, avg(carbon_lifecycle) AS carbon_lifecycle,
         avg(cfe_percent) AS cfe_percent, avg(re_percent) AS re_percent,
         max(CAST(data_estimated AS int)) AS data_estimated,
         CAST(sum(CAST(data_estimated AS int)) AS int) AS estimated_hour_flag,
         CAST(count(*) AS int) AS hourly_row_count,
         min(datetime_utc) AS datetime_utc,
         sum(CAST(data_estimated AS int)) / count(*) AS estimated_hour_share
  FROM readings GROUP BY 1, 2, 3, 4
),
daily0 AS (
  SELECT r.*, s.data_source, m.data_estimation_method, f.source_file
  FROM rolled r
  LEFT JOIN mode_data_source s USING (country, zone_name, zone_id, date)
  LEFT JOIN mode_data_estimation_method m USING (country, zone_name, zone_id, date)
  LEFT JOIN mode_source_file f USING (country, zone_name, zone_id, date)
)"""
)

DAILY_SQL = (
    ROLLUP_SQL
    + """,
daily AS (
  SELECT * REPLACE (coalesce(data_estimation_method, 'Unknown') AS data_estimation_method),
         zone_id || '-' || strftime(date, '%Y-%m-%d') AS row_id,
         day(date)::int AS day, month(date)::int AS month, year(date)::int AS year, hour(datetime_utc)::int AS hour,
         (isodow(date) - 1)::int AS day_of_week, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         carbon_lifecycle - carbon_direct AS carbon_intensity_gap, cfe_percent - re_percent AS cfe_re_gap
  FROM daily0
)"""
)

LABELED_SQL = (
    DAILY_SQL
    + """,
edges AS (
  SELECT quantile_cont(carbon_lifecycle, 1.0::double / 3) AS q1, quantile_cont(carbon_lifecycle, 2.0::double / 3) AS q2
  FROM daily
),
labeled AS (
  SELECT daily.*, CASE WHEN carbon_lifecycle <= q1 THEN 'Low' WHEN carbon_lifecycle <= q2 THEN 'Medium'
                       ELSE 'High' END AS target_quantile_class
  FROM daily, edges
)"""
)


def rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prep.daily_rollup(readings(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = prep.impute(rolled(spark, sf_dir), [], ["data_estimation_method"])
    keyed = texts.withColumn("row_id", F.concat_ws("-", "zone_id", F.date_format("date", "yyyy-MM-dd")))
    return prep.gap_features(prep.calendar_parts(keyed))


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table is written once: its quantiles and all that follows read it, not the readings."""
    return prep.quantile_class(materialize(daily(spark, sf_dir), "daily"))


# --- scored: two fixed classifiers over orders, so that SQL can recompute every metric ---------

_A = {"F": (7, 13, 8), "O": (11, 13, 8), "P": (5, 13, 8)}
_B = {"F": (3, 17, 7), "O": (13, 17, 7), "P": (6, 17, 7)}


def _weights_sql(prefix: str, rule: dict) -> str:
    return ", ".join(
        f"1 + (({a} * o_orderkey) % {m}) + CASE WHEN o_orderstatus = '{c}' THEN {bonus} ELSE 0 END AS {prefix}{c}"
        for c, (a, m, bonus) in rule.items()
    )


def _pick_sql(prefix: str) -> str:
    f, o, p = (f"{prefix}{c}" for c in CLASSES)
    return f"CASE WHEN {f} >= {o} AND {f} >= {p} THEN 'F' WHEN {o} >= {p} THEN 'O' ELSE 'P' END"


SCORED_SQL = f"""
weighted AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, {_weights_sql("w", _A)}, {_weights_sql("v", _B)} FROM orders
),
scored AS (
  SELECT o_orderkey AS row_id, o_orderstatus AS y, o_orderpriority AS priority,
         wF::double / (wF + wO + wP) AS p_F, wO::double / (wF + wO + wP) AS p_O, wP::double / (wF + wO + wP) AS p_P,
         {_pick_sql("w")} AS pred_a, {_pick_sql("v")} AS pred_b,
         ('0x' || substr(md5('42:' || o_orderkey), 1, 8))::bigint % 5 AS fold
  FROM weighted
)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def weights(rule: dict) -> dict:
        return {
            c: F.lit(1) + (a * key) % m + F.when(status == c, bonus).otherwise(0) for c, (a, m, bonus) in rule.items()
        }

    def pick(prefix: str):
        f, o, p = (F.col(f"{prefix}{c}") for c in CLASSES)
        return F.when((f >= o) & (f >= p), "F").when(o >= p, "O").otherwise("P")

    wide = orders.select(
        key.alias("row_id"),
        status.alias("y"),
        F.col("o_orderpriority").alias("priority"),
        *[w.alias(f"w{c}") for c, w in weights(_A).items()],
        *[w.alias(f"v{c}") for c, w in weights(_B).items()],
    )
    total = (F.col("wF") + F.col("wO") + F.col("wP")).cast("double")
    return wide.select(
        "row_id",
        "y",
        "priority",
        *[(F.col(f"w{c}") / total).alias(f"p_{c}") for c in CLASSES],
        pick("w").alias("pred_a"),
        pick("v").alias("pred_b"),
        F.pmod(hash_int(hash_key(42, "row_id")), F.lit(5)).alias("fold"),
    )


SCORED_LONG_SQL = (
    SCORED_SQL
    + """,
scored_long AS (
  SELECT row_id, y, priority, fold, 'A' AS model, pred_a AS pred FROM scored
  UNION ALL SELECT row_id, y, priority, fold, 'B', pred_b FROM scored
)"""
)


def scored_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (model, row)."""
    both = F.array(
        F.struct(F.lit("A").alias("model"), F.col("pred_a").alias("pred")),
        F.struct(F.lit("B").alias("model"), F.col("pred_b").alias("pred")),
    )
    return scored(spark, sf_dir).select("row_id", "y", "priority", "fold", F.inline(both))


# --- vectors -----------------------------------------------------------------------------------

DIMENSIONS = 64
VECTORS_SQL = "vectors AS (SELECT vec_id AS row_id, embedding::double[] AS x, label FROM embeddings)"


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("x"), "label"
    )


CUSTOMERS_SQL = """customers AS (SELECT c_custkey AS row_id, [c_acctbal / 1000, c_nationkey::double] AS x,
                             CASE WHEN c_mktsegment = 'BUILDING' THEN 'building' ELSE 'other' END AS label
              FROM customer)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dimensions in which the classes overlap."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row_id"),
        F.array(F.col("c_acctbal") / 1000, F.col("c_nationkey").cast("double")).alias("x"),
        F.when(F.col("c_mktsegment") == "BUILDING", "building").otherwise("other").alias("label"),
    )
