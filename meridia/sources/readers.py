"""Scans, their contracts, and the union of tagged sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridia.session import materialize

# Documented headers of the raw hourly files; beside them our names and types.
HOURLY_COLUMNS = {
    "Datetime (UTC)": ("datetime_utc", "timestamp_ntz"),
    "Country": ("country", "string"),
    "Zone name": ("zone_name", "string"),
    "Zone id": ("zone_id", "string"),
    "Carbon intensity gCO₂eq/kWh (direct)": ("carbon_direct", "double"),
    "Carbon intensity gCO₂eq/kWh (Life cycle)": ("carbon_lifecycle", "double"),
    "Carbon-free energy percentage (CFE%)": ("cfe_percent", "double"),
    "Renewable energy percentage (RE%)": ("re_percent", "double"),
    "Data source": ("data_source", "string"),
    "Data estimated": ("data_estimated", "boolean"),
    "Data estimation method": ("data_estimation_method", "string"),
}


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table, or an error that lists the absent columns. Runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {missing}")
    return df


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, tuple[str, str]] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Header CSV. ``columns`` maps headers to a name and a type; without it the types are inferred.

    Columns are found by their header, wherever they stand; a header that is absent, from any of the files, is
    an error, and so is a value that does not fit its type. Our own names are taken as headers too.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if columns is None:
        return _checked(lambda: reader.option("inferSchema", True).csv(paths), path, required)
    found = _checked(lambda: reader.csv(paths), path, ())
    by_name = {h if h in found.columns or name not in found.columns else name: (name, kind)
               for h, (name, kind) in columns.items()}
    require_columns(found, list(by_name))
    chosen = [F.col(f"`{h}`").cast(kind).alias(name) for h, (name, kind) in by_name.items()]
    file_name = F.col("_metadata.file_name").alias("source_file")
    return require_columns(found.select(*chosen, file_name), required)


def read_csv_apart(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Mapping[str, tuple[str, str]],
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
    needed: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Header CSV in two tables: the rows that meet the contract, and the others as they stand with their reasons.

    ``columns`` is that of ``read_csv``; ``ranges`` gives closed bounds by our names and ``needed`` lists names
    that may not be null. Rejected rows have ``source_file``, ``reasons`` (sorted ``name:kind``, kind one of type, range
    and null; ``fields`` where a line has too many or too few of them) and ``line``, the raw fields as CSV. A null, or an
    empty field, fits every type and range. Files are read once; every line is in exactly one of the two tables.
    """
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("enforceSchema", False)
    found = _checked(lambda: reader.csv(paths), path, ()).columns
    by_name = {h if h in found or name not in found else name: (name, kind) for h, (name, kind) in columns.items()}
    missing = [h for h in by_name if h not in found]
    if missing:
        raise ValueError(f"required columns not found: {missing}")
    texts = T.StructType([T.StructField(h, T.StringType()) for h in [*found, "__torn"]])
    raw = reader.schema(texts).option("columnNameOfCorruptRecord", "__torn").csv(paths)

    torn = F.col("__torn").isNotNull()
    reasons = [F.when(torn, F.lit("fields"))]
    made = []
    for h, (name, kind) in by_name.items():
        text = F.col(f"`{h}`")
        value = text.try_cast(kind)
        low, high = (ranges or {}).get(name, (None, None))
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < F.lit(low))
        if high is not None:
            outside = outside | (value > F.lit(high))
        problem = F.when(text.isNotNull() & value.isNull(), "type").when(outside, "range")
        if name in needed:
            problem = problem.when(text.isNull(), "null")
        reasons.append(F.when(~torn, F.concat(F.lit(f"{name}:"), problem)))
        made.append(value.alias(name))
    line = F.coalesce("__torn", F.to_csv(F.struct(*(F.col(f"`{h}`") for h in found))))
    reasons = F.sort_array(F.array_compact(F.array(*reasons)))
    rows = raw.select(*made, F.col("_metadata.file_name").alias("source_file"), reasons.alias("__reasons"), line.alias("__line"))
    rows = rows.withColumn("__line", F.when(F.size("__reasons") > 0, F.col("__line")))
    rows = materialize(rows, "contract")
    good = rows.where(F.size("__reasons") == 0).drop("__reasons", "__line")
    rejected = rows.where(F.size("__reasons") > 0)
    return good, rejected.select("source_file", F.col("__reasons").alias("reasons"), F.col("__line").alias("line"))


def read_hourly_apart(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``read_hourly`` with the rows that don't fit their types apart; a row without its time or zone is one of them."""
    return read_csv_apart(spark, paths, HOURLY_COLUMNS, needed=["datetime_utc", "zone_id"])


def read_parquet(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    return _checked(lambda: spark.read.parquet(path), path, required)


def _checked(load, path, required) -> DataFrame:
    try:
        return require_columns(load(), required)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"input not found: {path}") from error
        raise


def read_hourly(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All yearly files in one scan, each row tagged with the name of its file."""
    return read_csv(spark, paths, HOURLY_COLUMNS)


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "source_file") -> DataFrame:
    """Union by column name; a column a part lacks is null there, and each row names its part."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
