"""Sinks: split datasets, small result tables, text reports."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_split(
    df: DataFrame, path: str, stage: str, split: str = "split", fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """One dataset per stage (raw, processed, balanced), partitioned by side of the split.

    The label stays beside its features, so no second file has to be kept in the same order. CSV
    cannot hold vectors; they are written as JSON arrays.
    """
    if fmt == "csv":
        for field in df.schema.fields:
            if isinstance(field.dataType, T.ArrayType):
                df = df.withColumn(field.name, F.to_json(field.name))
            elif field.dataType.typeName() in ("vector", "udt") or "VectorUDT" in str(field.dataType):
                df = df.withColumn(field.name, F.to_json(vector_to_array(field.name)))
    writer = df.write.mode(mode).partitionBy(split)
    target = f"{path.rstrip('/')}/{stage}"
    if fmt == "csv":
        writer.option("header", True).csv(target)
    else:
        writer.parquet(target)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = True) -> None:
    """A result table (one row per model, fold, point ...) as a single headed CSV file.

    Tables that grow with the rows of data are written with ``single_file=False``, a file per task.
    """
    (df.coalesce(1) if single_file else df).write.mode(mode).option("header", True).csv(path)


def write_report(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report lines in order as one text file."""
    lines.orderBy("line_no").select("text").coalesce(1).write.mode(mode).text(path)
