"""Held-out fold and bounded training samples shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves remainder 0 by 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def sample_per_class(rows: DataFrame, label: str, key: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of every class, chosen by a hash of ``key``.

    Classes are counted first (a scan without the texts); a hash threshold then lets about 1.2 times the
    wanted rows through, so the exact cut sorts only those, whatever the size of a class.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("sample")), F.lit(1 << 30))
    share = F.lit(None)
    for value, n in counts.items():
        limit = int(min(1.0, (1.2 * per_class + 50) / n) * (1 << 30))
        share = F.when(F.col(label) == F.lit(value), F.lit(limit)).otherwise(share)
    near = rows.withColumn("_place", place).where(F.col("_place") < share)
    nth = F.row_number().over(Window.partitionBy(label).orderBy("_place", key))
    return near.withColumn("_nth", nth).where(F.col("_nth") <= per_class).drop("_nth", "_place")
