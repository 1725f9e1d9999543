"""Result tables and the tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import signed

RESULT_METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_macro"]


def metrics_long(results: DataFrame, by: Sequence[str] = ("model",), metrics: Sequence[str] = tuple(RESULT_METRICS)) -> DataFrame:
    """Wide metric columns to (metric, score) rows for grouped bars."""
    return results.unpivot(list(by), list(metrics), "metric", "score")


def topk(df: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    """The k rows with the highest value; ties by name."""
    return df.orderBy(F.col(value).desc(), F.col(tie)).limit(k)


def importance_filter(importances: DataFrame, factor: float = 0.05, value: str = "importance") -> DataFrame:
    """Each feature with the threshold ``factor * mean`` and whether it is kept. One row per feature."""
    mean = importances.agg(F.avg(value)).first()[0]
    threshold = None if mean is None else mean * factor
    return importances.withColumn("threshold", F.lit(threshold).cast("double")).withColumn(
        "kept", (F.col(value) >= F.col("threshold")).cast("int")
    )


def phase_comparison(
    current: DataFrame, baseline: DataFrame, metrics: Sequence[str], delta_of: str, model: str = "model"
) -> DataFrame:
    """Current results beside an earlier run's; a model without baseline shows ``-`` and a delta from 0.

    Both tables hold one row per model.
    """
    old = baseline.select(model, *[F.col(m).alias(f"old_{m}") for m in metrics])
    joined = current.select(model, *metrics).join(old, model, "left")
    delta = F.round(F.col(delta_of) - F.coalesce(f"old_{delta_of}", F.lit(0.0)), 4)
    shown = []
    for m in metrics:
        text = F.format_string("%.4f", F.col(f"old_{m}"))
        shown += [
            F.when(F.col(f"old_{m}").isNull(), F.lit("-")).otherwise(text).alias(f"before_{m}"),
            F.format_string("%.4f", F.col(m)).alias(f"after_{m}"),
        ]
    return joined.select(model, *shown, signed(delta).alias(f"delta_{delta_of}"))
