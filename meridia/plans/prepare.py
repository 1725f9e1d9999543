"""Raw readings to finished tables.

The daily table and the flagged table are written once to the shared folder; the steps between are lazy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import outliers, prep, split
from ..session import materialize
from . import reports


@dataclass(frozen=True)
class PreparedTables:
    merged: DataFrame
    cleaned: DataFrame
    with_target: DataFrame
    flagged: DataFrame
    features: DataFrame
    monthly: DataFrame
    null_profile: DataFrame
    class_balance: DataFrame

    def report(self) -> DataFrame:
        sizes = [("merged", self.merged.count()), ("cleaned", self.cleaned.count()), ("final", self.features.count())]
        return reports.preparation_report(self.null_profile, self.class_balance, sizes)


# A percentage lies in 0..100 and an intensity is not negative.
RANGES = {
    "carbon_direct": (0.0, None),
    "carbon_lifecycle": (0.0, None),
    "cfe_percent": (0.0, 100.0),
    "re_percent": (0.0, 100.0),
}
CHECKED = [*prep.MEASURES, "carbon_intensity_gap", "cfe_re_gap"]


def prepare(
    readings: DataFrame,
    keys: Sequence[str] = tuple(prep.ZONE_KEYS),
    classed_by: str = "carbon_lifecycle",
    iqr_factor: float = 1.5,
    z_limit: float = 3.0,
    contamination: float = 0.05,
    consensus: int = 2,
    drop_outliers: bool = False,
    seed: int = 42,
) -> PreparedTables:
    """Daily rollup, cleaning, classes, calendar and gap features, outlier flags, monthly table.

    ``row_id`` (keys and day) goes with every row. The measure the class is cut from stays among the
    features unless the caller drops it, so scores near 1 are partly the cut itself.
    """
    merged = prep.daily_rollup(readings, keys)
    order = [F.col("hourly_row_count").desc(), *[F.col(m) for m in prep.MEASURES]]
    cleaned = prep.clean(merged, [*keys, "date"], order, RANGES, at_least=[("carbon_lifecycle", "carbon_direct")])
    # everything below reads the daily table several times; the readings are scanned once
    cleaned = materialize(cleaned, "daily")
    filled = prep.impute(cleaned, prep.MEASURES, ["data_source", "data_estimation_method"])
    keyed = filled.withColumn("row_id", F.concat_ws("|", *keys, F.date_format("date", "yyyy-MM-dd")))
    shaped = prep.gap_features(prep.calendar_parts(keyed))
    with_target = prep.quantile_class(shaped, classed_by)
    flagged = outliers.zscore_outliers(outliers.iqr_outliers(with_target, CHECKED, iqr_factor), CHECKED, z_limit)
    flagged = outliers.isolation_forest(flagged, CHECKED, "row_id", contamination, seed=seed)
    signals = ["iqr_outlier_count", "zscore_outlier_count", "isolation_forest_flag"]
    flagged = outliers.outlier_consensus(flagged, signals, consensus)
    flagged = materialize(flagged, "flagged")
    final = flagged.where("outlier_consensus_flag = 0") if drop_outliers else flagged
    features = prep.finalize(final, extra=["row_id"])
    sides = split.stratified_split(features, prep.TARGET, "row_id", seed=seed)
    balance = prep.class_balance_compare(features, sides.where("split = 'train'"), prep.TARGET)
    return PreparedTables(
        merged=merged,
        cleaned=cleaned,
        with_target=with_target,
        flagged=flagged,
        features=features,
        monthly=prep.monthly_aggregate(features),
        null_profile=prep.null_profile(cleaned, [*prep.MEASURES, *prep.TEXTS]),
        class_balance=balance,
    )
