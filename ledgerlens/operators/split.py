"""Chronological train / validation / test split of the labeled timeline."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import naive_instant
from .quantiles import kth_values

# Default shares of the labeled timeline.
TRAIN_FRACTION = 0.70
VALID_FRACTION = 0.15


@dataclass(frozen=True)
class TimeSplit:
    """Labeled rows with a ``split`` column, and the two last instants of train and validation."""

    rows: DataFrame
    train_end: datetime
    valid_end: datetime
    train_fraction: float
    valid_fraction: float

    def part(self, name: str) -> DataFrame:
        """One part, as a range filter on ``ts`` that reaches the Parquet scan."""
        ts = F.col("ts")
        train_end, valid_end = naive_instant(self.train_end), naive_instant(self.valid_end)
        inside = {
            "train": ts <= train_end,
            "valid": (ts > train_end) & (ts <= valid_end),
            "test": ts > valid_end,
        }
        return self.rows.filter(inside[name])


def time_split(
    features: DataFrame,
    train_fraction: float = TRAIN_FRACTION,
    valid_fraction: float = VALID_FRACTION,
    label: str = "is_fraud",
    ts: str = "ts",
) -> TimeSplit:
    """Cut the labeled rows at the instants found at two positions of the time order.

    The row at a position and everything that shares its instant stay in the
    earlier part.
    """
    labeled = features.filter(F.col(label).isNotNull())
    instants = {
        row["name"]: row["value"]
        for row in kth_values(
            labeled,
            ts,
            lambda n: {
                "train": F.floor(n.cast("double") * F.lit(train_fraction)),
                "valid": F.floor(n.cast("double") * F.lit(train_fraction + valid_fraction)),
            },
        ).collect()
    }
    if not instants:
        raise ValueError("no labeled rows to split; check the label source")
    if len(instants) < 2:
        raise ValueError("the train and validation shares leave no test window")
    train_end, valid_end = naive_instant(instants["train"]), naive_instant(instants["valid"])
    part = (
        F.when(F.col(ts) <= train_end, "train")
        .when(F.col(ts) <= valid_end, "valid")
        .when(F.col(ts) > valid_end, "test")
    )
    return TimeSplit(
        labeled.withColumn("split", part),
        instants["train"],
        instants["valid"],
        train_fraction,
        valid_fraction,
    )


def split_summary(split: TimeSplit, label: str = "is_fraud") -> DataFrame:
    """Sizes, positives, test base rate, shares and boundaries of a split in one row."""

    def size(name: str):
        return F.count_if(F.col("split") == name).alias(name)

    test_rate = F.avg(F.when(F.col("split") == "test", F.col(label)))
    return split.rows.agg(
        size("train"), size("valid"), size("test"), test_rate.alias("test_base_rate")
    ).select(
        "*",
        F.lit(split.train_fraction).alias("train_frac"),
        F.lit(split.valid_fraction).alias("valid_frac"),
        F.lit(round(1.0 - split.train_fraction - split.valid_fraction, 10)).alias("test_frac"),
        F.lit(str(split.train_end)).alias("train_end"),
        F.lit(str(split.valid_end)).alias("valid_end"),
    )
