"""Model input: numeric matrix, category codes and standardisation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .categories import fit_categories
from .features import CATEGORICAL_FEATURES, NUMERIC_FEATURES

KEYS = ("transaction_id", "ts", "is_fraud")


def _kept(df: DataFrame, columns: tuple[str, ...] | list[str]) -> list[str]:
    return [name for name in columns if name in df.columns]


def zero_filled(df: DataFrame, columns: list[str] = NUMERIC_FEATURES, keys=KEYS) -> DataFrame:
    """Numbers with missing or unreadable values as 0 (input of the linear model)."""
    numbers = [F.coalesce(C.numeric_or_null(F.col(c)), F.lit(0.0)).alias(c) for c in columns]
    return df.select(*_kept(df, keys), *numbers)


def finite_filled(df: DataFrame, columns: list[str] = NUMERIC_FEATURES, keys=KEYS) -> DataFrame:
    """Numbers with missing, NaN and infinite values as 0 (input of the detectors)."""
    return df.select(*_kept(df, keys), *[C.finite_or_zero(F.col(c)).alias(c) for c in columns])


def with_missing_flags(df: DataFrame, columns: list[str] = NUMERIC_FEATURES, keys=KEYS) -> DataFrame:
    """Zero-filled numbers and one ``*_missing`` flag each (input of the trees).

    Vectors must not hold NaN; the flag lets a tree tell a missing value from 0.
    """
    flags = [C.numeric_or_null(F.col(c)).isNull().cast("double").alias(f"{c}_missing") for c in columns]
    numbers = [F.coalesce(C.numeric_or_null(F.col(c)), F.lit(0.0)).alias(c) for c in columns]
    return df.select(*_kept(df, keys), *numbers, *flags)


def category_encode(
    df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES, keys: tuple[str, ...] = ("transaction_id",)
) -> DataFrame:
    """Codes 0, 1, ... in alphabetical order of the categories, a missing one being a category too."""
    found = fit_categories(df, columns)
    encoded = found.transform(df.select(*keys, *columns), keys[0])
    return encoded.select(*keys, *[f"{c}_code" for c in columns])


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column is only centred."""

    means: dict[str, float]
    deviations: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c) - F.lit(mean)) / F.lit(self.deviations[c] or 1.0)
            for c, mean in self.means.items()
        }
        return df.withColumns(scaled)


def fit_scaler(df: DataFrame, columns: list[str] = NUMERIC_FEATURES) -> Scaler:
    """All means and deviations in one aggregation; only these scalars reach the driver."""
    row = df.agg(
        F.struct(*[F.avg(c).alias(c) for c in columns]).alias("mean"),
        F.struct(*[F.stddev_pop(c).alias(c) for c in columns]).alias("deviation"),
    ).first()
    return Scaler(
        {c: row["mean"][c] or 0.0 for c in columns}, {c: row["deviation"][c] or 0.0 for c in columns}
    )
