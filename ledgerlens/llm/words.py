"""Words of a text as native arrays, and hashes over them, for operators that stay in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, text_or_empty

#: Separators: every ASCII character but digits and letters. All others are part of a word.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text, A-Z in lower case; a null text has none."""
    return F.filter(F.split(ascii_lower(text_or_empty(text)), SEPARATORS), lambda w: w != "")


def places(n: Column) -> Column:
    """0 to n - 1; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def hashed_places(df: DataFrame, array: str, masks: list[tuple[int, ...]]) -> Column:
    """For each place of the array of hashes, one hash for each mask: of the entries the mask names from there on.

    The flat result has ``len(masks)`` entries a place. Entries beyond the end are null and change the hash.
    """
    def one(i: Column) -> Column:
        return F.array(*[F.xxhash64(F.lit(k), *[F.get(F.col(array), i + j) for j in mask]) for k, mask in enumerate(masks)])

    return F.flatten(F.transform(places(F.size(array)), one))
