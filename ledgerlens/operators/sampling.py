"""Repeatable random samples: rows are drawn in the order of a hash of their id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: negative rows in the fit of the linear model.
BASELINE_NEGATIVES = 500_000

_DIGITS_AT_ONCE = 3
# Digits of the edges of a stretch: it is never narrower than a hash can tell.
_EDGE_DIGITS = 12


def draw_order(key: str, seed: str = "") -> Column:
    """Hash that decides who is drawn first; other seeds give other samples. A missing key is a value too."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("(none)"))
    return F.md5(F.concat(F.lit(seed), text) if seed else text)


def sample_fixed_n(df: DataFrame, n: int, key: str, seed: str = "") -> DataFrame:
    """Exactly ``n`` random rows without replacement; the whole table if it has no more.

    Rows are drawn in the order of a hash of their key, rows of one key in the order of a hash of all their columns. The sample is a filter on the hash,
    which stays spread over all tasks; nothing is sorted. Hashes of distinct keys are uniform, so the last one wanted lies in a stretch of about
    ``12 * sqrt(n)`` rows that is known beforehand: one job counts what lies before the stretch and lists its hashes. Where keys repeat so often that
    the stretch misses the place, it is found by counting hashes by their digits. All columns are hashed only for rows of the one key that is cut.
    Of rows equal in every column it does not matter which are taken.
    """
    total = df.count()
    if total <= n:
        return df
    hashes = df.select(draw_order(key, seed).alias("hash"))
    found = _in_stretch(hashes, n, total) or _by_digits(hashes, n, 32)
    last, wanted, held = found
    if wanted == held:
        return df.filter(draw_order(key, seed) <= last)
    before = df.filter(draw_order(key, seed) < last)
    if not wanted:
        return before
    cut = df.filter(draw_order(key, seed) == last)
    whole = F.lower(F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), 16, "0"))
    last, wanted, held = _by_digits(cut.select(whole.alias("hash")), wanted, 16)
    some = cut.filter(whole < last).unionByName(cut.filter(whole == last).limit(wanted) if wanted < held else cut.filter(whole == last))
    return before.unionByName(some)


def _in_stretch(hashes: DataFrame, n: int, total: int) -> tuple[str, int, int] | None:
    """(the hash that row ``n`` has, how many of its rows are wanted, how many it has), or None if it lies outside the stretch."""
    spread = 6 * math.sqrt(n) + 50
    edges = [max(0, int((n - spread) / total * 16**_EDGE_DIGITS)), min(16**_EDGE_DIGITS - 1, int((n + spread) / total * 16**_EDGE_DIGITS))]
    low, high = (format(e, f"0{_EDGE_DIGITS}x") for e in edges)
    near = hashes.filter(F.substring("hash", 1, _EDGE_DIGITS) <= high)
    counts = near.groupBy(F.when(F.col("hash") < low, F.lit("")).otherwise(F.col("hash")).alias("h")).agg(F.count("*").alias("n"))
    most = int(4 * spread) + 1000
    rows = counts.limit(most + 1).collect()
    if len(rows) > most:
        return None
    left = n
    for row in sorted(rows, key=lambda r: r["h"]):
        if left <= row["n"]:
            return (row["h"], left, row["n"]) if row["h"] else None
        left -= row["n"]
    return None


def _by_digits(hashes: DataFrame, n: int, length: int) -> tuple[str, int, int]:
    """The same for any hashes of ``length`` digits: counted by their first digits, then inside one stretch by the next. Each count is at most 4096 numbers."""
    prefix, wanted = "", n
    while len(prefix) < length:
        at, digits = len(prefix), min(_DIGITS_AT_ONCE, length - len(prefix))
        inside = hashes.filter(F.col("hash").startswith(prefix)) if prefix else hashes
        counts = inside.groupBy(F.substring("hash", at + 1, digits).alias("d")).agg(F.count("*").alias("n")).collect()
        for row in sorted(counts, key=lambda r: r["d"]):
            if wanted <= row["n"]:
                break
            wanted -= row["n"]
        prefix += row["d"]
    return prefix, wanted, row["n"]


def sample_then_filter(df: DataFrame, n: int, key: str, condition: Column, seed: str = "") -> DataFrame:
    """Sample first, filter after: fewer than ``n`` rows remain when the filter rejects some."""
    return sample_fixed_n(df, n, key, seed).filter(condition)


def stratified_subsample(
    df: DataFrame, max_negatives: int, key: str, label: str = "is_fraud", seed: str = ""
) -> DataFrame:
    """Every positive row and at most ``max_negatives`` random negative rows."""
    negatives = sample_fixed_n(df.filter(F.col(label) == 0), max_negatives, key, seed)
    return df.filter(F.col(label) == 1).unionByName(negatives)
