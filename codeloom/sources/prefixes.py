"""A mapping stored for prefix queries: codes and slot packed into one number, rows sorted by it.

The first level takes the highest bits, so the rows under a prefix are an interval of the key. Files hold ranges of the
key and row groups hold narrower ones, so a query reads those that its interval touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.names import DEDUP, PREFIX_KEY, check_mapping

#: Ranges of the key in the filter of a scan; more intervals are covered by fewer, wider ranges.
MOST_RANGES = 64


@dataclass(frozen=True)
class PrefixLayout:
    """Bits of each code level and, last, of the slot."""

    bits: tuple[int, ...]

    def __post_init__(self):
        if sum(self.bits) > 63:
            raise ValueError(f"codes and slot need {sum(self.bits)} bits, a key has 63")

    def below(self, count: int) -> int:
        """Bits of the columns after the first `count`."""
        return sum(self.bits[count:])

    def key(self, columns: list[str]) -> Column:
        parts = [F.shiftleft(F.col(name).cast("long"), self.below(i + 1)) for i, name in enumerate(columns)]
        return sum(parts[1:], parts[0])

    def prefix(self, count: int) -> Column:
        """What the keys under a prefix of `count` columns have in common."""
        return F.shiftright(PREFIX_KEY, self.below(count))

    def value(self, tokens: str, count: int) -> Column:
        """The same for the tokens of a query; NULL if one is larger than any code."""
        parts, fits = [], F.lit(True)
        for i in range(count):
            token = F.col(tokens)[i]
            fits &= (token >= 0) & (token < (1 << self.bits[i]))
            parts.append(F.shiftleft(F.when(fits, token), self.below(i + 1) - self.below(count)))
        return sum(parts[1:], parts[0])

    def inside(self, intervals: list[tuple[int, int]]) -> Column:
        """A filter on the key that holds on all intervals (both ends included), as a few ranges."""
        ranges = covered(intervals, MOST_RANGES)
        found = F.lit(False)
        for low, high in ranges:
            found |= F.col(PREFIX_KEY).between(low, high)
        return found


def covered(intervals: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """At most `most` ranges that hold all intervals, with the widest gaps left out."""
    merged: list[list[int]] = []
    for low, high in sorted(intervals):
        if merged and low <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    gaps = sorted(range(1, len(merged)), key=lambda i: merged[i - 1][1] - merged[i][0])[: most - 1]
    starts = [0, *sorted(gaps)] if merged else []
    return [(merged[a][0], merged[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(merged)])]


def layout_of(mapping: DataFrame) -> PrefixLayout:
    columns = [*check_mapping(mapping.columns), DEDUP]
    largest = mapping.agg(*[F.max(c).alias(c) for c in columns], F.least(*[F.min(c) for c in columns]).alias("least_")).first()
    if (largest["least_"] or 0) < 0:
        raise ValueError("codes and slots must not be negative")
    return PrefixLayout(tuple(max(1, int(largest[c] or 0).bit_length()) for c in columns))


def write_prefix_table(mapping: DataFrame, path: str) -> PrefixLayout:
    """Write the mapping sorted by its key; the layout is written last, so a table without one is not finished."""
    columns = [*check_mapping(mapping.columns), DEDUP]
    layout = layout_of(mapping)
    keyed = mapping.withColumn(PREFIX_KEY, layout.key(columns))
    keyed.repartitionByRange(PREFIX_KEY).sortWithinPartitions(PREFIX_KEY).write.mode("errorifexists").parquet(f"{path}/rows")
    bits = mapping.sparkSession.createDataFrame(list(enumerate(layout.bits)), "position int, bits int")
    bits.coalesce(1).write.mode("errorifexists").parquet(f"{path}/layout")
    return layout


def read_prefix_table(spark: SparkSession, path: str) -> tuple[DataFrame, PrefixLayout]:
    bits = spark.read.parquet(f"{path}/layout").orderBy("position").collect()
    return spark.read.parquet(f"{path}/rows"), PrefixLayout(tuple(r["bits"] for r in bits))
