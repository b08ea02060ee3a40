"""Order-preserving ranges that every reader of a table sees alike.

``repartitionByRange`` samples its bounds anew for each plan, so two readers
of one plan can cut it differently. Here the cuts come once from a mergeable
quantile sketch (``percentile_approx``: built in the tasks, merged on the way)
and stand in the plan as literals: a row's range number is a plain expression
of its values, the same in every evaluation. A value that holds several
ranges' worth of rows appears as several equal cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CUTS = 32_768  # literals in a plan


def cut_fractions(ranges: int) -> list[float]:
    """Where ``ranges`` equal parts are cut."""
    return [i / ranges for i in range(1, ranges)]


def cuts_of(value: Column, ranges: int) -> Column:
    """Aggregate: values (bigint) that cut a group into ``ranges`` parts of
    about equal row counts, sorted; null values don't count."""
    return F.percentile_approx(value, F.lit(cut_fractions(ranges)) if ranges <= 64 else
                               F.split(F.lit(",".join(map(repr, cut_fractions(ranges)))), ",").cast("array<double>"),
                               F.lit(max(10_000, 8 * ranges)))


def quantile_cuts(df: DataFrame, value: Column, ranges: int) -> list[int]:
    """The cuts of a whole table on the driver (``MAX_CUTS`` at most)."""
    ranges = min(ranges, MAX_CUTS + 1)
    if ranges < 2:
        return []
    return list(df.agg(cuts_of(value, ranges)).first()[0] or [])


def literal_cuts(cuts: list[int]) -> Column:
    """The cuts as one array literal."""
    if not cuts:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")


def cuts_below(value: Column, cuts: Column, most: int = MAX_CUTS, equal: bool = True) -> Column:
    """How many of the sorted ``cuts`` (an array column of at most ``most``)
    are at most ``value`` (``equal=False``: less than it), by halving."""
    steps = F.sequence(F.lit(max(most, 1).bit_length() - 1), F.lit(0), F.lit(-1))

    def halve(lo: Column, step: Column) -> Column:
        at = lo + F.call_function("shiftleft", F.lit(1), step)
        cut = F.get(cuts, at - 1)
        return F.when((cut <= value) if equal else (cut < value), at).otherwise(lo)

    return F.aggregate(steps, F.lit(0), halve)


def with_cuts_below(df: DataFrame, col: str, value: Column, cuts: Column, most: int) -> DataFrame:
    """``cuts_below`` as column ``col``, a projection per halving: the steps
    are compiled, where those of an aggregate are interpreted."""
    out = df.withColumn(col, F.lit(0))
    for step in range(max(most, 1).bit_length() - 1, -1, -1):
        at = F.col(col) + F.lit(1 << step)
        out = out.withColumn(col, F.when(F.get(cuts, at - 1) <= value, at).otherwise(F.col(col)))
    return out


def range_number(value: Column, cuts: list[int], tie: Column | None = None) -> Column:
    """Range 0 to len(cuts) of a row, rising with ``value``. Where a value is
    cut several times its rows spread over those ranges by ``tie`` (bigint,
    rising with it)."""
    array = literal_cuts(cuts)
    upto = cuts_below(value, array, len(cuts))
    if tie is None or len(set(cuts)) == len(cuts):
        return upto
    before = cuts_below(value, array, len(cuts), equal=False)
    share = (tie.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    spread = before + 1 + F.floor(share * (upto - before)).cast("int")
    return F.when(upto - before > 1, F.least(spread, upto)).otherwise(upto)
