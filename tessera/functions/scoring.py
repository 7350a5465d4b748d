"""Popularity on logarithmic scales, and the order of publication."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (signal, ceiling, weight) in the order they are added up.
SIGNALS = (("github_stars", 100_000, 0.45), ("npm_downloads_monthly", 10_000_000, 0.35), ("smithery_use_count", 100_000, 0.20))
COVERAGE_FLOOR, DECIMALS = 0.85, 4
TIERS = ("curated", "registry_verified", "smithery_verified", "indexed")


def signal(value: Column, ceiling: int) -> Column:
    """A count between 0 and 1; null stays null."""
    if ceiling <= 0:
        return F.when(value.isNotNull(), F.lit(0.0))
    scaled = F.log1p(F.greatest(value, F.lit(0))) / F.log1p(F.lit(ceiling))
    return F.when(value.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), scaled)))


def rounded(value: Column, decimals: int = DECIMALS) -> Column:
    """A number of moderate size, rounded by its exact binary value, halves to the even digit.

    (F.round takes the short decimal that the number is written as: 0.00015, which lies just below, would go up.)
    """
    twice = F.lit(2.0 * 10**decimals)
    below = F.floor(value * twice / 2).cast("double")
    # value * twice is high + low with no error left: split in two halves, each product is exact.
    parted = value * F.lit(134217729.0)
    head = parted - (parted - value)
    high = value * twice
    low = (head * twice - high) + (value - head) * twice
    beyond = (high - (2 * below + 1)) + low
    up = (beyond > 0) | ((beyond == 0) & (below % 2 != 0))
    return (below + F.when(up, F.lit(1.0)).otherwise(0.0)) / F.lit(float(10**decimals))


def popularity(parts: list[tuple[Column, int, float]]) -> Column:
    """The weighted mean of the signals that are there, lowered for those that aren't."""
    zero, seen, total = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for value, ceiling, weight in parts:
        x = signal(value, ceiling)
        seen = seen + F.when(x.isNotNull(), F.lit(weight)).otherwise(zero)
        total = total + F.coalesce(x * F.lit(weight), zero)
    share = seen / F.lit(sum(w for _, _, w in parts))
    return F.when(seen > 0, rounded(total / seen * (F.lit(COVERAGE_FLOOR) + F.lit(1 - COVERAGE_FLOOR) * share))).otherwise(zero)


def tier_rank(tier: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(t) for t in TIERS]), tier), F.lit(0)) - 1, F.lit(len(TIERS))).cast("int")
