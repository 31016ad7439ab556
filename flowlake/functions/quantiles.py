"""Percentiles with linear interpolation, for groups of any size: exact ones, and mergeable sketches.

The built-in exact percentile keeps every distinct value of a group in the memory of one task. Here a wanted
rank is found by radix selection: a double is taken apart into digits that order like the value (sign, exponent
and leading mantissa bits; then the rest of the mantissa in three digits), without rounding. One read of the rows
counts the first digit, map-side; a second keeps the distinct values of the buckets that hold a wanted rank.
Only these are refined, digit by digit, where they are too many for one window.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.runtime import checked_lookup, stored

# Mantissa bits of the first digit and of the others. A window sees at most 2 * 2100 * 2^8 rows of a group for
# the first digit and 2^15 for another; or this many distinct values, if a bucket holds no more.
_FIRST_BITS, _BITS = 8, (15, 15, 14)
WINDOW_ROWS = 1 << 16
_EXPONENTS = 1_075  # added to exponents, which start at -1074


def _digits(df: DataFrame, value: str, more: bool = False) -> DataFrame:
    """Add ``__d0``, and with ``more`` the later digits: their order is that of the value.

    Dividing by a power of two and multiplying by one are exact, so nothing is rounded. NaN orders last.
    """
    size = F.abs(F.col(value))
    two = F.lit(2.0)
    finite = (size > 0) & (size < float("inf"))
    guess = F.when(finite, F.floor(F.log2(size))).otherwise(0).cast("int")
    df = df.withColumn("__e", guess)
    # The logarithm may be off by one next to a power of two.
    over, under = size >= F.pow(two, F.col("__e") + 1), size < F.pow(two, F.col("__e"))
    exact = F.when(~finite, F.col("__e")).when(over, F.col("__e") + 1).when(under, F.col("__e") - 1).otherwise(F.col("__e"))
    df = df.withColumn("__e", exact)
    fraction = F.when(finite, (size / F.pow(two, F.col("__e")) - 1.0) * (1 << _FIRST_BITS)).otherwise(0.0)
    df = df.withColumns({"__f": fraction, "__s": F.when(F.col(value) < 0, -1).otherwise(1)})
    first = (F.col("__e") + _EXPONENTS) * (1 << _FIRST_BITS) + F.floor("__f")
    beyond = 4 * _EXPONENTS * (1 << _FIRST_BITS)
    first = F.when(finite, first).when(size == 0, 0).when(F.isnan(size), 2 * beyond).otherwise(beyond)
    df = df.withColumn("__d0", (F.when(F.isnan(size), 1).otherwise(F.col("__s")) * first).cast("bigint"))
    for i, bits in enumerate(_BITS if more else (), 1):
        df = df.withColumn("__f", (F.col("__f") - F.floor("__f")) * (1 << bits))
        df = df.withColumn(f"__d{i}", (F.col("__s") * F.floor("__f")).cast("bigint"))
    return df.drop("__e", "__f", "__s")


def _same(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    condition = F.lit(True)
    for c in cols:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def _wanted_ranks(probabilities: list[float]) -> dict[str, Column]:
    last = F.col("__n") - 1
    ranks = {}
    for i, p in enumerate(probabilities):
        position = last * F.lit(float(p))
        ranks[f"__lo{i}"] = F.floor(position).cast("bigint")
        ranks[f"__hi{i}"] = F.ceil(position).cast("bigint")
    return ranks


def _hit(ranks: list[str]) -> Column:
    found = F.lit(False)
    for r in ranks:
        found = found | ((F.col("__start") <= F.col(r)) & (F.col(r) < F.col("__start") + F.col("__c")))
    return found


def _narrowed(found: DataFrame, part: list[str], digit: str, ranks: list[str]) -> DataFrame:
    """Of the distinct values ``found`` (with ``__start`` rows before their bucket) the digits with a wanted rank."""
    counted = found.groupBy(*part, digit, "__start", *ranks).agg(F.sum("__c").alias("__c"), F.max("__v").alias("__top"))
    upto = Window.partitionBy(*part).orderBy(digit).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("__start", F.col("__start") + F.sum("__c").over(upto) - F.col("__c"))
    return counted.where(_hit(ranks))


def distribution(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    group: list[str] | None = None,
    total: str | None = None,
) -> DataFrame:
    """Per group: ``n``, ``avg``, ``min``, ``max`` and the named percentiles of ``value``.

    Nulls are not counted. Without groups the result is one row, also for empty input (zeros). ``total`` names
    a column for the sum of the values. The rows are read twice.
    """
    by = list(group or [])
    names, probs = list(probabilities), list(probabilities.values())
    values = df.select(*by, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    values = _digits(values, "__v")

    counted = values.groupBy(*by, "__d0").agg(
        F.count(F.lit(1)).alias("__c"),
        F.sum("__v").alias("__sum"),
        F.min("__v").alias("__min"),
        F.max("__v").alias("__max"),
    )
    counted = stored(counted, "digits")
    stats = counted.groupBy(*by).agg(
        F.coalesce(F.sum("__c"), F.lit(0)).alias("n"),
        F.sum("__sum").alias("__total"),
        (F.sum("__sum") / F.sum("__c")).alias("avg"),
        F.min("__min").alias("min"),
        F.max("__max").alias("max"),
    )

    whole = Window.partitionBy(*by)
    upto = whole.orderBy("__d0").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.select(
        *by,
        "__d0",
        "__c",
        F.sum("__c").over(whole).alias("__n"),
        (F.sum("__c").over(upto) - F.col("__c")).alias("__start"),
    ).withColumns(_wanted_ranks(probs))
    ranks = list(_wanted_ranks(probs))
    wanted = ranked.where(_hit(ranks)).drop("__c", "__n")
    # At most two buckets per percentile and group.
    wanted = checked_lookup(wanted, "ranks") if by else F.broadcast(wanted)

    border = [*by, "__d0"]
    by_value = values.join(wanted, _same(values, wanted, border), "left_semi")
    by_value = by_value.groupBy(*border, "__v").agg(F.count(F.lit(1)).alias("__c"))
    by_value = stored(_digits(by_value, "__v", more=True), "border")
    most = by_value.groupBy(*border).count().agg(F.max("count")).first()[0] or 0
    digits = ["__v"] if most <= WINDOW_ROWS else [f"__d{i}" for i in range(1, len(_BITS) + 1)]
    part, picked = border, wanted
    for digit in digits:
        right = picked.select(*[F.col(c).alias(f"__of_{c}") for c in part], "__start", *ranks)
        same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in part]
        found = by_value.join(F.broadcast(right) if digit != digits[0] else right, reduce(and_, same))
        picked = _narrowed(found.select(*by_value.columns, "__start", *ranks), part, digit, ranks)
        part = [*part, digit]

    def at(r: str) -> Column:
        inside = (F.col("__start") <= F.col(r)) & (F.col(r) < F.col("__start") + F.col("__c"))
        return F.max(F.when(inside, F.col("__top")))

    picked = picked.groupBy(*by).agg(*[at(r).alias(f"__at{r}") for r in ranks])

    at_columns = [f"__at{r}" for r in ranks]
    kept = ["n", "__total", "avg", "min", "max"]
    if by:
        joined = stats.join(picked, _same(stats, picked, by)).select(*[stats[c] for c in by], *kept, *at_columns)
    else:
        found = stats.withColumn("__at", picked.select(F.struct(*at_columns)).scalar())
        joined = found.select(*kept, "__at.*")
    zero = F.lit(0.0)
    percentiles = []
    for i, (name, p) in enumerate(zip(names, probs)):
        low, high = F.col(f"__at__lo{i}"), F.col(f"__at__hi{i}")
        position = (F.col("n") - 1) * F.lit(float(p))
        percentiles.append(F.coalesce(low + (high - low) * (position - F.floor(position)), zero).alias(name))
    return joined.select(
        *by,
        "n",
        *[F.coalesce(c, zero).alias(c) for c in ("avg", "min", "max")],
        *percentiles,
        *([F.coalesce("__total", zero).alias(total)] if total else []),
    )


def approximate_distribution(
    df: DataFrame, value: str, probabilities: dict[str, float], group: list[str] | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """The same columns in one pass, percentiles from a bounded sketch."""
    v = F.col(value).cast("double")
    zero = F.lit(0.0)
    sketch = F.percentile_approx(v, list(probabilities.values()), accuracy).alias("__p")
    stats = df.groupBy(*(group or [])).agg(
        F.count(v).alias("n"), F.avg(v).alias("avg"), F.min(v).alias("min"), F.max(v).alias("max"), sketch
    )
    return stats.select(
        *(group or []),
        "n",
        *[F.coalesce(c, zero).alias(c) for c in ("avg", "min", "max")],
        *[F.coalesce(F.col("__p")[i], zero).alias(name) for i, name in enumerate(probabilities)],
    )


# Size of a sketch, and the share of the rows by which the rank of one of its values is off at most (99 times of 100).
SKETCH_K = 1_024
RANK_ERROR = 2.296 / SKETCH_K**0.9021


def sketches(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """Per group ``n, sum, min, max`` of ``value`` and a KLL ``sketch`` of it: a few KB, to be stored and merged.

    Nulls are not counted; a group without values has a null sketch.
    """
    v = F.col(value).cast("double")
    return df.groupBy(*(group or [])).agg(
        F.count(v).alias("n"),
        F.sum(v).alias("sum"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.when(F.count(v) > 0, F.kll_sketch_agg_double(v, F.lit(SKETCH_K))).alias("sketch"),
    )


def merged_sketches(rows: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Sketch rows taken together: the same columns per (coarser) group, without reading the values again."""
    sketch = F.when(F.sum("n") > 0, F.kll_merge_agg_double(F.col("sketch"), F.lit(SKETCH_K)))
    return rows.groupBy(*(group or [])).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("sum").alias("sum"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        sketch.alias("sketch"),
    )


def sketched_distribution(rows: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    """``n, avg, min, max`` and the named percentiles of every sketch row, other columns kept; zeros if empty.

    A percentile is a value whose rank is within ``RANK_ERROR`` of the wanted one, 99 times of 100.
    """
    zero = F.lit(0.0)
    kept = [c for c in rows.columns if c not in ("n", "sum", "min", "max", "sketch")]
    quantile = lambda p: F.kll_sketch_get_quantile_double(F.col("sketch"), F.lit(float(p)))
    return rows.select(
        *kept,
        "n",
        F.coalesce(F.col("sum") / F.when(F.col("n") > 0, F.col("n")), zero).alias("avg"),
        *[F.coalesce(c, zero).alias(c) for c in ("min", "max")],
        *[F.coalesce(quantile(p), zero).alias(name) for name, p in probabilities.items()],
    )
