"""Batches by size or age: a batch is handed on when it is full or when its first record has waited long enough.

Where a batch ends depends on where it began, but the search need not go record by record. Each record knows
where the batch would end if one began with it; a record after a silence of the whole waiting time always begins
one. From these certain borders the others are found by pointer doubling: the links are joined with themselves, so
they reach twice as far in every round, and the rounds are as many as the logarithm of the batches in the longest
stretch without such a silence. All steps are sorts and equi-joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions.ranks import global_row_number
from flowlake.runtime import stored

AGE_S = 0.5


def _with_next(numbered: DataFrame, size: int, age_us: int) -> DataFrame:
    """``rn, us, next, certain``: where a batch that began here would be followed by the next one.

    Probes at the end of every record's waiting time are sorted among the records. Probes come in the order of
    their records, so a probe's number less its record's is the number of records before it.
    """
    records = numbered.select(F.col("us").alias("at"), F.lit(1).alias("kind"), "rn")
    probes = numbered.select((F.col("us") + age_us).alias("at"), F.lit(0).alias("kind"), "rn")
    placed = global_row_number(records.unionByName(probes), [F.col("at"), F.col("kind"), F.col("rn")], "place")
    before = placed.where("kind = 0").select("rn", (F.col("place") - F.col("rn")).alias("before"))
    # The record after a border by age; the same number tells that a record follows a whole silence.
    linked = numbered.join(before, "rn").withColumn("next", F.least(F.col("rn") + size, F.col("before") + 1))
    after_silence = linked.where(F.col("before") == F.col("rn")).select((F.col("rn") + 1).alias("rn"), F.lit(True).alias("certain"))
    linked = linked.join(after_silence, "rn", "left")
    return linked.select("rn", "us", "next", (F.coalesce("certain", F.lit(False)) | (F.col("rn") == 1)).alias("certain"))


def _borders(linked: DataFrame) -> DataFrame:
    """The numbers of the records that begin a batch."""
    jumps = stored(linked.select("rn", "next"), "jumps")
    found = stored(linked.where("certain").select("rn"), "borders")
    known, last = found.count(), linked.agg(F.max("rn")).first()[0]
    while known:
        # A jump beyond the last record leads nowhere.
        ahead = found.join(jumps, "rn").select(F.col("next").alias("rn")).where(F.col("rn") <= last)
        found = stored(found.unionByName(ahead).distinct(), "borders")
        now = found.count()
        if now == known:
            return found
        known = now
        further = jumps.select(F.col("rn").alias("next"), F.col("next").alias("after"))
        jumps = stored(jumps.join(further, "next").select("rn", F.col("after").alias("next")), "jumps")
    return found


def size_or_age_batches(
    df: DataFrame, order: list[str], size: int = S.BATCH_SIZE, age_s: float = AGE_S, us: str = "us"
) -> DataFrame:
    """The rows with ``batch`` (from 1), ``cause`` and ``wait_us``, in the total order ``order`` (time ``us`` first).

    ``cause``: ``size`` when the batch holds ``size`` rows, else ``age`` when the waiting time of its first row was
    over, else ``end``. A full batch is handed on with its last row, one that is too old when the time is over, the
    last one with its last row; ``wait_us`` is how long the row has waited by then.
    """
    age_us = int(age_s * 1_000_000)
    if size < 1 or age_us < 1:
        raise ValueError("a batch has a row and an age")
    numbered = stored(global_row_number(df.withColumn("us", F.col(us)), [F.col(c) for c in order]), "numbered")
    linked = stored(_with_next(numbered.select("rn", "us"), size, age_us), "linked")
    begins = global_row_number(_borders(linked), [F.col("rn")], "batch").join(linked, "rn")
    last = numbered.agg(F.max("rn")).scalar()
    begins = begins.select(
        "batch",
        F.col("rn").alias("begin"),
        F.least(F.col("next"), last + 1).alias("end"),
        (F.col("us") + age_us).alias("old_us"),
        (F.col("next") > last).alias("is_last"),
    )
    # A batch reaches over two blocks of numbers at most, and a block holds at most ``size`` batches.
    block = lambda c: F.floor(c / size).cast("bigint")
    blocks = F.array_distinct(F.array(block(F.col("begin")), block(F.col("end") - 1)))
    rows = numbered.withColumn("block", block(F.col("rn"))).join(begins.withColumn("block", F.explode(blocks)), "block")
    rows = rows.where((F.col("begin") <= F.col("rn")) & (F.col("rn") < F.col("end")))
    full = F.col("end") - F.col("begin") == size
    # At most ``size`` rows of a batch.
    newest = F.max("us").over(Window.partitionBy("batch"))
    cause = F.when(full, "size").when(F.col("is_last"), "end").otherwise("age")
    handed_on = F.when(full | F.col("is_last"), newest).otherwise(F.col("old_us"))
    out = rows.withColumns({"cause": cause, "wait_us": handed_on - F.col("us")})
    return out.select(*df.columns, "batch", "cause", "wait_us")
