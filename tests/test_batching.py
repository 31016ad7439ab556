"""Batches by size or age against a plain loop."""

import random

import pytest

from flowlake.operators.batching import size_or_age_batches


def plain(rows, size, age_us):
    out, held, number = set(), [], 1

    def hand_on(cause, at):
        nonlocal held, number
        out.update((i, number, cause, at - us) for i, us in held)
        held, number = [], number + 1

    for i, us in sorted(rows, key=lambda r: (r[1], r[0])):
        if held and us - held[0][1] >= age_us:
            hand_on("age", held[0][1] + age_us)
        held.append((i, us))
        if len(held) == size:
            hand_on("size", us)
    if held:
        hand_on("end", held[-1][1])
    return out


@pytest.mark.parametrize("seed, size, steps", [(1, 5, [0, 1, 200, 400]), (2, 3, [0, 100, 999, 1_000, 1_001, 5_000]), (3, 64, [0, 1, 30]), (4, 1, [0, 700]), (5, 7, [0])])
def test_batches_are_those_of_the_loop(spark, seed, size, steps):
    rng = random.Random(seed)
    clock, rows = 0, []
    for i in range(300):
        clock += rng.choice(steps)
        rows.append((i, clock))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, us long").repartition(3)
    got = size_or_age_batches(df, ["us", "id"], size, 0.001)
    assert got.columns == ["id", "us", "batch", "cause", "wait_us"]
    assert {(r.id, r.batch, r.cause, r.wait_us) for r in got.collect()} == plain(rows, size, 1_000)
    assert got.count() == len(rows)


def test_nothing_to_batch(spark):
    none = spark.createDataFrame([], "id long, us long")
    assert size_or_age_batches(none, ["us", "id"], 5, 1).count() == 0
    one = spark.createDataFrame([(1, 7)], "id long, us long")
    assert [tuple(r) for r in size_or_age_batches(one, ["us", "id"], 5, 1).collect()] == [(1, 7, 1, "end", 0)]
    with pytest.raises(ValueError):
        size_or_age_batches(one, ["us", "id"], 0, 1)
