"""Packets to flows: closing packets, timeouts, directions, guards, hot keys, plan shape."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlake import runtime
from flowlake import schema as S
from flowlake.functions import hotkeys
from flowlake.operators import flows as O
from flowlake.plans import tables as T

S1 = 1_000_000
COLUMNS = "packet_id long, us long, src_ip string, dst_ip string, src_port int, dst_port int, protocol int, size long, syn boolean, ack boolean, fin boolean, rst boolean, psh boolean"


def packet(i, us, fin=False, rst=False, reply=False, size=100, client="10.0.0.1", **more):
    a, b = (client, 5000), ("192.168.1.1", 80)
    if reply:
        a, b = b, a
    flags = {"syn": False, "ack": False, "psh": False, **more}
    return (i, us, a[0], b[0], a[1], b[1], 6, size, flags["syn"], flags["ack"], fin, rst, flags["psh"])


def flows_of(spark, rows, **options):
    df = spark.createDataFrame(rows, COLUMNS)
    return sorted(O.flow_features(df, **options).collect(), key=lambda r: (r.src_ip, r.start_us))


def bag(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


def test_closing_packet_belongs_to_its_flow(spark):
    rows = [packet(1, 0), packet(2, S1, fin=True), packet(3, 2 * S1), packet(4, 3 * S1, rst=True)]
    one, two = flows_of(spark, rows)
    assert (one.fwd_packets, one.fin_count, one.close_reason) == (2, 1, "fin_rst")
    assert (two.fwd_packets, two.rst_count, two.segment) == (2, 1, 1)
    assert two.iat_mean == S1


@pytest.mark.parametrize("extra,expected", [(0, 1), (1, 2)])
def test_timeout_is_strict(spark, extra, expected):
    rows = [packet(1, 0), packet(2, 60 * S1 + extra)]
    got = flows_of(spark, rows)
    assert len(got) == expected
    assert got[-1].close_reason == "open"
    if expected == 2:
        assert got[0].close_reason == "timeout"


def test_one_packet_flow_guards(spark):
    (flow,) = flows_of(spark, [packet(1, 5, size=40)])
    assert flow.flow_bytes_s == 40e6 and flow.flow_packets_s == 1e6
    assert flow.iat_mean == flow.iat_std == flow.idle_mean == flow.flow_duration == 0.0


def test_population_std_and_active_mean(spark):
    (flow,) = flows_of(spark, [packet(1, 0), packet(2, S1), packet(3, 4 * S1)])
    assert flow.iat_std == pytest.approx(S1)
    assert flow.iat_mean == flow.idle_mean == 2 * S1
    assert flow.active_mean == pytest.approx(4 * S1 / 3)


def test_directions(spark):
    rows = [packet(1, 0, size=100), packet(2, S1, reply=True, size=300)]
    (both,) = flows_of(spark, rows)
    assert (both.fwd_packets, both.bwd_packets, both.down_up_ratio) == (1, 1, 3.0)
    assert (both.src_ip, both.dst_port) == ("10.0.0.1", 80)
    single = flows_of(spark, rows, direction="directional")
    assert [(f.fwd_packets, f.bwd_packets, f.down_up_ratio) for f in single] == [(1, 0, 0.0)] * 2


def test_first_packet_decides_forward(spark):
    (flow,) = flows_of(spark, [packet(1, 0, reply=True), packet(2, S1), packet(3, 2 * S1)])
    assert (flow.src_ip, flow.fwd_packets, flow.bwd_packets) == ("192.168.1.1", 1, 2)


def test_missing_fields_get_defaults(spark):
    rows = [(1, 0, None, None, None, None, None, None, None, None, None, None, None)]
    (flow,) = flows_of(spark, rows)
    assert (flow.src_ip, flow.dst_port, flow.protocol, flow.flow_bytes_s) == ("0.0.0.0", 0, 0, 0.0)


def test_feature_vector_defaults(spark):
    df = spark.range(1).select(F.lit(None).cast("double").alias("fwd_packets"))
    (row,) = O.assemble_features(df).collect()
    assert row.features == [0.0, 1.0, 0.0, 0.0, 0.0, 1.0] + [0.0] * 12


def random_packets(seed, n=600):
    rng = random.Random(seed)
    clock, rows = 0, []
    for i in range(n):
        clock += rng.choice([0, 1, 1000, S1 // 2, S1, 3 * S1, 61 * S1])
        rows.append(
            packet(
                i, clock, fin=rng.random() < 0.1, rst=rng.random() < 0.05, reply=rng.random() < 0.4,
                size=rng.randint(40, 1500), client=f"10.0.0.{rng.choice([1, 1, 1, 2, 3])}",
            )
        )
    rng.shuffle(rows)
    return rows


def brute_force(rows, timeout_us=60 * S1):
    """Plain fold, packet by packet in time order (bidirectional)."""
    state, done = {}, []
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        ends = frozenset([(r[2], r[4]), (r[3], r[5])])
        flow = state.get(ends)
        if flow and r[1] - flow["last"] > timeout_us:
            done.append(state.pop(ends) | {"why": "timeout"})
            flow = None
        if not flow:
            flow = state[ends] = {"id": r[0], "src": r[2], "first": r[1], "n": [0, 0], "b": [0, 0], "why": "open"}
        side = 0 if r[2] == flow["src"] else 1
        flow["n"][side] += 1
        flow["b"][side] += r[7]
        flow["last"] = r[1]
        if r[10] or r[11]:
            done.append(state.pop(ends) | {"why": "fin_rst"})
    done.extend(state.values())
    return {(f["id"], f["src"], f["first"], f["last"], *f["n"], f["why"]) for f in done}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_traffic_matches_fold(spark, seed):
    rows = random_packets(seed)
    got = {
        (f.flow_id, f.src_ip, f.start_us, f.last_us, f.fwd_packets, f.bwd_packets, f.close_reason)
        for f in flows_of(spark, rows)
    }
    assert got == brute_force(rows)


@pytest.mark.parametrize("direction,slice_s", [("directional", 7), ("bidirectional", 0.5), ("bidirectional", 600)])
def test_hot_keys_give_the_same_rows(spark, direction, slice_s):
    df = spark.createDataFrame(random_packets(3), COLUMNS).cache()
    for op in (O.inter_arrival, O.segment_by_close, O.segment_by_gap, O.packet_direction, O.flows_by_gap):
        plain = bag(op(df, direction=direction, hot_rows=None))
        # every key hot / only the big client hot
        assert bag(op(df, direction=direction, hot_rows=0, slice_s=slice_s)) == plain, op
        if slice_s == 7:
            assert bag(op(df, direction=direction, hot_rows=150, slice_s=slice_s)) == plain, op
    rounded = lambda d: bag(d.withColumn("iat_std", F.round("iat_std", 2)))
    plain = rounded(O.flow_features(df, direction=direction, hot_rows=None))
    hot = rounded(O.flow_features(df, direction=direction, hot_rows=0, slice_s=slice_s))
    assert hot == plain


def test_packets_and_bytes_are_kept(spark, sf_dir):
    df = T.packets(spark, sf_dir)
    flows = O.flow_features(df, timeout_s=T.PACKET_TIMEOUT_S)
    total = flows.agg(F.sum(F.col("fwd_packets") + F.col("bwd_packets"))).first()[0]
    assert total == df.count()
    again = O.flow_features(df.repartition(13), timeout_s=T.PACKET_TIMEOUT_S)
    cols = ["flow_id", "segment", "start_us", "last_us", "fwd_packets", "close_reason"]
    assert bag(flows.select(cols)) == bag(again.select(cols))


def test_hot_rows_are_spread_over_slices(spark):
    """One conversation with all the rows, all in one second or one microsecond, is not sent to one task."""
    for step in (S1 // 10, 100, 0):
        rows = [packet(i, i * step) for i in range(2000)]
        df = spark.createDataFrame(rows, COLUMNS).repartition(5)
        sizes = [r["count"] for r in O.sequence_packets(df, hot_rows=100).groupBy("cell", "cut").count().collect()]
        assert len(sizes) >= 20 and max(sizes) <= 150
        (flow,) = O.flow_features(df, hot_rows=100).collect()
        assert flow.fwd_packets == 2000 and flow.flow_duration == 1999.0 * step
        assert flow.iat_mean == step and flow.iat_std == pytest.approx(0, abs=1e-3)


def test_slices_that_only_the_first_flow_reaches(spark):
    """A flow of the other side that closes in one slice leaves its sender to none of the next."""
    rows = [packet(i, i, reply=i % 7 == 3, fin=i % 11 == 5, rst=i % 23 == 9) for i in range(500)]
    df = spark.createDataFrame(rows, COLUMNS)
    plain = bag(O.packet_direction(df, hot_rows=None))
    for limit in (0, 3, 40):
        assert bag(O.packet_direction(df, hot_rows=limit)) == plain


def test_all_hot_keys_are_found(spark):
    """5,000 keys at the limit among as many below half of it; also keys with null ids and repeated packets."""
    keys = [(k, r) for k in range(10_000) for r in range(40 if k % 2 else 19)]
    df = spark.createDataFrame(keys, "k int, r int").repartition(4)
    cuts = hotkeys.heavy_keys(df, ["k"], ["r"], 40)
    found = {r.k: len(r.cuts) for r in cuts.table.collect()}
    assert set(found) == {k for k in range(10_000) if k % 2}
    parts = cuts.join(df, "left").groupBy("k", cuts.part().alias("part")).count()
    assert parts.where("k % 2 = 0").agg({"part": "max"}).first()[0] == 0
    assert hotkeys.heavy_keys(df.limit(0), ["k"], ["r"], 40) is None
    same = spark.createDataFrame([(1, None)] * 90 + [(1, 5)] * 90, "k int, r int")
    cuts = hotkeys.heavy_keys(same, ["k"], ["r"], 10)
    assert sorted(r["count"] for r in cuts.join(same, "left").groupBy(cuts.part()).count().collect()) == [90, 90]


def test_large_lookups_of_slices_are_not_broadcast(spark, monkeypatch):
    """Their files may be small enough for the planner's own limit when their rows are not."""
    df = spark.createDataFrame(random_packets(3), COLUMNS)
    plain = bag(O.packet_direction(df, hot_rows=None))
    monkeypatch.setattr(runtime, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(hotkeys, "SENT_BYTES", 0)
    hot = O.packet_direction(df, hot_rows=3)
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 3, plan
    assert bag(hot) == plain


def test_hot_keys_take_one_wide_shuffle(spark, sf_dir):
    """Packets are shuffled once, hot or not; what follows are partial sums of flows."""
    df = O.flow_features(T.packets(spark, sf_dir), timeout_s=T.PACKET_TIMEOUT_S, hot_rows=20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert plan.count("FileScan") == plan.count("FileScan parquet") and plan.count("events") <= 2, plan


def test_one_shuffle_and_one_sort(spark, sf_dir):
    df = O.flow_features(T.packets(spark, sf_dir), timeout_s=T.PACKET_TIMEOUT_S, hot_rows=None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert plan.count("Sort [") == 1, plan


def test_features_follow_the_model_order():
    assert list(S.SNAKE_CASE.values()) == S.FLOW_FEATURES and len(S.FLOW_FEATURES) == 18
