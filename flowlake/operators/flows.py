"""Packets to flows.

A flow is a run of packets of one 5-tuple. It ends with a FIN or RST packet (which belongs to it)
or when the next packet comes more than ``timeout`` later.

Packets take one shuffle by key and one sort; everything after that (previous packet, segment
number, the 18 features) reuses that distribution. A key with more rows than one task should hold
is scanned at two levels: it is cut into slices by time, no wider than the timeout, and by rows, so
that a flood within one microsecond is cut too. Slices are summarised with a map-side aggregate, the
summaries are chained per key, and each slice then continues from what the slices before it leave
behind. Slices of hot keys and whole ordinary keys travel in the same shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.functions.hotkeys import HOT_ROWS, heavy_keys
from flowlake.runtime import measured, stored

# Endpoint columns of the grouping key: a is the source (directional) or the smaller endpoint.
KEY = ["ip_a", "port_a", "ip_b", "port_b", "protocol"]
# Where a row stands in a hot key: time slice, and cuts before it. Both are 0 for ordinary keys.
_SLICE = ["cell", "cut"]


def with_micros(packets: DataFrame) -> DataFrame:
    """Event time as microseconds since the epoch in ``us``."""
    if "us" in packets.columns:
        return packets
    return packets.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


def keyed_packets(packets: DataFrame, direction: str = "bidirectional") -> DataFrame:
    """Fill missing packet fields and add the flow key and ``from_a`` (sent by endpoint a?).

    ``directional`` keys on (source, destination), so every packet goes forward;
    ``bidirectional`` puts both directions of a conversation into one flow.
    """
    df = with_micros(packets)

    def filled(name: str, default):
        return F.coalesce(F.col(name), F.lit(default)).alias(name)

    df = df.select(
        "packet_id",
        "us",
        *[filled(c, "0.0.0.0") for c in ("src_ip", "dst_ip")],
        *[filled(c, 0) for c in ("src_port", "dst_port", "protocol")],
        F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("size"),
        *[filled(f, False) for f in S.FLAGS],
    )
    if direction == "directional":
        from_a = F.lit(True)
    elif direction == "bidirectional":
        same_ip = F.col("src_ip") == F.col("dst_ip")
        from_a = (F.col("src_ip") < F.col("dst_ip")) | (same_ip & (F.col("src_port") <= F.col("dst_port")))
    else:
        raise ValueError(f"unknown direction {direction!r}")

    def sided(name: str, of_a: str, of_b: str) -> Column:
        return F.when(from_a, F.col(of_a)).otherwise(F.col(of_b)).alias(name)

    return df.select(
        "packet_id",
        "us",
        sided("ip_a", "src_ip", "dst_ip"),
        sided("port_a", "src_port", "dst_port"),
        sided("ip_b", "dst_ip", "src_ip"),
        sided("port_b", "dst_port", "src_port"),
        "protocol",
        "size",
        *S.FLAGS,
        (F.col("fin") | F.col("rst")).alias("closes"),
        from_a.alias("from_a"),
    )


def _boundaries(timeout_us: int) -> tuple[Column, Column]:
    """(silence before this packet?, first packet of a segment?) from the packet before."""
    gap = F.coalesce(F.col("us") - F.col("prev_us") > timeout_us, F.lit(False))
    return gap, F.col("prev_us").isNull() | F.col("prev_closes") | gap


def _sequenced(df: DataFrame, part: list[str], timeout_us: int, edges: DataFrame | None = None) -> DataFrame:
    """Packets in order within ``part``; with ``edges``, continued from the slices before."""
    order = Window.partitionBy(*part).orderBy("us", "packet_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    if edges is None:
        carried = {"prev_us": F.lit(None), "prev_closes": F.lit(False), "more": F.lit(False)}
        carried |= {"closes": zero, "gaps": zero, "segments": zero}
    else:
        df = df.join(edges, part, "left")
        carried = {"prev_us": F.col("e_prev_us"), "prev_closes": F.coalesce("e_prev_closes", F.lit(False))}
        carried |= {"more": F.coalesce("e_more", F.lit(False))}
        carried |= {c: F.coalesce(f"e_{c}", zero) for c in ("closes", "gaps", "segments")}
    first = F.lag("us").over(order).isNull()
    df = df.withColumns(
        {
            "prev_us": F.coalesce(F.lag("us").over(order), carried["prev_us"]),
            "prev_closes": F.when(first, carried["prev_closes"]).otherwise(F.lag("closes").over(order)),
            "key_ends": F.lead("us").over(order).isNull() & ~carried["more"],
            "closes_before": carried["closes"] + F.coalesce(F.sum(F.col("closes").cast("bigint")).over(before), zero),
        }
    )
    gap, starts = _boundaries(timeout_us)
    df = df.withColumns({"gap": gap, "starts": starts}).withColumns(
        {
            "gaps_before": carried["gaps"] + F.sum(F.col("gap").cast("bigint")).over(upto),
            "segment": carried["segments"] + F.sum(F.col("starts").cast("bigint")).over(upto) - 1,
        }
    )
    return df if edges is None else df.drop(*[c for c in edges.columns if c.startswith("e_")])


def _chained(slices: DataFrame, timeout_us: int) -> DataFrame:
    """What the slices of a key before each slice leave behind.

    The window sees one row per non-empty slice of a key, never the packets themselves.
    """
    order = Window.partitionBy(*KEY).orderBy(*_SLICE)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    edges = slices.withColumns(
        {
            "e_prev_us": F.lag("last.us").over(order),
            "e_prev_closes": F.coalesce(F.lag("last.closes").over(order), F.lit(False)),
            "e_more": F.lead("first_us").over(order).isNotNull(),
            "e_closes": F.coalesce(F.sum("n_closes").over(before), zero),
        }
    )
    gap = F.coalesce(F.col("first_us") - F.col("e_prev_us") > timeout_us, F.lit(False))
    opens = (F.col("e_prev_us").isNull() | F.col("e_prev_closes") | gap).cast("bigint")
    # Inside a slice only a closing packet starts a new segment: the slice is no wider than the timeout.
    inner = F.col("n_closes") - F.col("last.closes").cast("bigint")
    edges = edges.withColumn("e_gap", gap.cast("bigint")).withColumn("e_starts", opens + inner)
    return edges.select(
        *KEY,
        *_SLICE,
        "e_prev_us",
        "e_prev_closes",
        "e_more",
        "e_closes",
        F.coalesce(F.sum("e_gap").over(before), zero).alias("e_gaps"),
        F.coalesce(F.sum("e_starts").over(before), zero).alias("e_segments"),
    )


def sequence_packets(
    packets: DataFrame,
    timeout_s: float = S.FLOW_TIMEOUT_S,
    direction: str = "bidirectional",
    hot_rows: int | None = HOT_ROWS,
    slice_s: float | None = None,
) -> DataFrame:
    """Packets with their place in the flow.

    Columns added: ``prev_us`` (packet before, same key), ``starts`` (first of its segment),
    ``segment`` (from 0 within the key), ``closes_before``, ``gaps_before``, ``key_ends``; and, if there are keys
    with ``hot_rows`` rows, ``cell`` and ``cut``, the slice of such a key. ``hot_rows=None`` skips the search.
    Slices are as wide as the timeout, or ``slice_s`` if that is less. Packets of a key with equal time and
    ``packet_id`` (null included) cannot be told apart and stay in one slice.

    The table is read once without hot keys beside the counting pass, and three times in all with some.
    """
    timeout_us = int(timeout_s * 1_000_000)
    width = timeout_us if slice_s is None else min(int(slice_s * 1_000_000), timeout_us)
    df = keyed_packets(packets, direction)
    cuts = None if hot_rows is None else heavy_keys(df, KEY, ["us", "packet_id"], hot_rows)
    if cuts is None:
        return _sequenced(df, KEY, timeout_us)
    cell = F.when(F.col("cuts").isNull(), 0).otherwise(F.floor(F.col("us") / F.lit(width))).cast("bigint")

    def placed(how: str) -> DataFrame:
        return cuts.join(df, how).withColumns({"cell": cell, "cut": cuts.part()}).drop("cuts")

    slices = placed("inner").groupBy(*KEY, *_SLICE).agg(
        F.min("us").alias("first_us"),
        F.max(F.struct("us", "packet_id", "closes")).alias("last"),
        F.sum(F.col("closes").cast("bigint")).alias("n_closes"),
    )
    edges = measured(stored(_chained(slices, timeout_us), "edges"))
    return _sequenced(placed("left"), [*KEY, *_SLICE], timeout_us, edges)


def _endpoints(from_a: Column) -> list[Column]:
    return [
        F.when(from_a, F.col("ip_a")).otherwise(F.col("ip_b")).alias("src_ip"),
        F.when(from_a, F.col("ip_b")).otherwise(F.col("ip_a")).alias("dst_ip"),
        F.when(from_a, F.col("port_a")).otherwise(F.col("port_b")).alias("src_port"),
        F.when(from_a, F.col("port_b")).otherwise(F.col("port_a")).alias("dst_port"),
        F.col("protocol"),
    ]


def inter_arrival(packets: DataFrame, **options) -> DataFrame:
    """Microseconds since the packet before in the same flow; null for the first one."""
    iat = F.when(~F.col("starts"), F.col("us") - F.col("prev_us")).alias("iat_us")
    df = sequence_packets(packets, **options)
    return df.select("packet_id", *_endpoints(F.col("from_a")), "us", "segment", iat)


def segment_by_close(packets: DataFrame, **options) -> DataFrame:
    """Flow number counted by FIN and RST packets alone."""
    df = sequence_packets(packets, **options)
    return df.select("packet_id", *_endpoints(F.col("from_a")), "us", F.col("closes_before").alias("segment"))


def segment_by_gap(packets: DataFrame, **options) -> DataFrame:
    """Flow number counted by silences longer than the timeout alone."""
    df = sequence_packets(packets, **options)
    return df.select("packet_id", *_endpoints(F.col("from_a")), "us", F.col("gaps_before").alias("segment"))


def flows_by_gap(packets: DataFrame, **options) -> DataFrame:
    """Timeout-only flows: FIN and RST do not end them, only a silence longer than the timeout."""
    df = sequence_packets(packets, **options)
    return df.groupBy(*KEY, F.col("gaps_before").alias("segment")).agg(
        F.min("us").alias("start_us"),
        F.max("us").alias("last_us"),
        F.count(F.lit(1)).alias("packets"),
        F.sum("size").alias("bytes"),
    )


def packet_direction(packets: DataFrame, **options) -> DataFrame:
    """``forward``: sent by the endpoint that sent the first packet of the flow."""
    df = sequence_packets(packets, **options)
    sliced = "cell" in df.columns
    part = [*KEY, *_SLICE] if sliced else KEY
    order = Window.partitionBy(*part).orderBy("us", "packet_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_from_a = F.last(F.when(F.col("starts"), F.col("from_a")), ignorenulls=True).over(upto)
    if sliced:
        # The sender of the flow that is open when a slice begins is chained from slice to slice.
        newest = F.max(F.when(F.col("starts"), F.struct("us", "packet_id", "from_a")))["from_a"]
        before = Window.partitionBy(*KEY).orderBy(*_SLICE).rowsBetween(Window.unboundedPreceding, -1)
        slices = df.where((F.col("cell") != 0) | (F.col("cut") != 0) | F.col("starts")).groupBy(*part).agg(newest.alias("newest"))
        chained = slices.select(*part, F.last("newest", ignorenulls=True).over(before).alias("open_sender"))
        chained = chained.where(F.col("open_sender").isNotNull())
        df = df.join(measured(stored(chained, "senders")), part, "left")
        first_from_a = F.coalesce(first_from_a, F.col("open_sender"))
    df = df.withColumn("first_from_a", first_from_a)
    forward = (F.col("from_a") == F.col("first_from_a")).alias("forward")
    return df.select("packet_id", *_endpoints(F.col("from_a")), "us", "segment", forward)


def _aggregate_flows(df: DataFrame) -> DataFrame:
    a = F.col("from_a")
    count_a, count_b = F.count_if(a), F.count_if(~a)
    iat = F.when(~F.col("starts"), F.col("us") - F.col("prev_us")).cast("double")
    grouped = df.groupBy(*KEY, "segment").agg(
        F.min("us").alias("start_us"),
        F.max("us").alias("last_us"),
        F.max(F.when(F.col("starts"), F.col("packet_id"))).alias("flow_id"),
        F.max(F.when(F.col("starts"), a)).alias("first_from_a"),
        count_a.alias("count_a"),
        count_b.alias("count_b"),
        F.coalesce(F.sum(F.when(a, F.col("size"))), F.lit(0)).alias("bytes_a"),
        F.coalesce(F.sum(F.when(~a, F.col("size"))), F.lit(0)).alias("bytes_b"),
        *[F.count_if(F.col(flag)).alias(f"{flag}_count") for flag in S.FLAGS],
        F.coalesce(F.avg(iat), F.lit(0.0)).alias("iat_mean"),
        F.coalesce(F.stddev_pop(iat), F.lit(0.0)).alias("iat_std"),
        F.max("closes").alias("closed"),
        F.max("key_ends").alias("is_last"),
    )
    reason = F.when(F.col("closed"), "fin_rst").when(F.col("is_last"), "open").otherwise("timeout")
    return derive_features(grouped.withColumn("close_reason", reason))


def derive_features(grouped: DataFrame) -> DataFrame:
    """The 18 features from the sums of a flow, counted per endpoint (``_a``, ``_b``)."""
    fa = F.col("first_from_a")

    def pick(of_a: str, of_b: str) -> tuple[Column, Column]:
        ca, cb = F.col(of_a), F.col(of_b)
        return F.when(fa, ca).otherwise(cb), F.when(fa, cb).otherwise(ca)

    fwd_n, bwd_n = pick("count_a", "count_b")
    fwd_b, bwd_b = pick("bytes_a", "bytes_b")
    duration = (F.col("last_us") - F.col("start_us")).cast("double")
    seconds = F.greatest(F.col("flow_duration") / 1e6, F.lit(1e-6))
    packets = F.col("fwd_packets") + F.col("bwd_packets")
    total_bytes = F.col("fwd_bytes") + F.col("bwd_bytes")
    number = ["segment"] if "segment" in grouped.columns else []
    return grouped.select(
        "flow_id",
        *_endpoints(fa),
        *number,
        "start_us",
        "last_us",
        fwd_n.alias("fwd_packets"),
        bwd_n.alias("bwd_packets"),
        fwd_b.alias("fwd_bytes"),
        bwd_b.alias("bwd_bytes"),
        duration.alias("flow_duration"),
        *[f"{flag}_count" for flag in S.FLAGS],
        "iat_mean",
        F.col("iat_mean").alias("idle_mean"),
        "iat_std",
        "close_reason",
    ).withColumns(
        {
            "flow_bytes_s": total_bytes / seconds,
            "flow_packets_s": packets / seconds,
            "down_up_ratio": F.col("bwd_bytes") / F.greatest(F.col("fwd_bytes"), F.lit(1)),
            "fwd_len_mean": X.ratio(F.col("fwd_bytes"), F.col("fwd_packets")),
            "bwd_len_mean": X.ratio(F.col("bwd_bytes"), F.col("bwd_packets")),
            "active_mean": F.col("flow_duration") / F.greatest(packets, F.lit(1)),
        }
    )


FEATURES = [f for f in S.FLOW_FEATURES if f != "dst_port"]


def flow_features(packets: DataFrame, **options) -> DataFrame:
    """One row per flow: its key, its times, the 18 features and why it ended.

    ``close_reason``: ``fin_rst``, ``timeout`` or ``open`` (still running at the end of the input).
    """
    columns = ["flow_id", *S.FIVE_TUPLE, "segment", "start_us", "last_us", "close_reason"]
    return _aggregate_flows(sequence_packets(packets, **options)).select(*columns, *FEATURES)


def assemble_features(flows: DataFrame, output: str = "features") -> DataFrame:
    """The 18 features as one array of doubles in model order, with defaults where missing."""
    present = set(flows.columns)
    values = []
    for name in S.FLOW_FEATURES:
        default = F.lit(S.FEATURE_DEFAULTS.get(name, 0.0))
        col = F.col(name).cast("double") if name in present else F.lit(None).cast("double")
        values.append(F.coalesce(col, default))
    return flows.withColumn(output, F.array(*values))
