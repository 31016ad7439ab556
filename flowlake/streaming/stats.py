"""Running figures on a stream: timeline, totals, snapshots, batch sizes, late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowlake import schema as S
from flowlake.functions import expressions as X
from flowlake.functions.quantiles import SKETCH_K
from flowlake.operators import soc
from flowlake.operators.flows import with_micros
from flowlake.streaming.ledger import Ledger
from flowlake.streaming.run import each_batch


def stream_timeline(
    scored: DataFrame, delay: str, tick_s: int = 1, threshold: float = S.ALERT_THRESHOLD
) -> DataFrame:
    """Normal and attack flows per closed time bucket."""
    alert = X.is_alert(F.col("confidence"), threshold)
    buckets = scored.withWatermark("ts", delay).groupBy(F.window("ts", f"{tick_s} seconds"))
    counts = buckets.agg(F.count_if(~alert).alias("normal"), F.count_if(alert).alias("attack"))
    return counts.select(F.unix_micros("window.start").alias("start_us"), "normal", "attack")


def running_stats(scored: DataFrame, threshold: float = S.ALERT_THRESHOLD) -> DataFrame:
    """One row of totals since the start (complete mode). Its state is a handful of counters and a
    percentile sketch of a few KB, however long the stream runs; ``latency_sketch`` can be merged with those of
    other streams (``quantiles.merged_sketches``)."""
    conf = F.col("confidence")
    alert = X.is_alert(conf, threshold)
    df = with_micros(scored)
    totals = df.agg(
        F.count(F.lit(1)).alias("total_flows"),
        F.count_if(alert).alias("total_alerts"),
        F.count(F.lit(1)).alias("total_packets"),
        F.coalesce((F.max("us") - F.min("us")) / 1e6, F.lit(0.0)).alias("elapsed_s"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("avg_latency_ms"),
        F.when(F.count("latency_ms") > 0, F.kll_sketch_agg_double("latency_ms", F.lit(SKETCH_K))).alias("latency_sketch"),
        *[F.count_if(alert & (X.severity(conf) == s)).alias(s) for s in soc.SEVERITIES],
    )
    p95 = F.coalesce(F.kll_sketch_get_quantile_double(F.col("latency_sketch"), F.lit(0.95)), F.lit(0.0))
    return soc.with_threat_status(soc.with_rates(totals.withColumn("p95_latency_ms", p95)))


SNAPSHOT = [
    "total_flows", "total_alerts", "throughput", "avg_latency_ms", "p95_latency_ms", "detection_rate",
    "system_status",
]


def stats_snapshots(
    scored: DataFrame,
    path: str,
    threshold: float = S.ALERT_THRESHOLD,
    checkpoint: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """The newest running totals, one row in the ledger at ``path``; ``interval`` is how often they are taken."""
    ledger = Ledger(scored.sparkSession, path)

    def store(batch: DataFrame, batch_id: int) -> None:
        ledger.replace(batch, batch_id)

    return each_batch(running_stats(scored, threshold), store, checkpoint, interval, mode="complete")


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of totals: one manifest and one small file are read."""
    return Ledger(spark, path).table().drop("batch_id")


def batch_sizes(
    stream: DataFrame, path: str, checkpoint: str | None = None, interval: str | None = None
) -> StreamingQuery:
    """Rows of every micro-batch. A batch is flushed when the source limit is reached or when the
    interval is over, whichever comes first: both belong to the source and the trigger."""
    ledger = Ledger(stream.sparkSession, path)

    def store(batch: DataFrame, batch_id: int) -> None:
        ledger.append(batch.agg(F.count(F.lit(1)).alias("n_rows")), batch_id)

    return each_batch(stream, store, checkpoint, interval)


def late_rows(
    stream: DataFrame,
    path: str,
    delay_s: int,
    slice_s: int | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Per batch: rows, and how many a stateful operator drops as behind the watermark.

    A batch drops by the watermark its predecessor ran with, that is, by what had been seen two
    batches before. With ``slice_s`` a row is late when the end of its slice has been passed, as in
    windowed operators; without, when its own time has.
    """
    ledger = Ledger(stream.sparkSession, path)

    def store(batch: DataFrame, batch_id: int) -> None:
        # The newest time seen up to the last two batches, kept beside the rows: earlier batches are not read.
        seen = {int(k): v for k, v in ledger.state().items()}
        bound = seen.get(batch_id - 2)
        df = with_micros(batch)
        if slice_s is None:
            end = F.col("us")
        else:
            width = slice_s * 1_000_000
            end = (F.floor(F.col("us") / width) + 1) * width
        # Watermarks are kept in milliseconds.
        late = F.lit(False) if bound is None else end <= (bound // 1000 - delay_s * 1000) * 1000
        counted = df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(late).alias("n_late"), F.max("us").alias("max_us")
        )
        row = counted.first()
        newest = [v for v in (row.max_us, seen.get(batch_id - 1)) if v is not None]
        state = {batch_id: max(newest) if newest else None, batch_id - 1: seen.get(batch_id - 1)}
        ledger.append(df.sparkSession.createDataFrame([row], counted.schema), batch_id, state)

    return each_batch(stream, store, checkpoint)


class DroppedRows(StreamingQueryListener):
    """Adds up what stateful operators dropped behind the watermark, for all streams of a session.

    Register it with ``spark.streams.addListener``. The totals, by query id, stand in the ledger at ``path`` and
    go on from there after a restart; a batch reported again counts once. Counted after partial aggregation.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._ledger = spark, Ledger(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress, state = event.progress, self._ledger.state()
        total, last, commits = state.get(str(progress.id), [0, -1, 0])
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if progress.batchId <= last or not dropped:
            return
        commits = 1 + max((c for _, _, c in state.values()), default=0)
        state[str(progress.id)] = [total + dropped, progress.batchId, commits]
        rows = [(name, n) for name, (n, _, _) in state.items()]
        self._ledger.replace(self._spark.createDataFrame(rows, "query_id string, n_dropped long"), commits, state)

    def total(self, query_id: str) -> int:
        return self._ledger.state().get(str(query_id), [0])[0]
