"""The traffic tables the registered queries run on, as projections of the given parquet tables.

Each projection has a SQL twin (a list of common table expressions) for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Users of the event table are quiet for hours, so flows on it use a timeout of one day.
PACKET_TIMEOUT_S = 86_400

_SERVER_PORTS = [22, 23, 80, 443, 445, 3389]
_PROTOCOLS = [6, 17, 1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(col):
    return col.cast("string")


def packets_of(events: DataFrame) -> DataFrame:
    u = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    client_ip = F.concat(F.lit("10.0."), _text(u % 4 + 1), F.lit("."), _text(u % 254 + 1))
    server_ip = F.concat(F.lit("192.168.1."), _text((u % 6 + 1) * 10))
    client_port = (1024 + u % 60000).cast("int")
    server_port = _choice(u % 6, _SERVER_PORTS)
    reply = k % 3 == 0

    def sided(a, b):
        return F.when(reply, b).otherwise(a)

    return events.select(
        F.col("event_id").alias("packet_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        sided(client_ip, server_ip).alias("src_ip"),
        sided(server_ip, client_ip).alias("dst_ip"),
        sided(client_port, server_port).alias("src_port"),
        sided(server_port, client_port).alias("dst_port"),
        _choice(u % 3, _PROTOCOLS).alias("protocol"),
        (F.round(F.col("value") * 100).cast("bigint") % 1460 + 40).alias("size"),
        (F.col("event_type") == "signup").alias("syn"),
        (F.col("event_type") == "view").alias("ack"),
        ((F.col("event_type") == "purchase") & (k % 4 == 0)).alias("fin"),
        ((F.col("event_type") == "error") & (k % 5 == 0)).alias("rst"),
        (F.col("event_type") == "click").alias("psh"),
    )


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_of(table(spark, sf_dir, "events"))


PACKETS_SQL = """
raw_packets AS (
  SELECT event_id AS packet_id, epoch_us(ts) AS us, ts, event_type, user_id AS u, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
sided_packets AS (
  SELECT *, '10.0.' || (u % 4 + 1) || '.' || (u % 254 + 1) AS client_ip,
         '192.168.1.' || ((u % 6 + 1) * 10) AS server_ip,
         CAST(1024 + u % 60000 AS INT) AS client_port,
         CASE u % 6 WHEN 0 THEN 22 WHEN 1 THEN 23 WHEN 2 THEN 80 WHEN 3 THEN 443
                    WHEN 4 THEN 445 ELSE 3389 END AS server_port,
         k % 3 = 0 AS reply
  FROM raw_packets),
packets AS (
  SELECT packet_id, us, ts,
         CASE WHEN reply THEN server_ip ELSE client_ip END AS src_ip,
         CASE WHEN reply THEN client_ip ELSE server_ip END AS dst_ip,
         CASE WHEN reply THEN server_port ELSE client_port END AS src_port,
         CASE WHEN reply THEN client_port ELSE server_port END AS dst_port,
         CASE u % 3 WHEN 0 THEN 6 WHEN 1 THEN 17 ELSE 1 END AS protocol,
         CAST(round(value * 100) AS BIGINT) % 1460 + 40 AS size,
         event_type = 'signup' AS syn, event_type = 'view' AS ack,
         event_type = 'purchase' AND k % 4 = 0 AS fin,
         event_type = 'error' AND k % 5 = 0 AS rst,
         event_type = 'click' AS psh
  FROM sided_packets)"""


def scored_of(events: DataFrame) -> DataFrame:
    """One row per scored flow: confidence, true label, attack type, latency."""
    u = F.col("user_id")
    attack = F.col("event_type").isin("error", "signup")
    return events.select(
        F.col("event_id").alias("flow_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("10.0."), _text(u % 4 + 1), F.lit("."), _text(u % 254 + 1)).alias("src_ip"),
        F.concat(F.lit("192.168.1."), _text((u % 6 + 1) * 10)).alias("dst_ip"),
        _choice(u % 6, _SERVER_PORTS).alias("dst_port"),
        _choice(u % 3, _PROTOCOLS).alias("protocol"),
        F.least(F.col("value") / 150.0, F.lit(1.0)).alias("confidence"),
        attack.cast("int").alias("y_true"),
        F.when(F.col("event_type") == "error", "DDoS")
        .when(F.col("event_type") == "signup", "PortScan")
        .otherwise("BENIGN")
        .alias("attack_type"),
        F.col("value").alias("latency_ms"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_of(table(spark, sf_dir, "events"))


SCORED_SQL = """
scored AS (
  SELECT event_id AS flow_id, ts, epoch_us(ts) AS us,
         '10.0.' || (user_id % 4 + 1) || '.' || (user_id % 254 + 1) AS src_ip,
         '192.168.1.' || ((user_id % 6 + 1) * 10) AS dst_ip,
         CASE user_id % 6 WHEN 0 THEN 22 WHEN 1 THEN 23 WHEN 2 THEN 80 WHEN 3 THEN 443
                          WHEN 4 THEN 445 ELSE 3389 END AS dst_port,
         CASE user_id % 3 WHEN 0 THEN 6 WHEN 1 THEN 17 ELSE 1 END AS protocol,
         least(value / 150.0, 1.0) AS confidence,
         CASE WHEN event_type IN ('error', 'signup') THEN 1 ELSE 0 END AS y_true,
         CASE event_type WHEN 'error' THEN 'DDoS' WHEN 'signup' THEN 'PortScan'
                         ELSE 'BENIGN' END AS attack_type,
         value AS latency_ms
  FROM events)"""


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per prediction of a benchmark run."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.when(flag == "N", "single").when(flag == "A", "thread").otherwise("process").alias("mode"),
        F.when(F.col("l_linestatus") == "F", "cpu").otherwise("gpu").alias("device"),
        F.col("l_linenumber").alias("workers"),
        F.expr("shiftleft(1, l_linenumber)").alias("batch_size"),
        (F.col("l_suppkey") % 4).alias("worker_id"),
        F.col("l_quantity").alias("latency_ms"),
    )


TELEMETRY_SQL = """
telemetry AS (
  SELECT CASE l_returnflag WHEN 'N' THEN 'single' WHEN 'A' THEN 'thread' ELSE 'process' END AS mode,
         CASE l_linestatus WHEN 'F' THEN 'cpu' ELSE 'gpu' END AS device,
         l_linenumber AS workers, CAST(1 << l_linenumber AS INT) AS batch_size,
         l_suppkey % 4 AS worker_id, l_quantity AS latency_ms
  FROM lineitem)"""


LABELLED_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]
LABELLED_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price_cents"]


def flows_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled numeric rows in three "files"; the benign label carries stray spaces."""
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"),
        *LABELLED_FEATURES,
        F.when(priority == "5-LOW", " BENIGN ").otherwise(priority).alias("label"),
        F.col("l_returnflag").alias("source_file"),
    )


LABELLED_SQL = """
flows_labelled AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents,
         l_quantity, l_extendedprice, l_discount, l_tax, o_totalprice,
         CASE o_orderpriority WHEN '5-LOW' THEN ' BENIGN ' ELSE o_orderpriority END AS label,
         l_returnflag AS source_file
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def trainable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a learnable task: large quantities at a low discount are the attacks."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        ((F.col("l_quantity") > 35) & (F.col("l_discount") < 0.07)).cast("int").alias("label"),
    )


TRAINABLE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
