"""Column names, schemas and default constants."""

from __future__ import annotations

from pyspark.sql import types as T

# The 18 model features, in model order, as labelled flow files name them.
CANONICAL_FEATURES = [
    "Flow Duration",
    "Total Fwd Packets",
    "Total Backward Packets",
    "Flow Bytes/s",
    "Flow Packets/s",
    "Down/Up Ratio",
    "Fwd Packet Length Mean",
    "Bwd Packet Length Mean",
    "SYN Flag Count",
    "FIN Flag Count",
    "RST Flag Count",
    "PSH Flag Count",
    "ACK Flag Count",
    "Active Mean",
    "Idle Mean",
    "Flow IAT Mean",
    "Flow IAT Std",
    "Destination Port",
]

# The same features, in the same order, as columns of a flow table.
FLOW_FEATURES = [
    "flow_duration",
    "fwd_packets",
    "bwd_packets",
    "flow_bytes_s",
    "flow_packets_s",
    "down_up_ratio",
    "fwd_len_mean",
    "bwd_len_mean",
    "syn_count",
    "fin_count",
    "rst_count",
    "psh_count",
    "ack_count",
    "active_mean",
    "idle_mean",
    "iat_mean",
    "iat_std",
    "dst_port",
]

SNAKE_CASE = dict(zip(CANONICAL_FEATURES, FLOW_FEATURES))

# Value of a feature that is missing; every other feature is 0.
FEATURE_DEFAULTS = {"fwd_packets": 1.0, "down_up_ratio": 1.0}

FLAGS = ["syn", "ack", "fin", "rst", "psh"]
FIVE_TUPLE = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol"]

PACKET_SCHEMA = T.StructType(
    [
        T.StructField("packet_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.IntegerType()),
        T.StructField("size", T.LongType()),
    ]
    + [T.StructField(flag, T.BooleanType()) for flag in FLAGS]
)

# Label handling
LABEL_CANDIDATES = ["Label", "label", "LABEL"]
BENIGN = "BENIGN"
IDENTIFIER_COLUMNS = ["id", "attack_cat", "srcip", "dstip"]

# Texts a CSV reader of the data-frame world takes as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Defaults of the operators
FLOW_TIMEOUT_S = 60
ALERT_THRESHOLD = 0.7
THRESHOLD_BOUNDS = (0.3, 0.99)
BATCH_SIZE = 64
BATCH_BOUNDS = (8, 512)
BATCH_TIMEOUT_S = 0.5
CRITICAL_CUT = 0.90
MEDIUM_CUT = 0.78
ROLLING_LENGTH = 2000
TIMELINE_BUCKETS = 60
ALERTS_KEPT = 50
ALERTS_SHOWN = 30
TOP_K = {"src_ip": 8, "dst_port": 8, "dst_ip": 6}
HISTOGRAM_BINS = 10
SAMPLE_PER_FILE = 100_000
TEST_SHARE = 0.2
SEED = 42
POSITIVE_WEIGHT = 4.0
