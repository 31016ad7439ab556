"""Registered queries: reading, cleaning, sampling, splitting and scaling labelled tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlake.operators import cleaning as C
from flowlake.operators import sampling as P
from flowlake.operators import scaling as Z
from flowlake.functions.ranks import global_row_number
from flowlake.plans import tables as T
from flowlake.runtime import scratch_path
from flowlake.sources import csv_flows as R

_PER_SOURCE = 5_000
_ID_LIST = ", ".join(T.LABELLED_ID)

# --- labelled files written from the line items ------------------------------------------------

# Header of the written files: stray spaces, a doubled name, a column no model uses.
_HEADER = " Flow Duration,Total Fwd Packets, Flow Bytes/s,Fwd Header Length,Fwd Header Length, Destination Port, Label"
_HEADER_SHORT = "Flow Duration, Flow Bytes/s,Destination Port,LABEL"


def _odd_number():
    """Prices, some replaced by what real files hold instead of numbers."""
    price = F.col("price_cents").cast("string")
    return (
        F.when(F.col("l_partkey") % 50 == 1, "Infinity")
        .when(F.col("l_partkey") % 50 == 2, "NaN")
        .when(F.col("l_partkey") % 50 == 3, "n/a")
        .when(F.col("l_partkey") % 50 == 4, F.concat(F.lit(" "), price, F.lit(" ")))
        .otherwise(price)
    )


def _label_text():
    return F.when(F.col("label") == " BENIGN ", "\tBENIGN ").otherwise(F.col("label"))


def _write_lines(df, line, header, path):
    """CSV lines as they are, with the header on top of every part file."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    df.select(F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line)).write.text(path)


def _remark(key):
    """A column that no model uses: on some lines a quoted text with doubled quotes, a comma and line breaks."""
    odd = F.concat(F.lit('"said ""no"", ""'), key.cast("string"), F.lit('"""'))
    broken = F.concat(F.lit('"first line, ""second"'), F.lit('" line\n'), key.cast("string"), F.lit('\n\n"'))
    return F.when(key % 40 == 9, broken).when(key % 40 == 10, odd).otherwise(key.cast("string"))


def _joined(*cols):
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def _full_line():
    """All columns; some lines are too long, some too short, some records go over several lines."""
    c = F.col
    full = _joined(
        c("l_partkey"), c("l_quantity").cast("int"), _odd_number(), _remark(c("l_orderkey")), c("l_linenumber"),
        c("l_suppkey"), _label_text(),
    )
    too_long = F.concat(full, F.lit(',"surplus, quoted"'))
    too_short = _joined(c("l_partkey"), c("l_quantity").cast("int"))
    return F.when(c("l_orderkey") % 40 == 7, too_long).when(c("l_orderkey") % 40 == 8, too_short).otherwise(full)


def _write_files(spark, sf_dir):
    """Three labelled "files", one with fewer columns and another label spelling."""
    folder = scratch_path(spark, "labelled-files")
    rows = T.flows_labelled(spark, sf_dir)
    c = F.col
    full, short = _full_line(), _joined(c("l_partkey"), _odd_number(), c("l_suppkey"), _label_text())
    for flag, line, header in [("A", full, _HEADER), ("N", full, _HEADER), ("R", short, _HEADER_SHORT)]:
        _write_lines(rows.where(c("source_file") == flag), line, header, f"{folder}/{flag}.csv")
    return folder


_FILE_COLUMNS = ["flow_duration", "fwd_packets", "flow_bytes_s", "dst_port"]


def read_flow_csv(spark, sf_dir):
    path = f"{scratch_path(spark, 'labelled')}/all.csv"
    _write_lines(T.flows_labelled(spark, sf_dir), _full_line(), _HEADER, path)
    return R.read_flow_csv(spark, path).select(*_FILE_COLUMNS, "label", "source_file")


def read_flow_csv_dir(spark, sf_dir):
    df = R.read_flow_csv_dir(spark, _write_files(spark, sf_dir))
    return df.select(*_FILE_COLUMNS, "label", "source_file")


def read_numeric_labels(spark, sf_dir):
    """A merged file whose label column holds 0 and 1 already."""
    path, c = f"{scratch_path(spark, 'labelled')}/merged.csv", F.col
    rows = T.flows_labelled(spark, sf_dir)
    line = _joined(c("l_partkey"), c("l_linenumber"), _odd_number(), c("l_suppkey"), (c("l_linenumber") % 2).cast("int"))
    _write_lines(rows, line, "Flow Duration,Total Fwd Packets,Flow Bytes/s,Destination Port,Label", path)
    return R.read_flow_csv(spark, path).select(*_FILE_COLUMNS, "label")


def _write_full_files(spark, sf_dir):
    """Two clean-headed files with an identity that SQL can rebuild, one without labels, and a cache
    file that must be skipped."""
    folder = scratch_path(spark, "labelled-files")
    rows = T.flows_labelled(spark, sf_dir)
    c = F.col
    line = _joined(
        c("l_partkey"), _remark(c("l_orderkey")), c("l_linenumber"), _odd_number(), c("l_suppkey"), _label_text()
    )
    line = F.when(c("l_orderkey") % 40 == 7, F.concat(line, F.lit(",surplus"))).otherwise(line)
    header = "Flow Duration,Remark,Total Fwd Packets,Flow Bytes/s,Destination Port,Label"
    for flag in ["A", "N", "R"]:
        _write_lines(rows.where(c("source_file") == flag), line, header, f"{folder}/{flag}.csv")
    for name in ["unlabelled.csv", R.CACHE_FILE]:
        _write_lines(rows, _joined(c("l_partkey")), "Flow Duration", f"{folder}/{name}")
    return folder


def read_flow_csv_sampled(spark, sf_dir):
    df = R.read_flow_csv_sampled(spark, _write_full_files(spark, sf_dir), per_source=_PER_SOURCE)
    return df.select(*_FILE_COLUMNS, "label", "label_text", "source_file")


def dataset_cache(spark, sf_dir):
    """Built on the first call, from which a sample is drawn; read back whole on the second."""
    folder, cache = _write_full_files(spark, sf_dir), scratch_path(spark, "cache")
    R.sample_of_cache(R.dataset_cache(spark, cache, folder), _PER_SOURCE).count()
    return R.dataset_cache(spark, cache, folder).select(*_FILE_COLUMNS, "label", "label_text", "source_file")


def read_mixed_csv(spark, sf_dir):
    path = scratch_path(spark, "mixed")
    items = T.flows_labelled(spark, sf_dir)
    c = F.col
    service = F.concat(F.lit('"svc-""x"",\n'), c("l_suppkey") % 5, F.lit('"'))
    service = F.when(c("l_partkey") % 9 == 0, "").otherwise(service)
    line = _joined(
        c("l_orderkey"), F.lit("10.0.0.1"), F.lit("10.0.0.2"), c("source_file"), service, c("l_linenumber"),
        _odd_number(), c("label"), (c("label") != " BENIGN ").cast("int"),
    )
    header = "id,srcip,dstip,proto,service, dur ,sbytes,attack_cat,label"
    _write_lines(items, line, header, f"{path}.csv")
    # "n/a" and blanks are missing values, so sbytes is a number and service has a category 'nan'.
    return R.read_mixed_csv(spark, f"{path}.csv")


def merge_tables(spark, sf_dir):
    """Orders and line items stacked by column name."""
    orders = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("label")
    )
    items = T.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("label")
    )
    return R.merge_tables([orders, items])


# --- cleaning steps ------------------------------------------------------------------------------


def _raw(spark, sf_dir):
    """Labelled rows as text under untidy names."""
    rows = T.flows_labelled(spark, sf_dir)
    return rows.select(
        F.col("l_orderkey").alias(" id"),
        F.col("l_partkey").cast("string").alias(" Flow Duration"),
        _odd_number().alias("Flow Bytes/s "),
        F.col("l_suppkey").cast("string").alias(" Destination Port"),
        F.col("source_file").alias("attack_cat"),
        _label_text().alias(" label"),
    )


def clean_column_names(spark, sf_dir):
    return C.clean_column_names(_raw(spark, sf_dir))


def resolve_label_column(spark, sf_dir):
    return C.resolve_label_column(C.clean_column_names(_raw(spark, sf_dir))).select("id", "Label")


def _named(spark, sf_dir):
    return C.resolve_label_column(C.clean_column_names(_raw(spark, sf_dir)))


def project_canonical(spark, sf_dir):
    df, missing = C.project_canonical(_named(spark, sf_dir))
    return df.withColumn("missing", F.lit(len(missing)))


_NUMBERS = ["Flow Duration", "Flow Bytes/s", "Destination Port"]


def coerce_numeric(spark, sf_dir):
    df = C.coerce_numeric(_named(spark, sf_dir), _NUMBERS)
    # Infinity and NaN are numbers to this step; they are counted, not compared.
    return df.groupBy("Label").agg(
        F.count_if(F.col("`Flow Bytes/s`").isNull()).alias("not_numbers"),
        F.count_if(F.isnan("`Flow Bytes/s`")).alias("nans"),
        F.count_if(F.col("`Flow Bytes/s`") == float("inf")).alias("infinite"),
        F.sum("Flow Duration").cast("bigint").alias("durations"),
    )


def nullify_nonfinite(spark, sf_dir):
    df = C.nullify_nonfinite(C.coerce_numeric(_named(spark, sf_dir), _NUMBERS), _NUMBERS)
    return df.select("id", F.col("Flow Bytes/s").alias("bytes"))


def drop_incomplete(spark, sf_dir):
    return C.clean_numbers(_named(spark, sf_dir), _NUMBERS).select("id", *_NUMBERS)


def binary_label(spark, sf_dir):
    return C.with_binary_label(T.flows_labelled(spark, sf_dir), "label", "attack").select(*T.LABELLED_ID, "attack")


def drop_identifiers(spark, sf_dir):
    return C.drop_identifiers(C.clean_column_names(_raw(spark, sf_dir)), "label")


def encode_categoricals(spark, sf_dir):
    rows = T.flows_labelled(spark, sf_dir).select(
        *T.LABELLED_ID, F.when(F.col("l_partkey") % 9 != 0, F.col("label")).alias("label"), "source_file"
    )
    return C.encode_categoricals(rows, ["label", "source_file"])


# --- sampling, splitting, scaling ----------------------------------------------------------------


def _labelled(spark, sf_dir):
    return T.flows_labelled(spark, sf_dir).select(*T.LABELLED_ID, "label", "source_file")


def stratified_sample(spark, sf_dir):
    return P.stratified_sample(_labelled(spark, sf_dir), T.LABELLED_ID, per_source=_PER_SOURCE)


def stratified_split(spark, sf_dir):
    return P.stratified_split(_labelled(spark, sf_dir), T.LABELLED_ID)


def seeded_shuffle(spark, sf_dir):
    """The shuffled rows, numbered as they come: in order of partition, then of their place in it."""
    shuffled = P.seeded_shuffle(_labelled(spark, sf_dir).select(*T.LABELLED_ID), T.LABELLED_ID)
    placed = shuffled.withColumn("at", F.monotonically_increasing_id())
    return global_row_number(placed, [F.col("at")], "position").drop("at")


def label_distribution(spark, sf_dir):
    return P.label_distribution(_labelled(spark, sf_dir)).withColumn("pct", F.round("pct", 6))


def split_class_counts(spark, sf_dir):
    rows = C.with_binary_label(_labelled(spark, sf_dir), "label", "label")
    return P.split_class_counts(P.stratified_split(rows, T.LABELLED_ID))


def scaler_stats(spark, sf_dir):
    stats = Z.scaler_stats(T.flows_labelled(spark, sf_dir), T.LABELLED_FEATURES)
    return stats.select(*[F.round(c, 4).alias(c) for c in stats.columns])


def standardize(spark, sf_dir):
    rows = T.flows_labelled(spark, sf_dir)
    scaled = Z.standardize(rows, Z.scaler_stats(rows, T.LABELLED_FEATURES), T.LABELLED_FEATURES)
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 4).alias(c) for c in T.LABELLED_FEATURES])


def class_weights(spark, sf_dir):
    rows = C.with_binary_label(_labelled(spark, sf_dir), "label", "label")
    balanced = Z.class_weights(rows, output="balanced")
    both = Z.class_weights(balanced, positive=4.0, output="fixed")
    return both.groupBy("label", "fixed", F.round("balanced", 6).alias("balanced")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in [
        read_flow_csv, read_flow_csv_dir, read_numeric_labels, read_flow_csv_sampled, dataset_cache, read_mixed_csv, merge_tables,
        clean_column_names, resolve_label_column, project_canonical, coerce_numeric, nullify_nonfinite,
        drop_incomplete, binary_label, drop_identifiers, encode_categoricals, stratified_sample,
        stratified_split, seeded_shuffle, label_distribution, split_class_counts, scaler_stats, standardize,
        class_weights,
    ]
}

# --- the same in SQL -------------------------------------------------------------------------

_L = T.LABELLED_SQL
_GOOD = "l_partkey % 50 NOT IN (1, 2, 3)"
_ATTACK = "CASE WHEN label = ' BENIGN ' THEN 0 ELSE 1 END"
_RAW_BYTES = """CASE l_partkey % 50 WHEN 1 THEN 'Infinity' WHEN 2 THEN 'NaN' WHEN 3 THEN 'n/a'
  WHEN 4 THEN ' ' || price_cents || ' ' ELSE price_cents::VARCHAR END"""
_RAW_LABEL = "CASE label WHEN ' BENIGN ' THEN chr(9) || 'BENIGN ' ELSE label END"
_WHOLE_LINES = "(source_file = 'R' OR l_orderkey % 40 NOT IN (7, 8))"


def _digest(cols: list[str]) -> str:
    return "md5('42|' || " + " || '|' || ".join(cols) + ")"


_ID_DIGEST = _digest(T.LABELLED_ID)
_SAMPLED_TEXT = [
    "l_partkey", "l_linenumber", f"({_RAW_BYTES})", "l_suppkey", "trim(label)", "(source_file || '.csv')"
]


def _sampled(order: str, where: str = "TRUE") -> str:
    return f"""
sized AS (SELECT *, count(*) OVER (PARTITION BY source_file) AS n_file,
                 count(*) OVER (PARTITION BY source_file, label) AS n_label,
                 row_number() OVER (PARTITION BY source_file, label ORDER BY {order}) AS rn FROM flows_labelled WHERE {where}),
sampled AS (SELECT * FROM sized WHERE n_file <= {_PER_SOURCE}
            OR rn <= greatest(1, floor({_PER_SOURCE} * n_label / n_file)))"""


_SCALED = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in T.LABELLED_FEATURES)

ORACLES = {
    "read_flow_csv": f"""WITH {_L}
SELECT l_partkey::DOUBLE AS flow_duration, floor(l_quantity)::DOUBLE AS fwd_packets,
       price_cents::DOUBLE AS flow_bytes_s, l_suppkey::DOUBLE AS dst_port, {_ATTACK}::INT AS label,
       'all.csv' AS source_file
FROM flows_labelled WHERE {_GOOD} AND l_orderkey % 40 NOT IN (7, 8)""",
    # File R has no packet count, so none of its rows is complete.
    "read_flow_csv_dir": f"""WITH {_L}
SELECT l_partkey::DOUBLE AS flow_duration, floor(l_quantity)::DOUBLE AS fwd_packets,
       price_cents::DOUBLE AS flow_bytes_s, l_suppkey::DOUBLE AS dst_port, {_ATTACK}::INT AS label,
       source_file || '.csv' AS source_file
FROM flows_labelled WHERE source_file <> 'R' AND {_GOOD} AND {_WHOLE_LINES}""",
    "read_flow_csv_sampled": f"""WITH {_L}, {_sampled(_digest(_SAMPLED_TEXT), "l_orderkey % 40 <> 7")}
SELECT l_partkey::DOUBLE AS flow_duration, l_linenumber::DOUBLE AS fwd_packets,
       price_cents::DOUBLE AS flow_bytes_s, l_suppkey::DOUBLE AS dst_port, {_ATTACK}::INT AS label,
       trim(label) AS label_text, source_file || '.csv' AS source_file
FROM sampled WHERE {_GOOD}""",
    "read_numeric_labels": f"""WITH {_L}
SELECT l_partkey::DOUBLE AS flow_duration, l_linenumber::DOUBLE AS fwd_packets,
       price_cents::DOUBLE AS flow_bytes_s, l_suppkey::DOUBLE AS dst_port, (l_linenumber % 2)::INT AS label
FROM flows_labelled WHERE {_GOOD}""",
    "dataset_cache": f"""WITH {_L}
SELECT l_partkey::DOUBLE AS flow_duration, l_linenumber::DOUBLE AS fwd_packets,
       price_cents::DOUBLE AS flow_bytes_s, l_suppkey::DOUBLE AS dst_port, {_ATTACK}::INT AS label,
       trim(label) AS label_text, source_file || '.csv' AS source_file
FROM flows_labelled WHERE {_GOOD} AND l_orderkey % 40 <> 7""",
    "read_mixed_csv": f"""WITH {_L},
t AS (SELECT *, CASE WHEN l_partkey % 9 = 0 THEN 'nan' ELSE 'svc-"x",' || chr(10) || (l_suppkey % 5) END AS service
      FROM flows_labelled),
coded AS (
  SELECT (dense_rank() OVER (ORDER BY source_file) - 1)::INT AS proto,
         (dense_rank() OVER (ORDER BY service) - 1)::INT AS service, l_partkey,
         l_linenumber::DOUBLE AS dur, price_cents::DOUBLE AS sbytes, {_ATTACK}::INT AS label FROM t)
SELECT * EXCLUDE (l_partkey) FROM coded WHERE {_GOOD}""",
    "merge_tables": """
SELECT o_orderkey AS key, o_totalprice AS price, o_orderpriority AS label FROM orders
UNION ALL BY NAME SELECT l_orderkey AS key, l_quantity AS quantity, l_returnflag AS label FROM lineitem""",
    "clean_column_names": f"""WITH {_L}
SELECT l_orderkey AS id, l_partkey::VARCHAR AS "Flow Duration", {_RAW_BYTES} AS "Flow Bytes/s",
       l_suppkey::VARCHAR AS "Destination Port", source_file AS attack_cat, {_RAW_LABEL} AS label
FROM flows_labelled""",
    "resolve_label_column": f'WITH {_L} SELECT l_orderkey AS id, {_RAW_LABEL} AS "Label" FROM flows_labelled',
    "project_canonical": f"""WITH {_L}
SELECT l_partkey::VARCHAR AS "Flow Duration", {_RAW_BYTES} AS "Flow Bytes/s",
       l_suppkey::VARCHAR AS "Destination Port", {_RAW_LABEL} AS "Label", 15 AS missing FROM flows_labelled""",
    "coerce_numeric": f"""WITH {_L}, t AS (SELECT *, try_cast({_RAW_BYTES} AS DOUBLE) AS b FROM flows_labelled)
SELECT {_RAW_LABEL} AS "Label", count(*) FILTER (b IS NULL) AS not_numbers, count(*) FILTER (isnan(b)) AS nans,
       count(*) FILTER (isinf(b)) AS infinite, sum(l_partkey)::BIGINT AS durations
FROM t GROUP BY 1""",
    "nullify_nonfinite": f"""WITH {_L}
SELECT l_orderkey AS id, CASE WHEN {_GOOD} THEN price_cents::DOUBLE END AS bytes FROM flows_labelled""",
    "drop_incomplete": f"""WITH {_L}
SELECT l_orderkey AS id, l_partkey::DOUBLE AS "Flow Duration", price_cents::DOUBLE AS "Flow Bytes/s",
       l_suppkey::DOUBLE AS "Destination Port" FROM flows_labelled WHERE {_GOOD}""",
    "binary_label": f"WITH {_L} SELECT {_ID_LIST}, {_ATTACK}::INT AS attack FROM flows_labelled",
    "drop_identifiers": f"""WITH {_L}
SELECT l_partkey::VARCHAR AS "Flow Duration", {_RAW_BYTES} AS "Flow Bytes/s",
       l_suppkey::VARCHAR AS "Destination Port" FROM flows_labelled""",
    "encode_categoricals": f"""WITH {_L},
t AS (SELECT *, CASE WHEN l_partkey % 9 = 0 THEN 'nan' ELSE label END AS k FROM flows_labelled)
SELECT {_ID_LIST}, (dense_rank() OVER (ORDER BY k) - 1)::INT AS label,
       (dense_rank() OVER (ORDER BY source_file) - 1)::INT AS source_file FROM t""",
    "stratified_sample": f"""WITH {_L}, {_sampled(_ID_DIGEST)}
SELECT {_ID_LIST}, label, source_file FROM sampled""",
    "stratified_split": f"""WITH {_L},
r AS (SELECT *, count(*) OVER (PARTITION BY label) AS n,
             row_number() OVER (PARTITION BY label ORDER BY {_ID_DIGEST}) AS rn FROM flows_labelled)
SELECT {_ID_LIST}, label, source_file, CASE WHEN rn <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r""",
    "seeded_shuffle": f"""WITH {_L}
SELECT {_ID_LIST}, row_number() OVER (ORDER BY {_ID_DIGEST}, {_ID_LIST}) AS position FROM flows_labelled""",
    "label_distribution": f"""WITH {_L}
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct
FROM flows_labelled GROUP BY 1""",
    "split_class_counts": f"""WITH {_L},
l AS (SELECT *, {_ATTACK} AS y FROM flows_labelled),
r AS (SELECT y, CASE WHEN row_number() OVER (PARTITION BY y ORDER BY {_ID_DIGEST})
                     <= round(0.2 * count(*) OVER (PARTITION BY y)) THEN 'test' ELSE 'train' END AS split FROM l)
SELECT split, count(*) FILTER (y = 0) AS normal, count(*) FILTER (y = 1) AS attack FROM r GROUP BY 1""",
    "scaler_stats": f"""WITH {_L}
SELECT {', '.join(f'round(avg({c}), 4) AS {c}_mean, round(stddev_pop({c}), 4) AS {c}_std' for c in T.LABELLED_FEATURES)}
FROM flows_labelled""",
    "standardize": f"""WITH {_L}, s AS (SELECT {_SCALED} FROM flows_labelled)
SELECT l_orderkey, l_linenumber, {', '.join(f'round(({c} - {c}_m) / {c}_s, 4) AS {c}' for c in T.LABELLED_FEATURES)}
FROM flows_labelled, s""",
    "class_weights": f"""WITH {_L}, l AS (SELECT {_ATTACK}::INT AS label FROM flows_labelled)
SELECT label, CASE label WHEN 1 THEN 4.0 ELSE 1.0 END::DOUBLE AS fixed,
       round(sum(count(*)) OVER () / (2 * count(*)), 6) AS balanced, count(*) AS n FROM l GROUP BY label""",
}
