"""Where the library may write its own intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER = "flowlake"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    A machine-local folder is used only when the master is local, because executors on
    other machines could not read it and a lost executor could not be replaced.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="flowlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{_FOLDER}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch folder; never handed out twice."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str) -> str:
    """Store ``df`` as parquet in the shared folder: cuts lineage and survives executor loss."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back."""
    path = write_scratch(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A side that has been measured and is no larger than this is sent to every executor.
BROADCAST_BYTES = 64 << 20
# A lookup no longer than this is held by the driver as literal rows.
LITERAL_ROWS = 10_000


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in memory: 16 per column, and the length of what is not of fixed size."""
    total = F.lit(16 * max(len(df.columns), 1)).cast("bigint")
    for field in df.schema:
        kind, col = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(col), F.lit(0))
        elif kind in ("array", "map", "struct", "variant"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0))
    return total


def checked_lookup(df: DataFrame, name: str) -> DataFrame:
    """A lookup table whose size is looked at before it is joined.

    A few rows become literals and are broadcast; a longer table is stored, measured, and broadcast only if its
    rows take at most ``BROADCAST_BYTES``. Otherwise the join shuffles and sorts both sides, which adaptive execution
    balances.
    """
    rows = df.limit(LITERAL_ROWS + 1).collect()
    if len(rows) <= LITERAL_ROWS:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return measured(stored(df, name))


def measured(table: DataFrame) -> DataFrame:
    """A stored table with the hint to broadcast it if its rows take at most ``BROADCAST_BYTES``, else to sort it.

    Without a hint the planner goes by the size of the files, which may be a hundredth of that of the rows.
    """
    size = table.agg(F.sum(row_bytes(table))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table.hint("merge")


def release_scratch(spark: SparkSession) -> bool:
    """Remove this application's intermediate tables. Call it after the last action."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
