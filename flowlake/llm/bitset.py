"""A bit table of fixed size over 64-bit hashes: a prefilter that never loses a row.

Its size is a constant, so it can be sent to every task whatever the number of hashes; with very many hashes
it only lets more rows pass, and these are joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of the table (4 MB when broadcast).
BITS = 25
_BLOCK = 1 << 15


def _packed(batches):
    tables = {}
    for batch in batches:
        places = batch.column(0).to_numpy()
        blocks = places // _BLOCK
        for block in np.unique(blocks).tolist():
            bits = tables.setdefault(block, np.zeros(_BLOCK, dtype=bool))
            bits[places[blocks == block] - block * _BLOCK] = True
    for block, bits in tables.items():
        yield pa.record_batch([pa.array([block], pa.int32()), pa.array([np.packbits(bits).tobytes()])], ["block", "bits"])


def bitset(df: DataFrame, key: Column) -> Broadcast:
    """The table of all values of the long column ``key``. At most 2^BITS positions reach the driver, as 4 MB of bits.

    They come in one job: a block's bits lie in one partition, however many partitions there are.
    """
    place = F.shiftrightunsigned(key, 64 - BITS).cast("int")
    rows = df.select(place.alias("p")).distinct().repartition(16, F.shiftright("p", 15)).mapInArrow(_packed, "block int, bits binary")
    table = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    for row in rows.collect():
        at = row.block * _BLOCK // 8
        table[at : at + _BLOCK // 8] |= np.frombuffer(row.bits, np.uint8)
    return df.sparkSession.sparkContext.broadcast(table)


def present(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the (unsigned) hashes may be in the table; never false for one that is."""
    place = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    return (table[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0
