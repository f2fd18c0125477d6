"""Rows known by where they stand in their files, so that decisions travel and texts do not.

An operator decides over small rows (position, key); what it decided comes back to the stored documents as packed
numbers, a cell for each row of a chunk. The packed numbers are broadcast if they are small enough, which is checked; otherwise
they are joined by position, which shuffles the documents once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnwork.plans.storage import cut

CHUNK_BITS = 16
#: Packed numbers up to this size are broadcast: 64 million rows at a byte each.
BROADCAST_BYTES = 64 << 20

PLACE = ["__f", "__r"]


def positioned(docs: DataFrame) -> DataFrame:
    """docs with __f (a hash of the file's path) and __r (the row's number in it), which no two rows share. What is not a plain scan of files is stored first."""
    if not _scan(docs):
        docs = cut(docs, "docs")
    at = docs.metadataColumn("_metadata")
    return docs.select("*", F.xxhash64(at["file_path"]).alias("__f"), at["row_index"].alias("__r"))


def _scan(docs: DataFrame) -> bool:
    """Whether docs is a Parquet table or some of its rows and columns, each row once."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    return "LogicalRelation" in node.getClass().getName() and "parquet" in node.toString().lower()


def attach(rows: DataFrame, facts: DataFrame, name: str, width: int) -> DataFrame:
    """Positioned rows with a column more: the number (below 256^width - 1, not negative) that facts (__f, __r, value) have for a row, null without any."""

    def pack(t: pa.Table) -> pa.Table:
        at = t["__r"].to_numpy().astype(np.int64) & ((1 << CHUNK_BITS) - 1)
        cells = np.zeros((int(at.max()) + 1, 8), np.uint8)
        cells[at] = (t["value"].to_numpy().astype(np.int64) + 1).astype(">u8").view(np.uint8).reshape(-1, 8)
        return pa.table({"__f": t["__f"].slice(0, 1), "__c": t["__c"].slice(0, 1), "__b": pa.array([np.ascontiguousarray(cells[:, 8 - width :]).tobytes()], pa.binary())})

    chunk = F.shiftright("__r", CHUNK_BITS)
    held = facts.select("__f", "__r", chunk.alias("__c"), F.col("value").cast("long").alias("value"))
    packed = cut(held.groupBy("__f", "__c").applyInArrow(pack, "__f long, __c long, __b binary"), "packed")
    if (packed.select(F.sum(F.octet_length("__b"))).first()[0] or 0) > BROADCAST_BYTES:
        return rows.join(facts.select(*PLACE, F.col("value").cast("long").alias(name)), PLACE, "left")
    cell = F.substring("__b", (F.col("__r").bitwiseAND((1 << CHUNK_BITS) - 1) * width + 1).cast("int"), F.lit(width))
    number = F.conv(F.hex(cell), 16, 10).cast("long") - 1
    return rows.withColumn("__c", chunk).join(F.broadcast(packed), ["__f", "__c"], "left").withColumn(name, F.when(number >= 0, number)).drop("__c", "__b")
