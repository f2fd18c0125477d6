"""Blocks of documents, and rounds in which blocks ask what other blocks hold.

A block is a run of whole documents of bounded size, stored once so that its number and order never change. The table of
blocks is bucketed by their number, so that answers travel to the blocks and no text is shuffled, at any size. In a
round every block sends each distinct key it holds once, in packed rows per bucket of keys; a bucket
answers each row with one byte per key. So a key that a third of all rows hold costs a bucket one
entry per block, never one per row, and no answer is larger than its question.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnwork.llm.textscan import BLOCK_BYTES, blocks
from cairnwork.plans.storage import bounded_batches, cut_bucketed

#: Bytes of packed keys in a bucket, about.
BUCKET_BYTES = 6 << 20

PACK = "block long, bucket long, sent binary"


def _hash(x: np.ndarray) -> np.ndarray:
    """Spark's hash (Murmur3, seed 42) of longs. Only a hint: the writer itself places rows."""

    def turn(v: np.ndarray, by: int) -> np.ndarray:
        return (v << np.uint32(by)) | (v >> np.uint32(32 - by))

    h = np.full(len(x), 42, np.uint32)
    for half in ((x & 0xFFFFFFFF).astype(np.uint32), (x >> 32).astype(np.uint32)):
        h ^= turn(half * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
        h = turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def _numbers(task: int, buckets: int) -> Iterator[int]:
    """Block numbers of a task that all fall into one bucket, so that a task writes one file."""
    for at in range(task << 32, (task + 1) << 32, 1 << 14):
        x = np.arange(at, at + (1 << 14), dtype=np.int64)
        yield from x[_hash(x) % np.int32(buckets) == task % buckets].tolist()


def block_table(docs: DataFrame, key: str, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, keys array<long>, offsets binary (int64), body binary: all documents, each whole in one block."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _numbers(TaskContext.get().partitionId(), buckets)
        for batch in batches:
            for a, b, data, offsets in blocks(batch[text], block_bytes):
                yield pa.RecordBatch.from_pydict({"block": pa.array([next(numbers)], pa.int64()), "keys": pa.array([batch[key][a:b].to_pylist()], pa.list_(pa.int64())), "offsets": pa.array([offsets.astype(np.int64).tobytes()], pa.binary()), "body": pa.array([data.tobytes()], pa.binary())})

    held = bounded_batches(docs).select(F.col(key).cast("long").alias(key), F.col(text).alias(text))
    return cut_bucketed(held.mapInArrow(made, "block long, keys array<long>, offsets binary, body binary"), "blocks", "block", buckets)


def opened(batch: pa.RecordBatch, r: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a block."""
    return np.frombuffer(batch["body"][r].as_buffer(), np.uint8), np.frombuffer(batch["offsets"][r].as_py(), np.int64)


def bucket_count(table: DataFrame, entry_bytes_per_byte: float) -> int:
    """Buckets for keys that take so many bytes for each byte of text."""
    size = table.select(F.sum(F.octet_length("body"))).first()[0] or 0
    return max(1, int(size * entry_bytes_per_byte // BUCKET_BYTES) + 1)


def packs(bucket: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its entries), for entries in their order."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for i, at in enumerate(edges):
        yield int(bucket[order[at]]), order[at : edges[i + 1] if i + 1 < len(edges) else len(order)]


Judge = Callable[[np.ndarray, np.ndarray], np.ndarray]


def answered(sent: DataFrame, judge: Callable[[int], tuple[Judge, np.dtype]]) -> DataFrame:
    """(block, bucket, got, hits): a bucket's judge, given its entries and the number of the block of each, makes a byte for each entry; hits counts those that are not 0."""

    def reply(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("block")
        decide, dtype = judge(t["bucket"][0].as_py())
        sent_ = [np.frombuffer(x, dtype) for x in t["sent"].to_pylist()]
        sizes = np.array([len(x) for x in sent_])
        flags = decide(np.concatenate(sent_), np.repeat(np.arange(len(sizes)), sizes)).astype(np.uint8)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        got = [flags[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return pa.table({"block": t["block"], "bucket": t["bucket"], "got": pa.array(got, pa.binary()), "hits": pa.array([int((flags[a:b] > 0).sum()) for a, b in zip(ends[:-1], ends[1:])], pa.int64())})

    return sent.groupBy("bucket").applyInArrow(reply, "block long, bucket long, got binary, hits long")


def joined(table: DataFrame, per_block: DataFrame, name: str = "answers") -> DataFrame:
    """table with the rows of per_block gathered under a name (null without any); only per_block is shuffled."""
    gathered = per_block.groupBy("block").agg(F.collect_list(F.struct(*(c for c in per_block.columns[1:] if c != "hits"))).alias(name))
    return table.join(gathered.hint("shuffle_hash"), "block", "left")


def answers(batch: pa.RecordBatch, r: int, name: str = "answers") -> dict[int, np.ndarray]:
    """bucket -> a byte for each key sent."""
    cell = batch[name][r].as_py() or []
    return {x["bucket"]: np.frombuffer(x["got"], np.uint8) for x in cell}


def repeated(entries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """1 for each entry (h, many) that is held twice or more: by two blocks, or by one more than once."""
    _, place, count = np.unique(entries["h"], return_inverse=True, return_counts=True)
    twice = count > 1
    twice[place[entries["many"] > 0]] = True
    return twice[place]


KEY = np.dtype([("h", "<u8"), ("many", "u1")])


def send_keys(hashes: np.ndarray, route: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct entries, bucket of each, place of each hash among them). route: hashes that choose buckets."""
    h, first, place, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    entries = np.zeros(len(h), KEY)
    entries["h"], entries["many"] = h, count > 1
    return entries, (route[first] % np.uint64(buckets)).astype(np.int64), place


def spread(got: dict[int, np.ndarray], bucket: np.ndarray) -> np.ndarray:
    """The answers in the order of the entries that were sent."""
    out = np.zeros(len(bucket), np.uint8)
    for b, places in packs(bucket, bucket):
        out[places] = got[b]
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + width) for a start s."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:n]) > 0
