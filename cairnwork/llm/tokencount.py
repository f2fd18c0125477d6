"""Token counts by a separator scan over flat token files.

A token file is a stream of little-endian identifiers, a document after the other, each closed by the end-of-document
identifier; there is no index. The stream is read in blocks cut anywhere. One vectorised search finds a block's
separators; its documents but the first and last are counted on the spot. A prefix scan over the blocks of a
file (how many tokens and separators came before, where the last separator was) stitches the documents that
cross blocks and numbers all of them. The scan has two levels, so a file of any size is no single task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnwork.llm.textscan import blocks
from cairnwork.plans.storage import cut

#: Byte-level BPE ranks; identifier 50256 is free and ends documents.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
#: Tokens of a block, and blocks of a group of the prefix scan.
BLOCK_TOKENS = 1 << 18
GROUP = 1024

FLAT = "file long, block long, tokens binary"


def tokenizer(ranks: bytes):
    """An encoder from the text of a rank file."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def write_flat(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks_path: str = RANKS, end: int = END, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(blocks of uint16 token files, a file for each task; file, ordinal and key of their documents, in order). A null text is empty."""
    with open(ranks_path, "rb") as f:
        ranks = f.read()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = tokenizer(ranks), TaskContext.get().partitionId()
        block = ordinal = 0
        held, waiting = [], 0

        def out(tokens: bytes | None, first: int | None, keys: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": pa.array([file], pa.int64()), "block": pa.array([block if tokens is not None else None], pa.int64()), "tokens": pa.array([tokens], pa.binary()), "first": pa.array([first], pa.int64()), "keys": pa.array([keys], pa.list_(pa.int64()))})

        for batch in batches:
            for a, b, data, offsets in blocks(batch[text]):
                body = data.tobytes()
                yield out(None, ordinal, batch[key][a:b].to_pylist())
                ordinal += b - a
                for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    ids = encoder.encode_ordinary(body[x:y].decode("utf-8", "replace"))
                    ids.append(end)
                    held.append(np.array(ids, np.uint16))
                    waiting += len(ids)
                while waiting >= block_tokens:
                    stream = np.concatenate(held)
                    yield out(stream[:block_tokens].tobytes(), None, [])
                    block += 1
                    held, waiting = [stream[block_tokens:]], waiting - block_tokens
        if waiting:
            yield out(np.concatenate(held).tobytes(), None, [])

    both = cut(docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(made, FLAT + ", first long, keys array<long>"), "tokens")
    names = both.where("first IS NOT NULL").select("file", "first", F.posexplode("keys").alias("at", key)).select("file", (F.col("first") + F.col("at")).alias("ordinal"), key)
    return both.where("block IS NOT NULL").select("file", "block", "tokens"), names


def read_flat(spark: SparkSession, path: str, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of the token files at path, each at most 2 GB (what Spark's binaryFile reads); `file` is a hash of its path."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                body, step = batch["content"][r].as_buffer(), block_tokens * width
                for b, at in enumerate(range(0, body.size - body.size % width, step)):
                    part = body.slice(at, min(step, body.size - body.size % width - at)).to_pybytes()
                    yield pa.RecordBatch.from_pydict({"file": batch["file"][r : r + 1], "block": pa.array([b], pa.int64()), "tokens": pa.array([part], pa.binary())})

    return spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file"), "content").mapInArrow(made, FLAT)


def count_tokens(flat: DataFrame, end: int = END, dtype: str = "<u2") -> DataFrame:
    """file, ordinal (from 0), n_tokens of every document; the separator does not count.

    Two separators in a row close a document of no tokens. Tokens after a file's last separator are its last document.
    An empty file has none.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, first, last, inner = [], [], [], []
            for cell in batch["tokens"]:
                ids = np.frombuffer(cell.as_buffer(), dtype)
                at = np.flatnonzero(ids == end)
                n.append(len(ids))
                first.append(int(at[0]) if len(at) else None)
                last.append(int(at[-1]) if len(at) else None)
                inner.append(np.diff(at) - 1)
            yield pa.RecordBatch.from_pydict({"file": batch["file"], "block": batch["block"], "n": pa.array(n, pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64()), "inner": pa.array(inner, pa.list_(pa.int64()))})

    found = cut(flat.mapInArrow(scanned, "file long, block long, n long, first long, last long, inner array<long>"), "scan")
    ends = F.when(F.col("first").isNull(), 0).otherwise(F.size("inner") + 1)
    part = found.select("file", "block", "n", "first", "last", "inner", ends.alias("ends"), F.floor(F.col("block") / GROUP).alias("group"))
    earlier = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = part.withColumns({"n0": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "ends0": F.coalesce(F.sum("ends").over(earlier), F.lit(0))})
    inside = inside.withColumn("last_at", F.col("n0") + F.col("last")).withColumn("last0", F.max("last_at").over(earlier))
    groups = inside.groupBy("file", "group").agg(F.sum("n").alias("gn"), F.sum("ends").alias("gends"), F.max("last_at").alias("glast"))
    before = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumns({"gn0": F.coalesce(F.sum("gn").over(before), F.lit(0)), "gends0": F.coalesce(F.sum("gends").over(before), F.lit(0))})
    groups = groups.withColumn("glast0", F.coalesce(F.max(F.col("gn0") + F.col("glast")).over(before), F.lit(-1)))
    placed = inside.join(groups.select("file", "group", "gn0", "gends0", "glast0"), ["file", "group"])
    crossing = F.col("gn0") + F.col("n0") + F.col("first") - 1 - F.coalesce(F.col("gn0") + F.col("last0"), F.col("glast0"))
    closed = placed.where("first IS NOT NULL").select("file", (F.col("gends0") + F.col("ends0")).alias("base"), F.concat(F.array(crossing), "inner").alias("counts"))
    closed = closed.select("file", "base", F.posexplode("counts").alias("at", "n_tokens")).select("file", (F.col("base") + F.col("at")).alias("ordinal"), "n_tokens")
    whole = groups.groupBy("file").agg(F.sum("gn").alias("n"), F.sum("gends").alias("ordinal"), F.max(F.coalesce(F.col("gn0") + F.col("glast"), F.lit(-1))).alias("last"))
    left = whole.select("file", "ordinal", (F.col("n") - 1 - F.col("last")).alias("n_tokens")).where("n_tokens > 0")
    return closed.unionByName(left)


def document_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks_path: str = RANKS) -> DataFrame:
    """key and n_tokens of every document, by way of its token file. Repeated rows each have their own count."""
    flat, names = write_flat(docs, key, text, ranks_path)
    return names.join(count_tokens(flat), ["file", "ordinal"]).select(key, "n_tokens")
