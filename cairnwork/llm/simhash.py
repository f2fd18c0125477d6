"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints lie in cells by the population counts of three parts of their bits; a cell is cut into
tiles of bounded size. Two fingerprints within the radius have cells whose counts differ by the radius
at most in all (each differing bit moves one count by one), so all other tile pairs are skipped. The rest are compared with
exclusive-or and bit counts over whole tiles.

Tiles meet in a task that holds a group of one cell's tiles, while the tiles of the cells around it stream past: a tile is sent
once to each group around it, not to each tile. The visitors of a group are dealt into lots, each with its own copy of
the group, so no task grows with the data. A task returns a spanning forest of its links, not all of them,
so a large group of near copies never makes more edges than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnwork.llm.textscan import raw
from cairnwork.operators.graph import components
from cairnwork.plans.storage import bounded_batches, cut

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE_ROWS = 2048
#: Fingerprints that a task holds, and that visit it, about.
GROUP_ROWS = 1 << 17
LOT_ROWS = 1 << 19
#: Entries of a task's union-find; beyond them it starts anew, which only repeats edges.
FOREST = 1 << 20
#: Bits of the three parts.
PARTS = ((0, 21), (21, 42), (42, 64))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each 1 if set in over half of the shingles' XXH64; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hashes = np.array([hashed(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without its text, with `__fp` long. A null text has no words."""
    kept = [c for c in docs.columns if c != text]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = raw(batch[text])
            body = data.tobytes() if len(data) < 1 << 26 else data
            out = np.array([fingerprint(bytes(body[a:b])) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(out.view(np.int64))], names=[*kept, "__fp"])

    return bounded_batches(docs).mapInArrow(made, T.StructType([*docs.select(*kept).schema.fields, T.StructField("__fp", T.LongType())]))


class Forest:
    """Spanning edges of links that arrive in pieces."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    def add(self, a: np.ndarray, b: np.ndarray, radius: int = RADIUS, chunk: int = 1 << 20) -> list[tuple[int, int]]:
        """The links between the fingerprints a and b that join what was not joined."""
        if len(self.parent) > FOREST:
            self.parent = {}
        edges = []
        step = max(1, chunk // max(1, len(b)))
        for at in range(0, len(a), step):
            i, j = np.nonzero(np.bitwise_count(a[at : at + step, None] ^ b[None, :]) <= radius)
            for x, y in zip(a[at + i].tolist(), b[j].tolist()):
                if x != y and (p := self.root(x)) != (q := self.root(y)):
                    self.parent[max(p, q)] = min(p, q)
                    edges.append((x, y))
        return edges


CELL = [f"c{i}" for i in range(len(PARTS))]
MET = [*CELL, "group", "lot"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by MET, the held tiles (kind 0) first. The held ones are compared with each other in the first lot only."""
    met, held, forest = None, [], Forest()
    for batch in batches:
        edges = []
        keys = list(zip(*(batch[c].to_pylist() for c in MET)))
        kinds = batch["kind"].to_pylist()
        for r, key in enumerate(keys):
            if key != met:
                met, held, forest = key, [], Forest()
            tile = np.asarray(batch["fps"][r].values.to_numpy()).view(np.uint64)
            if kinds[r] == 0:
                held.append(tile)
            if kinds[r] == 1 or key[-1] == 0:
                for own in held:
                    edges += forest.add(tile, own)
        ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(ends[:, 0])), pa.array(np.ascontiguousarray(ends[:, 1]))], names=["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """(a, b): edges that connect all fingerprints of fps (distinct, column fp) within the radius."""
    counts = [F.bit_count(F.col("fp").bitwiseAND(sum(1 << k for k in range(lo, hi)) - (1 << 64 if hi == 64 else 0))).alias(c) for c, (lo, hi) in zip(CELL, PARTS)]
    held = fps.select("fp", *counts)
    # a row for each cell: 22 * 22 * 23 at most
    sizes = cut(held.groupBy(*CELL).agg(F.count("*").alias("n")).withColumn("groups", F.ceil(F.col("n") / GROUP_ROWS)), "cells")
    each = F.ceil(F.col("n") / TILE_ROWS)
    tiles = held.join(F.broadcast(sizes), CELL).withColumn("tile", F.pmod(F.xxhash64("fp"), each)).groupBy(*CELL, "tile", "groups").agg(F.collect_list("fp").alias("fps"))
    tiles = cut(tiles.withColumn("own", F.pmod("tile", "groups")).drop("groups", "tile"), "tiles")
    # each unordered pair of cells once: the first difference that is not 0 is positive. Visitors of a cell come from the cell `step` below it
    steps = [d for d in product(range(-RADIUS, RADIUS + 1), repeat=len(PARTS)) if sum(map(abs, d)) <= RADIUS and d >= (0,) * len(PARTS)]
    step = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), *(F.lit(x).alias(f"d{i}") for i, x in enumerate(d))) for k, d in enumerate(steps)))).alias("step")
    near = sizes.select(*(F.col(c).alias(f"v{c}") for c in CELL), "n", step).select(*(F.col(f"v{c}") for c in CELL), *((F.col(f"v{c}") + F.col(f"step.d{i}")).alias(c) for i, c in enumerate(CELL)), "n", F.col("step.k").alias("step"))
    lots = cut(near.groupBy(*CELL).agg(F.ceil(F.sum("n") / LOT_ROWS).alias("lots")).join(sizes.select(*CELL, "groups"), CELL), "lots")
    to = F.broadcast(near.drop("n").join(F.broadcast(lots), CELL))  # at most 32 rows for each cell
    # a cell's own tiles go to its later groups only; its groups compare their own tiles themselves
    apart = (F.col("step") > steps.index((0,) * len(PARTS))) | (F.col("group") > F.col("own"))
    visiting = tiles.withColumnsRenamed({c: f"v{c}" for c in CELL}).join(to, [f"v{c}" for c in CELL]).withColumn("group", F.explode(F.expr("sequence(0L, groups - 1)"))).where(apart)
    visiting = visiting.select(*CELL, "group", F.pmod(F.xxhash64("step", "own"), "lots").alias("lot"), F.lit(1).alias("kind"), "fps")
    holding = tiles.join(F.broadcast(lots), CELL).withColumn("lot", F.explode(F.expr("sequence(0L, lots - 1)"))).select(*CELL, F.col("own").alias("group"), "lot", F.lit(0).alias("kind"), "fps")
    total = sizes.select(F.sum("n")).first()[0] or 0
    tasks = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(1 << 14, -(-total // (1 << 16))))
    return holding.union(visiting).repartition(tasks, *MET).sortWithinPartitions(*MET, "kind").mapInArrow(_compare, "a long, b long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, `fp` long and `component_id`: the smallest key of all rows that links reach, the row's own included.

    Null and empty texts share fingerprint 0 and are linked like any other. Texts are read whole, whatever their length. Repeated rows stay
    repeated, an empty table gives an empty one, and other columns, whatever their names, are not read. A null
    key never names a component unless the component has no other.
    """
    held = cut(fingerprints(docs.select(key, text), text), "fps")
    fps = cut(held.groupBy(F.col("__fp").alias("fp")).agg(F.min(key).alias("least")), "distinct")
    roots = components(cut(links(fps.select("fp")), "links"), "a", "b")
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = cut(rooted.join(named, "root").select(F.col("fp").alias("__fp"), "component_id"), "named")
    return held.join(of_fp, "__fp").select(key, F.col("__fp").alias("fp"), "component_id")
