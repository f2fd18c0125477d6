"""Exact top-k inner-product search with KD-trees over shards of space.

Median splits, fitted on a bounded sample, cut space into cells; every vector goes to its cell, and a cell with more
than SHARD_ROWS of them is dealt into pieces, so that a shard has a bound whatever repeats. A shard's own KD-tree (median
splits of the widest dimension, a tight bounding box at every node) is built once and stored. Only queries travel:

* each to its home shard, where it finds its first kth score;
* from there, with that score, to pages of the shards' outer boxes, which tell the shards it can still gain from;
* to those shards. A task holds one shard at a time, and the queries sent to it stream past.

In a shard, queries take the leaves best first, by the largest inner product that a box allows (a box allows no more than
the boxes around it, so this is the order in which a best-first walk of the tree reaches its leaves), and each query
stops when no box reaches its kth score. Queries that are at one leaf are scored together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnwork.plans.storage import bounded_batches, cut

SHARD_ROWS = 8192
QUERY_ROWS = 512
LEAF_ROWS = 256
#: Vectors that the cells are fitted on, over all vector lengths: what the driver gathers. Cells are at most an eighth of it.
SAMPLE_ROWS = 1 << 15
#: Boxes of a page.
PAGE_BOXES = 2048
#: Most partitions of a search.
MOST_TASKS = 1 << 14
#: Scores beyond the range of a long are held at its ends.
LONG = (-(2**63), 2**63 - 1)

Splits = tuple[np.ndarray, np.ndarray, np.ndarray]  # of each node: dimension (-1: a cell), cut, first child (or number of the cell)


def tree(vectors: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of rows, nodes (from, to, left child, right child; -1: leaf), lower and upper corners of their boxes)."""
    order, nodes, low, high = np.arange(len(vectors)), [], [], []
    todo = [(0, len(vectors), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        part = vectors[order[a:b]]
        low.append(part.min(0))
        high.append(part.max(0))
        here = len(nodes)
        nodes.append([a, b, -1, -1])
        if parent >= 0:
            nodes[parent][2 + side] = here
        spread = high[-1] - low[-1]
        if b - a > leaf and spread.max() > 0:
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, int(np.argmax(spread))], mid)]
            todo += [(a, a + mid, here, 0), (a + mid, b, here, 1)]
    return order, np.array(nodes, np.int32), np.array(low), np.array(high)


def splits(sample: np.ndarray, cells: int) -> Splits:
    """Median splits of the widest dimension, the fullest part first, into at most so many cells."""
    dim, cut_at, child = [-1], [0.0], [0]
    parts = {0: np.arange(len(sample))}
    made = 1
    while made < cells:
        node = max(parts, key=lambda x: (len(parts[x]), -x))
        rows = parts.pop(node)
        values = sample[rows]
        spread = values.max(0) - values.min(0) if len(rows) else np.zeros(1)
        if len(rows) < 2 or spread.max() <= 0:
            break
        d = int(np.argmax(spread))
        at = float(np.median(values[:, d]))
        right = values[:, d] >= at
        if right.all():
            at = float(np.nextafter(at, np.inf))
            right = values[:, d] >= at
        if right.all() or not right.any():
            break
        dim[node], cut_at[node], child[node] = d, at, len(dim)
        for own in (rows[~right], rows[right]):
            parts[len(dim)] = own
            dim.append(-1)
            cut_at.append(0.0)
            child.append(0)
        made += 1
    dim_ = np.array(dim)
    child_ = np.array(child)
    child_[dim_ < 0] = np.arange(int((dim_ < 0).sum()))
    return dim_, np.array(cut_at), child_


def cells_of(vectors: np.ndarray, made: Splits) -> np.ndarray:
    """The cell of each vector."""
    dim, cut_at, child = made
    node = np.zeros(len(vectors), np.int64)
    while len(walking := np.flatnonzero(dim[node] >= 0)):
        here = node[walking]
        node[walking] = child[here] + (vectors[walking, dim[here]] >= cut_at[here])
    return child[node]


class Shard:
    """A stored shard: rows, ids and vectors in the order of the tree."""

    def __init__(self, batch: pa.RecordBatch, r: int) -> None:
        dim = batch["dim"][r].as_py()
        cell = lambda c, kind: np.frombuffer(batch[c][r].as_buffer(), kind)
        self.rows, self.ids = cell("rows", np.int64), cell("ids", np.int64)
        self.vectors, self.low, self.high = (cell(c, np.float64).reshape(-1, dim) for c in ("m", "low", "high"))
        nodes = cell("nodes", np.int32).reshape(-1, 4)
        leaf = nodes[:, 2] < 0
        self.leaves, self.low, self.high = nodes[leaf], self.low[leaf], self.high[leaf]

    def search(self, q: np.ndarray, q_rows: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(query's place, score, id, row) of the k best of each query, in order, those below its floor left out."""
        bounds = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        order = np.argsort(-bounds, axis=1, kind="stable")
        floors = floors.copy()
        held = tuple(np.zeros(0, t) for t in (np.int64, np.float64, np.int64, np.int64))
        for turn in range(order.shape[1]):
            leaf = order[:, turn]
            active = np.flatnonzero(bounds[np.arange(len(q)), leaf] >= floors)
            if not len(active):
                break
            fresh = [held]
            for at in np.unique(leaf[active]):
                a, b = self.leaves[at, :2]
                who = active[leaf[active] == at]
                score = q[who] @ self.vectors[a:b].T
                i, j = np.nonzero((score >= floors[who, None]) & (self.rows[None, a:b] != q_rows[who, None]))
                fresh.append((who[i], score[i, j], self.ids[a + j], self.rows[a + j]))
            place, score, ids, rows = (np.concatenate(x) for x in zip(*fresh))
            best = np.lexsort((rows, ids, -score, place))
            first = np.searchsorted(place[best], place[best])
            kept = best[np.arange(len(best)) - first < k]
            held = place[kept], score[kept], ids[kept], rows[kept]
            ends = np.searchsorted(held[0], np.arange(len(q)), "right")
            full = np.flatnonzero(np.bincount(held[0], minlength=len(q)) == k)
            floors[full] = np.maximum(floors[full], held[1][ends[full] - 1])
        return held


def _packed_shard(t: pa.Table) -> pa.Table:
    """A shard's row: its tree, and rows, ids and vectors in its order."""
    t = t.combine_chunks()
    dim = t["dim"][0].as_py()
    vectors = t["v"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    start = np.lexsort((t["row"].to_numpy(), t["id"].to_numpy()))
    order, nodes, low, high = tree(vectors[start])
    order = start[order]
    body = {"rows": t["row"].to_numpy()[order].astype(np.int64), "ids": t["id"].to_numpy()[order].astype(np.int64), "m": vectors[order], "nodes": nodes, "low": low, "high": high}
    return pa.table({"dim": t["dim"].slice(0, 1), "shard": t["shard"].slice(0, 1), **{c: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for c, x in body.items()}})


SHARD = "dim int, shard long, rows binary, ids binary, m binary, nodes binary, low binary, high binary"
ASK = "dim int, shard long, part long, q_rows binary, q_ids binary, q binary, floors binary"
HIT = "dim int, shard long, part long, q_rows binary, q_ids binary, q binary, floors binary, hits array<struct<query long, vec_id long, score long, asked long, row long>>"


def _packed_asks(t: pa.Table) -> pa.Table:
    """Blocks of a home shard's queries."""
    t = t.combine_chunks()
    dim = t["dim"][0].as_py()
    order = np.lexsort((t["row"].to_numpy(), t["id"].to_numpy()))
    vectors = t["v"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)[order]
    rows, ids = t["row"].to_numpy()[order].astype(np.int64), t["id"].to_numpy()[order].astype(np.int64)
    at = range(0, len(order), QUERY_ROWS)
    cols = {"q_rows": rows, "q_ids": ids, "q": vectors, "floors": np.full(len(order), -np.inf)}
    return pa.table({"dim": pa.array([dim] * len(at), pa.int32()), "shard": pa.array([t["shard"][0].as_py()] * len(at), pa.int64()), "part": pa.array(range(len(at)), pa.int64()), **{c: pa.array([np.ascontiguousarray(x[a : a + QUERY_ROWS]).tobytes() for a in at], pa.binary()) for c, x in cols.items()}})


def _asked(batch: pa.RecordBatch, r: int) -> tuple[np.ndarray, ...]:
    dim = batch["dim"][r].as_py()
    cell = lambda c, kind: np.frombuffer(batch[c][r].as_buffer(), kind)
    return cell("q_rows", np.int64), cell("q_ids", np.int64), cell("q", np.float64).reshape(-1, dim), cell("floors", np.float64)


def _searched(shards: DataFrame, asks: DataFrame, k: int, tasks: int) -> DataFrame:
    """HIT rows: each block of queries with what it found in its shard, and its floors after that."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, name = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                here = (batch["dim"][r].as_py(), batch["shard"][r].as_py())
                if batch["kind"][r].as_py() == 0:
                    shard, name = Shard(batch, r), here
                    continue
                assert name == here
                q_rows, q_ids, q, floors = _asked(batch, r)
                place, score, ids, rows = shard.search(q, q_rows, floors, k)
                floors = floors.copy()
                ends = np.searchsorted(place, np.arange(len(q)), "right")
                full = np.flatnonzero(np.bincount(place, minlength=len(q)) == k)
                floors[full] = np.maximum(floors[full], score[ends[full] - 1])
                hits = [dict(query=a, vec_id=b, score=min(max(int(s), LONG[0]), LONG[1]), asked=c, row=d) for a, b, s, c, d in zip(q_ids[place].tolist(), ids.tolist(), score.tolist(), q_rows[place].tolist(), rows.tolist())]
                own = {c: batch[c].slice(r, 1) for c in ("dim", "shard", "part", "q_rows", "q_ids", "q")}
                yield pa.RecordBatch.from_pydict({**own, "floors": pa.array([floors.tobytes()], pa.binary()), "hits": pa.array([hits], pa.list_(pa.struct([(c, pa.int64()) for c in ("query", "vec_id", "score", "asked", "row")])))})

    both = shards.withColumn("kind", F.lit(0)).unionByName(asks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    ordered = bounded_batches(both).repartition(tasks, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    return ordered.mapInArrow(found, HIT)


def _reached(pages: DataFrame, asks: DataFrame, tasks: int) -> DataFrame:
    """ASK rows: of each block of queries those that a shard's outer box lets gain, for every shard but their home."""

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = None
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch["dim"][r].as_py()
                if batch["kind"][r].as_py() == 0:
                    corners = [np.stack([np.frombuffer(x, np.float64, dim) for x in batch[c][r].as_py()]) for c in ("lows", "highs")]
                    boxes = np.array(batch["members"][r].as_py()), *corners
                    continue
                q_rows, q_ids, q, floors = _asked(batch, r)
                members, low, high = boxes
                reach = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T >= floors[:, None]
                reach[:, members == batch["shard"][r].as_py()] = False
                to = np.flatnonzero(reach.any(0))
                cols: dict[str, list] = {c: [] for c in ("q_rows", "q_ids", "q", "floors")}
                for at in to:
                    who = np.flatnonzero(reach[:, at])
                    for c, x in zip(cols, (q_rows, q_ids, q, floors)):
                        cols[c].append(np.ascontiguousarray(x[who]).tobytes())
                    if len(cols["q"]) * len(q) >= 1 << 13 or at == to[-1]:  # some megabytes a batch
                        n = len(cols["q"])
                        done = to[: np.searchsorted(to, at, "right")][-n:]
                        yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * n, pa.int32()), "shard": pa.array(members[done], pa.int64()), "part": pa.array([0] * n, pa.int64()), **{c: pa.array(x, pa.binary()) for c, x in cols.items()}})
                        cols = {c: [] for c in cols}

    sent = asks.join(F.broadcast(pages.groupBy("dim").agg(F.collect_list("page").alias("__pages"))), "dim").withColumn("page", F.explode("__pages")).drop("__pages")  # a list of page numbers for each vector length
    both = pages.withColumn("kind", F.lit(0)).unionByName(sent.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return bounded_batches(both).repartition(tasks, "dim", "page").sortWithinPartitions("dim", "page", "kind").mapInArrow(tested, ASK)


def top_k(vectors: DataFrame, asks: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each row for which `asks` holds, ties to the smaller id.

    Candidates are all other rows of the table, those that share the query's id among them; each row that asks has its own k, repeated rows
    and rows of one id too. Vectors that are null or empty, have null or non-finite components, or have a null id take no part,
    and vectors of other lengths than the query's are no candidates. Fewer than k candidates: all of them; an empty table gives an
    empty one. Other columns, whatever their names, are not read. Products are exact while they stay below 2^53. A vector is never cut,
    but a shard's vectors are one row: SHARD_ROWS of them must fit one, so very long vectors (over some 20,000 components) need a lower SHARD_ROWS.
    """
    v = F.col(vector_col)
    ok = v.isNotNull() & (F.size(v) > 0) & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    clean = vectors.where(ok).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"), F.size(v).alias("dim"), F.coalesce(asks, F.lit(False)).alias("asks"))
    sizes = {r["dim"]: r["n"] for r in clean.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row for each vector length
    total = sum(sizes.values())
    sample = clean.where(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / max(1, total)) * (1 << 30))).select("dim", "v").orderBy("dim").limit(2 * SAMPLE_ROWS) if total > SHARD_ROWS else None
    drawn: dict[int, list] = {}
    for r in sample.collect() if sample is not None else ():
        drawn.setdefault(r["dim"], []).append(r["v"])
    made = {d: splits(np.array(x, np.float64), min(-(-sizes[d] // SHARD_ROWS), SAMPLE_ROWS // 8)) for d, x in drawn.items()}
    one = (np.array([-1]), np.zeros(1), np.zeros(1, np.int64))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cell = batch["dim"].to_numpy(), np.zeros(batch.num_rows, np.int64)
            flat = batch["v"].flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(dims)])
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                cell[own] = cells_of(flat[(first[own][:, None] + np.arange(d)).ravel()].reshape(-1, d), made.get(d, one))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    cells = bounded_batches(clean).mapInArrow(routed, "id long, v array<double>, dim int, asks boolean, cell long")
    rows = cut(cells.withColumn("row", F.monotonically_increasing_id()), "cells")
    pieces = F.broadcast(rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("pieces")))  # a row for each cell
    dealt = rows.join(pieces, ["dim", "cell"]).withColumn("shard", F.shiftleft("cell", 32) + F.pmod(F.xxhash64("row"), "pieces"))
    shards = cut(dealt.select("dim", "shard", "row", "id", "v").groupBy("dim", "shard").applyInArrow(_packed_shard, SHARD), "shards")
    queries = cut(dealt.where("asks").select("dim", "shard", "row", "id", "v").groupBy("dim", "shard").applyInArrow(_packed_asks, ASK), "asks")
    number = shards.select(F.count("*")).first()[0]
    tasks = max(1, min(number, MOST_TASKS))
    home = cut(_searched(shards, queries, k, tasks), "home")
    page = F.pmod(F.xxhash64("shard"), F.lit(max(1, -(-number // PAGE_BOXES))))
    corner = lambda c: F.substring(c, F.lit(1), F.col("dim") * 8)
    box = F.struct("shard", corner("low").alias("l"), corner("high").alias("h"))  # the root's box comes first
    pages = cut(shards.withColumn("page", page).groupBy("dim", "page").agg(F.collect_list(box).alias("b")).select("dim", "page", F.col("b.shard").alias("members"), F.col("b.l").alias("lows"), F.col("b.h").alias("highs")), "pages")
    further = cut(_reached(pages, home.drop("hits"), tasks), "sent")
    hits = home.select(F.inline("hits")).union(_searched(shards, further, k, tasks).select(F.inline("hits")))
    rank = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "row"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
