"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is the expected number of times each of its documents is taken. The
whole part is taken for certain; the fraction is an inclusion probability. The flight phase moves
these probabilities through the null-space of the two balancing totals (tokens and documents) until
all but two of a block are 0 or 1; the open ones of many blocks meet in the next level's blocks,
until a source has one block, whose last two are settled by the landing phase. Both totals are
therefore kept exactly up to the landing of at most two documents a source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnwork.llm.textscan import SPACE, blocks, spans
from cairnwork.plans.storage import bounded_batches, cut, local_table

#: Most times that one document is taken.
REPEATS = 3
#: Documents of a flight block, about.
BLOCK_ROWS = 400
EPS = 1e-9


@F.arrow_udf(T.LongType())
def word_count(text: pa.Array) -> pa.Array:
    """Number of [^\\x20\\x09-\\x0D]+ in each text; null has none."""
    out = [np.zeros(0, np.int64)]
    for _, _, data, offsets in blocks(text):
        out.append(np.diff(spans(~SPACE[data], offsets)[2]))
    return pa.array(np.concatenate(out).astype(np.int64))


def targets(sizes: list[tuple[str | None, int]], repeats: int = REPEATS) -> dict[str | None, float]:
    """Target of each source: shares by weight 1, 2, 3, repeating, of the total; none above repeats times its size."""
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-8", "surrogatepass")))
    weight = {s: i % 3 + 1 for i, (s, _) in enumerate(order)}
    cap, left, out = {s: float(repeats * n) for s, n in sizes}, float(sum(n for _, n in sizes)), {}
    open_ = dict(weight)
    while open_:
        share = left / sum(open_.values())
        full = [s for s in open_ if share * open_[s] > cap[s]]
        if not full:
            out |= {s: share * w for s, w in open_.items()}
            break
        for s in full:
            out[s] = cap[s]
            left -= cap[s]
            del open_[s]
    return out


def flight(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight phase: at most two are neither 0 nor 1; sum(p) and sum(p * size) are kept."""
    p = p.tolist()
    size = size.tolist()
    coins = draw.random(len(p) + 3).tolist()
    held: list[int] = []
    k = 0
    for i in range(len(p)):
        if EPS < p[i] < 1 - EPS:
            held.append(i)
        while len(held) == 3:
            a, b, c = held
            u = (float(size[c] - size[b]), float(size[a] - size[c]), float(size[b] - size[a]))
            if u == (0.0, 0.0, 0.0):
                u = (1.0, -1.0, 0.0)
            ups, downs = [], []
            for j, x in zip(held, u):
                if x > 0:
                    ups.append((1 - p[j]) / x)
                    downs.append(p[j] / x)
                elif x < 0:
                    ups.append(-p[j] / x)
                    downs.append((p[j] - 1) / x)
            up, down = min(ups), min(downs)
            step = up if coins[k % len(coins)] * (up + down) < down else -down
            k += 1
            for j, x in zip(held, u):
                p[j] += step * x
                if p[j] < EPS:
                    p[j] = 0.0
                elif p[j] > 1 - EPS:
                    p[j] = 1.0
            held = [j for j in held if 0.0 < p[j] < 1.0]
    return np.array(p)


def landing(p: np.ndarray, p0: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The open probabilities of p (two at most) become 0 or 1 so that tokens, then documents, change least against p0."""
    open_ = np.flatnonzero((p > 0) & (p < 1))
    best = None
    for bits in range(1 << len(open_)):
        pick = np.array([bits >> j & 1 for j in range(len(open_))], float)
        miss = pick - p[open_]
        cost = (abs(float(miss @ size[open_])), abs(float(miss.sum())), bits)
        if best is None or cost < best[0]:
            best = (cost, pick)
    out = p.copy()
    out[open_] = best[1]
    # what the landing left over: trade a taken document for one that is not, while that brings the tokens nearer
    for _ in range(4):
        miss = float((out - p0) @ size)
        taken, free = np.flatnonzero(out == 1), np.flatnonzero(out == 0)
        if abs(miss) < 1 or not len(taken) or not len(free):
            break
        after = np.abs(miss - size[taken][:, None] + size[free][None, :])
        i, j = divmod(int(np.argmin(after)), len(free))
        if after[i, j] >= abs(miss):
            break
        out[taken[i]], out[free[j]] = 0.0, 1.0
    return out


def _settled(df: DataFrame, last: bool, seed: int) -> DataFrame:
    """One level: a flight in each (source, block); with last, a landing after it."""

    def level(group: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(group, [("__size", "ascending"), ("__tie", "ascending")])
        group = group.take(order)
        p, size, tie = (group[c].to_numpy(zero_copy_only=False) for c in ("__p", "__size", "__tie"))
        start = p
        p = flight(start, size, np.random.default_rng([seed, len(p), int(np.bitwise_xor.reduce(tie)) & (2**63 - 1)]))
        p = landing(p, start, size) if last else p
        return group.set_column(group.schema.get_field_index("__p"), "__p", pa.array(p))

    return df.groupBy("__source", "__block").applyInArrow(level, df.schema)


def mix(docs: DataFrame, kept: list[str] | None = None, source: str = "source", text: str = "text", key: str = "doc_id", seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """docs (of its columns `kept`, or all) with `__size` (words), `__source_size`, `__target` (of its source) and `__times` (0 to 3).

    A null source is a source, ordered last. Null or empty texts have size 0; in a source of size 0 all
    are taken once. Texts are read whole; an empty table gives an empty one; columns of names that begin with two underscores, as the new ones do, must not
    be among the kept ones unless they are the caller's own position. Identical rows are interchangeable. Results depend on the rows alone, not on their
    order or partitions. Sources are counted on the driver: one row for each.
    """
    spark, names = docs.sparkSession, kept or docs.columns
    held = bounded_batches(docs).withColumns({"__size": word_count(text), "__tie": F.xxhash64(key, source, text)})
    # the flights carry what is kept, so a text that is not kept is read once and never moved
    held = cut(held.select(*names, F.col(source).alias("__of"), "__size", "__tie"), "sized")
    stats = held.groupBy("__of").agg(F.sum("__size").alias("size"), F.count("*").alias("docs")).collect()
    goal = targets([(r[0], r["size"]) for r in stats])
    rows = [(r[0], i, r["size"], goal[r[0]], goal[r[0]] / r["size"] if r["size"] else 1.0, r["docs"]) for i, r in enumerate(sorted(stats, key=lambda r: (r[0] is None, r[0] or "")))]
    table = local_table(spark, {"__name": pa.string(), "__source": pa.int32(), "__source_size": pa.int64(), "__target": pa.float64(), "__ratio": pa.float64(), "__docs": pa.int64()}, rows)
    joined = held.join(F.broadcast(table), F.col("__of").eqNullSafe(F.col("__name"))).drop("__name", "__of")
    whole = F.floor("__ratio").cast("int")
    most = max([r[5] for r in rows], default=0)
    block = F.pmod(F.xxhash64("__tie", F.lit(0)), F.greatest(F.lit(1), F.ceil(F.col("__docs") / block_rows))).cast("long")
    state = joined.withColumns({"__whole": whole, "__p": F.col("__ratio") - whole, "__block": block}).drop("__ratio", "__docs")
    blocks_left = max(1, -(-most // block_rows))
    done, level = [], 0
    while True:
        last = blocks_left == 1
        state = cut(_settled(state, last, seed + level), "flight")
        if last:
            done.append(state)
            break
        done.append(state.where("__p <= 0 OR __p >= 1"))
        # at most two open documents a block: so many blocks fold into one
        fold = block_rows // 2
        state = state.where("__p > 0 AND __p < 1").withColumn("__block", F.floor(F.col("__block") / fold).cast("long"))
        blocks_left, level = -(-blocks_left // fold), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*names, "__size", "__source_size", "__target", (F.col("__whole") + F.round("__p").cast("int")).alias("__times"))
