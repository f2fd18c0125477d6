"""Sharding by a Feistel permutation with cycle walking over global row numbers.

A row's number in the total order of its keys goes through a keyed permutation of 0..n-1; the
permuted number p gives shard p mod S and slot p div S. So the shuffle is reproducible, shard sizes
differ by one row at most, slots have no gaps, and where row k lies follows from (k, n, seed, S)
alone. No row is compared with others after it has its number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnwork.plans.storage import cut, local_table

ROUNDS = 6


def _round_keys(seed: int) -> list[int]:
    x, keys = seed & (2**64 - 1), []
    for _ in range(ROUNDS):
        x = (x + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        keys.append(z ^ (z >> 31))
    return keys


def _stir(half: np.ndarray, key: int) -> np.ndarray:
    z = (half + np.uint64(key)) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(29)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(32))


def _network(x: np.ndarray, bits: int, keys: list[int], back: bool) -> np.ndarray:
    """One pass over a domain of 2^bits. Rounds alternate between the high and the low half, which may differ by a bit."""
    low = bits // 2
    shift, low_mask, high_mask = np.uint64(low), np.uint64((1 << low) - 1), np.uint64((1 << (bits - low)) - 1)
    hi, lo = x >> shift, x & low_mask
    for i, key in reversed(list(enumerate(keys))) if back else enumerate(keys):
        if i % 2 == 0:
            hi = hi ^ (_stir(lo, key) & high_mask)
        else:
            lo = lo ^ (_stir(hi, key) & low_mask)
    return (hi << shift) | lo


def permute(numbers: np.ndarray, n: int, seed: int = 0, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (back: its inverse), for an array of numbers below n."""
    out = np.asarray(numbers, np.uint64).copy()
    if n < 2:
        return out.astype(np.int64)
    bits, keys = max(2, (n - 1).bit_length()), _round_keys(seed)
    out = _network(out, bits, keys, back)
    while len(walking := np.flatnonzero(out >= n)):
        out[walking] = _network(out[walking], bits, keys, back)
    return out.astype(np.int64)


def locate(number: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """(shard, slot) of one global row number."""
    p = int(permute(np.array([number]), n, seed)[0])
    return p % shards, p // shards


def number_rows(df: DataFrame, keys: list[Column], name: str) -> tuple[DataFrame, int]:
    """df with a global row number, in the order of keys, and the number of rows.

    Ranges of the keys go to partitions, places are counted inside each, and one count per partition
    (not per row) meets on the driver. Rows with equal keys take numbers in any order among themselves,
    so keys should tell apart all rows that are not identical.
    """
    spark = df.sparkSession
    named = {f"__key{i}": k for i, k in enumerate(keys)}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.withColumns(named).repartitionByRange(parts, *named).sortWithinPartitions(*named)
    place = F.monotonically_increasing_id()
    placed = cut(ordered.drop(*named).withColumns({"__part": F.shiftright(place, 33).cast("int"), "__place": place.bitwiseAND((1 << 33) - 1)}), "placed")
    counts = sorted(placed.groupBy("__part").agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for row in counts:
        before.append((row["__part"], total))
        total += row["n"]
    starts = local_table(spark, {"__part": pa.int32(), "__start": pa.int64()}, before)
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__place")).drop("__part", "__place", "__start"), total


def assign_shards(df: DataFrame, keys: list[Column], shards: int, seed: int = 0) -> DataFrame:
    """df with `shard` int and `slot` long (its own columns of these names are replaced).

    Law `rows`: shard sizes differ by one at most. Null keys come first and count as rows like any
    other; repeated rows each have their own slot; an empty table stays empty.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    numbered, n = number_rows(df, keys, "__number")

    @F.pandas_udf(T.LongType())
    def permuted(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    moved = numbered.withColumn("__moved", permuted("__number"))
    return moved.select(*kept, F.pmod("__moved", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("__moved") / shards).cast("long").alias("slot"))
