"""Work queues, memo keys and versions as tables, and the same as incremental streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def claim_next(queue: DataFrame, n: int, id_col: str = "id", status: str = "status", attempts: str = "attempts") -> DataFrame:
    """The queue after claiming the n oldest pending tasks: running, one more attempt."""
    picked = F.broadcast(queue.where(F.col(status) == "pending").orderBy(id_col).limit(n).select(id_col, F.lit(True).alias("__p")))  # n rows
    taken = F.col("__p").isNotNull()
    out = queue.join(picked, id_col, "left")
    return out.withColumns({status: F.when(taken, "running").otherwise(F.col(status)), attempts: F.col(attempts) + taken.cast("int")}).drop("__p")


def reset_stale(queue: DataFrame, cutoff: Column, claimed_at: str = "claimed_at", status: str = "status") -> DataFrame:
    """Running tasks that were claimed before the cutoff are pending again."""
    return queue.withColumn(status, F.when((F.col(status) == "running") & (F.col(claimed_at) < cutoff), "pending").otherwise(F.col(status)))


def unfinished(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose keys (a content hash among them) are not done."""
    return work.join(done.select(*keys), keys, "left_anti")


def to_recover(ledger: DataFrame, recovered: DataFrame, key: str, status: str = "status") -> DataFrame:
    return ledger.where(F.col(status) == "failed").join(recovered.select(key), key, "left_anti")


def last_good(versions: DataFrame, key: str, version: str, quality: str) -> DataFrame:
    """The version of each key with the best quality, the latest of equals."""
    rest = [c for c in versions.columns if c != key]
    return versions.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(quality, version)).alias("__r")).select(key, "__r.*")


def changed_only(base: DataFrame, now: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows of `now` that are new or differ from base in a field."""
    b = base.select(key, F.struct(*fields).alias("__b"), F.lit(True).alias("__in"))
    return now.join(b, key, "left").where(F.col("__in").isNull() | ~F.struct(*fields).eqNullSafe(F.col("__b"))).drop("__b", "__in")


def hash_stream(stream: DataFrame, key: str, text: str, path: str, checkpoint: str):
    """Incremental hash cache: what has arrived is hashed once and appended; a rerun goes on where the last one stopped."""
    rows = stream.select(key, F.sha2(F.col(text), 256).alias("hash"))
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, kind: str, width: str, late: str) -> DataFrame:
    """Events per kind and tumbling window; later than `late` is dropped by the watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), kind).agg(F.count("*").alias("n"))
