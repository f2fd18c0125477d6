"""Sinks: upserts, exact-set syncs, child replacement, ledgers and manifests, without a lakehouse format."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Rows of source replace those of equal key."""
    return target.join(source.select(*key), key, "left_anti").unionByName(source, allowMissingColumns=True)


def append_absent(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Rows of source whose key is not there are added; repeated keys of source are added once, whichever row is least."""
    fresh = source.join(target.select(*key), key, "left_anti")
    rest = [c for c in source.columns if c not in key]
    one = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__r")).select(*key, "__r.*") if rest else fresh.distinct()
    return target.unionByName(one, allowMissingColumns=True)


def merge_keep(target: DataFrame, source: DataFrame, key: str, kept: list[str]) -> DataFrame:
    """Upsert in which the `kept` array fields keep the old value where the new one is empty, and all others where it is null."""
    s = source.select(F.col(key), *(F.col(c).alias(f"__{c}") for c in source.columns if c != key), F.lit(True).alias("__in"))
    fields = [c for c in target.columns if c != key]
    pick = lambda c: F.when(F.coalesce(F.size(f"__{c}"), F.lit(0)) > 0, F.col(f"__{c}")).otherwise(F.col(c)) if c in kept else F.coalesce(f"__{c}", c)
    return target.join(s, key, "full").select(key, *(pick(c).alias(c) for c in fields))


def replace_children(children: DataFrame, new: DataFrame, parent: str, parents: DataFrame | None = None) -> DataFrame:
    """All children of the parents in `new` give way to the new ones, and those of `parents`, of which `new` may have none."""
    gone = new.select(parent) if parents is None else new.select(parent).union(parents.select(parent))
    return children.join(gone.distinct(), parent, "left_anti").unionByName(new)


def delete_then_upsert(target: DataFrame, removed: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Removed keys go, then rows of source replace those of equal key; a key that is both comes back."""
    return upsert(target.join(removed.select(*key), key, "left_anti"), source, key)


def sync_plan(current: DataFrame, wanted: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, action): insert, delete, update or keep."""
    a = current.select(key, F.struct(*fields).alias("__a"), F.lit(True).alias("__x"))
    b = wanted.select(key, F.struct(*fields).alias("__b"), F.lit(True).alias("__y"))
    action = F.when(F.col("__x").isNull(), "insert").when(F.col("__y").isNull(), "delete").when(F.col("__a").eqNullSafe(F.col("__b")), "keep").otherwise("update")
    return a.join(b, key, "full").select(key, action.alias("action"))


def add_missing_columns(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Additive schema evolution: columns that df lacks come as nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in schema.items() if c not in df.columns})


def row_hash(df: DataFrame) -> Column:
    """SHA-256 of a row's columns by name."""
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns))), {"ignoreNullFields": "false"}), 256)


def table_hash(df: DataFrame, buckets: int = 256) -> DataFrame:
    """(rows, hash) of a table, whatever its order: row hashes are sorted and hashed per leading byte, then the bytes' hashes."""
    h = df.select(row_hash(df).alias("h"))
    part = h.groupBy(F.substring("h", 1, 2).alias("b")).agg(F.count("*").alias("n"), F.sum(F.conv(F.substring("h", 3, 15), 16, 10).cast("decimal(38,0)")).alias("s"), F.expr("bit_xor(cast(conv(substring(h, 18, 15), 16, 10) as bigint))").alias("x"))
    rows = F.array_sort(F.collect_list(F.concat_ws(":", "b", "n", "s", "x")))
    return part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.sha2(F.array_join(rows, ","), 256).alias("hash"))


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(df: DataFrame, path: str, replace: bool = False) -> None:
    """Write beside the path, then rename: readers never see half a table. Without replace an existing path is an error and stays."""
    spark = df.sparkSession
    target, fs = _fs(spark, path)
    if fs.exists(target) and not replace:
        raise FileExistsError(path)
    staged, _ = _fs(spark, f"{path}.staged-{uuid.uuid4().hex}")
    df.write.parquet(staged.toString())
    old, _ = _fs(spark, f"{path}.old-{uuid.uuid4().hex}")
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(staged, target):
        raise OSError(f"cannot publish {path}")
    if fs.exists(old):
        fs.delete(old, True)


def publish_if_clean(df: DataFrame, checks: DataFrame, path: str, dry_run: bool = False) -> bool:
    """Publish only if no row of checks has status FAIL."""
    if not checks.where("status = 'FAIL'").isEmpty():
        return False
    if not dry_run:
        publish(df, path, replace=True)
    return True


def resumable(df: DataFrame, path: str, name: str, inputs_hash: str) -> DataFrame:
    """The stage's table from an earlier run on the same inputs, else computed and kept under its hash."""
    spark = df.sparkSession
    at = f"{path}/{name}-{inputs_hash}"
    mark, fs = _fs(spark, f"{at}/_SUCCESS")
    if not fs.exists(mark):
        df.write.mode("overwrite").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def append_unseen(df: DataFrame, path: str, schema: str, key: str) -> None:
    """Append rows as JSON lines whose key is not there yet. What a failed run left half written is not read: its files appear when its job commits."""
    spark = df.sparkSession
    at, fs = _fs(spark, path)
    if fs.exists(at):
        df = df.join(spark.read.schema(schema).json(path).select(key), key, "left_anti")
    df.write.mode("append").json(path)


def bulk_csv(df: DataFrame, path: str) -> None:
    """CSV for a bulk loader: a header, quotes doubled, an empty field for null."""
    df.write.option("header", True).option("escape", '"').csv(path)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, such as a manifest, from the driver; an existing one is an error."""
    at, fs = _fs(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def seal(df: DataFrame, path: str) -> str:
    """Write a table to a path that can be written once, with its hash beside it; the hash."""
    spark = df.sparkSession
    publish(df, f"{path}/data")
    row = table_hash(spark.read.parquet(f"{path}/data")).first()
    write_bytes(spark, f"{path}/SHA256", f"{row['rows']} {row['hash']}".encode())
    return f"{row['rows']} {row['hash']}"


def sealed(spark: SparkSession, path: str) -> str:
    """The hash of a sealed table as it is now; an error if it is not the one that was written with it."""
    row = table_hash(spark.read.parquet(f"{path}/data")).first()
    now, then = f"{row['rows']} {row['hash']}", spark.read.text(f"{path}/SHA256").first()["value"]
    if now != then:
        raise ValueError(f"{path} has changed")
    return now
