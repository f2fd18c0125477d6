"""From raw documents to shuffled shards, each stage one operator over what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnwork.llm import decontam, langid, mixing, sharding, simhash
from cairnwork.llm.positions import PLACE, attach, positioned
from cairnwork.plans.storage import cut

SHARDS = 40

#: The stages are iterative and fitted; SQL cannot express them.
ORACLE_SQL = None


# Every stage reads whole texts of any length and judges repeated rows, rows that share a doc_id and rows without one each for itself, by their
# place in the stored documents; columns of other names go along. An empty table gives an empty one. Decisions come back to the
# documents by place, so no stage shuffles texts while what was decided is small enough to be broadcast.


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be named; null texts and texts without letters go."""
    judged = langid.predict(docs, langid.fit(docs.where(~langid.held_out())))
    return judged.where(F.col("lang_pred") != langid.UNKNOWN).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of least doc_id; of several such rows one. A row without doc_id stays only where no other does.

    Null and empty texts are one group. Ties between rows of one doc_id are settled by a hash of the row, between identical rows by place.
    """
    rows, doc_id = positioned(docs), F.col("doc_id").cast("long")
    own = F.struct(doc_id.isNull().alias("without"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"), F.xxhash64(*docs.columns).alias("row"), *PLACE)
    found = simhash.classes(rows.select(own.alias("__id"), "text"), key="__id")
    kept = found.where("__id = component_id").select("__id.__f", "__id.__r", F.lit(0).alias("value"))
    return attach(rows, kept, "__kept", 1).where("__kept IS NOT NULL").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window; null texts have none."""
    rows = positioned(docs)
    found = decontam.match(rows.select(F.struct(*PLACE).alias("__at"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="__at")
    hit = found.where("contaminated").select("__at.*", F.lit(0).alias("value"))
    return attach(rows, hit, "__hit", 1).where("__hit IS NULL").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, zero to three times; a null source is one, and its texts without words are taken as others are."""
    rows = positioned(docs)
    taken = mixing.mix(rows, PLACE).where("__times > 0").select(*PLACE, F.col("__times").alias("value"))
    times = attach(rows, taken, "__times", 1).where("__times IS NOT NULL")
    return times.withColumn("__copy", F.explode(F.expr("sequence(1, cast(__times as int))"))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in shuffled shards: the columns of documents, shard and slot. Columns of these names are replaced."""
    rows = positioned(docs)
    dealt = sharding.assign_shards(rows.select(*PLACE, "doc_id", F.xxhash64(*docs.columns).alias("__row")), [F.col("doc_id"), F.col("__row")], SHARDS)
    dealt = cut(dealt.select(*PLACE, (F.col("slot") * SHARDS + F.col("shard")).alias("value")), "dealt")
    placed, kept = attach(rows, dealt, "__number", 8), [c for c in docs.columns if c not in ("shard", "slot")]
    return placed.select(*kept, F.pmod("__number", F.lit(SHARDS)).cast("int").alias("shard"), F.floor(F.col("__number") / SHARDS).cast("long").alias("slot"))


STAGES = [("language ID", language), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontaminate), ("mixing sources", mix), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, "stage")
    return docs
