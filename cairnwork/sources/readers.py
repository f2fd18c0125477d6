"""Scans: source tables made uniform, JSON of any root, JSON lines with last-row-wins, checked snapshots, web pages."""

from __future__ import annotations

import gzip
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform(sources: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Per-source tables with their own column expressions, as one table with a `source` column."""
    parts = [df.select(F.lit(name).alias("source"), *(c.alias(k) for k, c in fields.items())) for name, (df, fields) in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def json_rows(spark: SparkSession, path: str, schema: str, roots: tuple[str, ...] = ("clusters", "buildings")) -> DataFrame:
    """Rows of whole-document JSON whose root is a list, or an object with one of the named lists.

    A document is one string here, so it must fit a task; larger ones belong in JSON lines.
    """
    text = spark.read.text(path, wholetext=True).select("value")
    listed = [F.from_json(F.get_json_object("value", f"$.{r}"), f"array<struct<{schema}>>") for r in roots]
    own = F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{schema}>>"))
    return text.select(F.explode(F.coalesce(own, *listed)).alias("r")).select("r.*")


def last_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """JSON lines; bad lines are skipped and of the lines of one key the last counts. Order is that of (file, place in it)."""
    from pyspark.sql import types as T

    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__f"), F.monotonically_increasing_id().alias("__n"))
    rows = raw.select(F.from_json("value", T.StructType.fromDDL(schema), {"mode": "PERMISSIVE"}).alias("r"), "__f", "__n").where(F.col(f"r.{key}").isNotNull())
    return rows.groupBy(F.col(f"r.{key}").alias("__k")).agg(F.max_by("r", F.struct("__f", "__n")).alias("r")).select("r.*")


def checked_files(spark: SparkSession, path: str, expected: dict[str, str]) -> DataFrame:
    """(name, sha256, ok) of files against their pinned SHA-256."""
    got = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))
    want = spark.createDataFrame(list(expected.items()), "name string, want string")
    return want.join(got, "name", "left").select("name", "sha256", F.coalesce(F.col("sha256") == F.col("want"), F.lit(False)).alias("ok"))


def csv_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV as sinks.bulk_csv writes it: a header, and an empty field for null."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)


def gzip_snapshots(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(name, body, sha256, ok) of gzip files against the hashes (want) of what they hold; a file that cannot be unpacked has a null body and is not ok.

    A snapshot is one row, so it must fit a task, as a web page does.
    """

    @F.pandas_udf("binary")
    def unpacked(s: pd.Series) -> pd.Series:
        def one(x: bytes) -> bytes | None:
            try:
                return gzip.decompress(x)
            except (OSError, EOFError, zlib.error):
                return None

        return s.map(one)

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), unpacked("content").alias("body"))
    got = manifest.join(files, "name", "left").withColumn("sha256", F.sha2("body", 256))
    return got.select("name", "body", "sha256", F.coalesce(F.col("sha256") == F.col("want"), F.lit(False)).alias("ok"))


def sitemap_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url, lastmod) of sitemap XML."""
    each = spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<(?:url|sitemap)>(.*?)</(?:url|sitemap)>"), 1)).alias("x"))
    return each.select(F.trim(F.regexp_extract("x", r"<loc>\s*([^<]+?)\s*</loc>", 1)).alias("url"), F.nullif(F.regexp_extract("x", r"<lastmod>\s*([^<]+?)\s*</lastmod>", 1), F.lit("")).alias("lastmod"))


# --- web pages ---------------------------------------------------------------------------------


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?s)<title[^>]*>(.*?)</title>", 1)


def page_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), 1)


def page_language(html: Column) -> Column:
    return F.regexp_extract(html, r'<html[^>]*\slang="([^"]*)"', 1)


def page_text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags; entities of the five XML names are read."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        bare = F.replace(bare, F.lit(f"&{name};"), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def embedded_json(html: Column, name: str, wanted: list[str] | None = None) -> Column:
    """The JSON object that a script assigns to a name or holds under an id: of several the one with most of the wanted keys, then the longest. Null without any."""
    found = F.regexp_extract_all(html, F.lit(rf'(?s)(?:{name}\s*=\s*|id="{name}"[^>]*>)(\{{.*?\}})\s*(?:;|</script>)'), 1)
    keys = lambda j: sum((F.coalesce(F.get_json_object(j, f"$.{k}").isNotNull().cast("int"), F.lit(0)) for k in wanted or []), F.lit(0))
    scored = F.transform(found, lambda j: F.struct((-keys(j)).alias("k"), (-F.length(j)).alias("n"), j.alias("j")))
    return F.get(F.array_sort(scored), F.lit(0))["j"]


def page_record(html: Column) -> Column:
    """struct(title, lang, heading, paragraphs, items, links, has_article) of a page."""
    count = lambda p: F.regexp_count(html, F.lit(p)).cast("long")
    part = lambda tag: F.regexp_extract(html, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)
    return F.struct(
        page_title(html).alias("title"), page_language(html).alias("lang"), part("h1").alias("heading"), count("<p[^a-z]").alias("paragraphs"), count("<li>").alias("items"),
        F.size(page_links(html)).alias("links"), (part("article") != "").alias("has_article"),
    )
