"""Joins, aggregates, windows, set operations and sampling that record curation needs, as DataFrame plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnwork.plans.storage import cut

# --- joins -------------------------------------------------------------------------------------


def block_pairs(df: DataFrame, id_col: str, block: list[str], condition: Column | None = None) -> DataFrame:
    """(a, b) with a < b of rows that share a block and meet the condition over columns a.* and b.*.

    Rows meet by an equi join on the block, never by a cross join; null blocks meet nothing.
    """
    a, b = df.alias("a"), df.alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in block]) & (F.col(f"a.{id_col}") < F.col(f"b.{id_col}"))
    return a.join(b, on if condition is None else on & condition)


def year_bucket_join(left: DataFrame, right: DataFrame, on: list[str], left_year: str, right_year: str, reach: int) -> DataFrame:
    """Equal keys and years at most reach apart, as an equi join: the left side is repeated per year it reaches."""
    spread = left.where(F.col(left_year).isNotNull()).withColumn("__year", F.explode(F.sequence(F.col(left_year) - reach, F.col(left_year) + reach)))
    return spread.join(right.withColumn("__year", F.col(right_year)), [*on, "__year"]).drop("__year")


def near_pairs(df: DataFrame, id_col: str, on: list[str], year: str, reach: int) -> DataFrame:
    """Rows a.* and b.* with equal keys and years at most reach apart, each pair of rows once, as an equi join: the earlier year's row (of one year, that
    of the lesser id) is repeated per year it reaches. What is joined is small beside the pairs, so it is dealt into many parts by count.
    """
    parts = max(60, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.where(F.col(year).isNotNull())
    a = rows.withColumn("__step", F.explode(F.array(*map(F.lit, range(reach + 1))))).withColumn("__at", F.col(year) + F.col("__step"))
    a, b = (x.repartition(parts, *on, "__at").alias(i) for x, i in ((a, "a"), (rows.withColumn("__at", F.col(year)), "b")))
    once = (F.col("a.__step") > 0) | (F.col(f"a.{id_col}") < F.col(f"b.{id_col}"))
    return a.join(b, reduce(lambda x, y: x & y, (F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*on, "__at"])) & once)


def near_years(left: DataFrame, right: DataFrame, on: list[str], left_year: str, right_year: str, reach: int) -> DataFrame:
    """Rows with equal keys and years at most reach apart, or without a year on either side.

    Known years meet by an equi join on the year, rows without one by the keys alone, in two branches that share no pair.
    """
    known = year_bucket_join(left, right.where(F.col(right_year).isNotNull()), on, left_year, right_year, reach)
    right_only = left.where(F.col(left_year).isNull()).join(right, on)
    left_only = left.where(F.col(left_year).isNotNull()).join(right.where(F.col(right_year).isNull()), on)
    return known.unionByName(right_only).unionByName(left_only)


def shared_token_pairs(left: DataFrame, right: DataFrame, on: list[str], left_id: str, right_id: str, token_col: str, least: int = 2) -> DataFrame:
    """(left_id, right_id) of rows with equal keys that share at least two tokens; a row appears once per pair.

    Rows meet on two tokens at once, so a frequent token alone brings nothing together. Names are short: a row has few pairs of tokens.
    """
    assert least == 2
    each = lambda df, i: df.select(i, *on, F.array_sort(F.array_distinct(token_col)).alias("__t")).select(i, *on, F.explode(F.flatten(F.transform("__t", lambda x, k: F.transform(F.slice("__t", k + 2, F.size("__t")), lambda y: F.struct(x.alias("x"), y.alias("y")))))).alias("__p"))
    return each(left, left_id).join(each(right, right_id), [*on, "__p"]).select(left_id, right_id).distinct()


def banded_pairs(df: DataFrame, id_col: str, limbs: list[str], bands: int, radius: int) -> DataFrame:
    """(a, b, d) with a < b of rows whose hashes differ in d <= radius bits; a hash stands in `limbs`, columns of 64-bit integers.

    Band k has the bits k, k + bands, ..., so rows nearer than `bands` agree in one band. Rows meet on each band; a pair counts only in the first
    band in which it agrees, which makes it once without another shuffle. radius must be below bands.
    """
    assert radius < bands
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [[signed(sum(1 << i for i in range(64) if (64 * limb + i) % bands == k)) for limb in range(len(limbs))] for k in range(bands)]
    part = lambda row, k: [F.col(f"{row}{c}").bitwiseAND(F.lit(m)) for c, m in zip(limbs, masks[k])]
    keys = F.array(*(F.struct(F.lit(k).alias("band"), F.xxhash64(*part("", k)).alias("key")) for k in range(bands)))
    posted = df.select(F.col(id_col).alias("id"), *limbs, F.explode(keys).alias("__k")).select("id", *limbs, "__k.*")
    a, b = posted.alias("a"), posted.alias("b")
    differ = [F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}")) for c in limbs]
    d = reduce(lambda x, y: x + y, (F.bit_count(x) for x in differ))
    first = F.lit(None).cast("int")
    for k in reversed(range(bands)):
        first = F.when(reduce(lambda x, y: x & y, (x.bitwiseAND(F.lit(m)) == 0 for x, m in zip(differ, masks[k]))), k).otherwise(first)
    on = (F.col("a.band") == F.col("b.band")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")) & (d <= radius) & (first == F.col("a.band"))
    return a.join(b, on).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), d.alias("d"))


def jaccard_pairs(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b, both, n, cosine) with a < b of rows: pairs of setjoin.equal_codes' members inside a root, and across each pair of roots."""
    m = members.select("id", "root")
    x, y = m.toDF("u", "a"), m.toDF("v", "b")
    across = roots.join(x, "a").join(y, "b").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "both", "n", "cosine")
    inside = members.select(F.col("id").alias("u"), "root", F.col("n").cast("long").alias("n")).join(m.toDF("v", "root"), "root").where("u < v").select(F.col("u").alias("a"), F.col("v").alias("b"), F.col("n").alias("both"), "n", F.lit(1.0).alias("cosine"))
    return across.union(inside)


def band_pairs(df: DataFrame, id_col: str, bands: Column) -> DataFrame:
    """(a, b, bands) of rows that share a band key, with how many they share."""
    each = df.select(id_col, F.explode(bands).alias("band"))
    a, b = each.alias("a"), each.alias("b")
    both = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col(f"a.{id_col}") < F.col(f"b.{id_col}")))
    return both.groupBy(F.col(f"a.{id_col}").alias("a"), F.col(f"b.{id_col}").alias("b")).agg(F.count("*").alias("bands"))


def overlay(base: DataFrame, side: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """base with the side's fields where it has them."""
    s = side.select(key, *(F.col(f).alias(f"__{f}") for f in fields))
    return base.join(s, key, "left").select(*(F.coalesce(f"__{c}", c).alias(c) if c in fields else c for c in base.columns))


def first_difference(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field): the first field in which two tables differ, `missing left` or `missing right` for rows of one side."""
    x, y = a.withColumn("__x", F.lit(1)).alias("x"), b.withColumn("__y", F.lit(1)).alias("y")
    out = F.lit(None).cast("string")
    for f in reversed(fields):
        out = F.when(~F.col(f"x.{f}").eqNullSafe(F.col(f"y.{f}")), f).otherwise(out)
    out = F.when(F.col("__x").isNull(), "missing left").when(F.col("__y").isNull(), "missing right").otherwise(out)
    return x.join(y, F.col(f"x.{key}") == F.col(f"y.{key}"), "full").select(F.coalesce(f"x.{key}", f"y.{key}").alias(key), out.alias("field")).where("field IS NOT NULL")


# --- aggregates --------------------------------------------------------------------------------


def null_census(df: DataFrame) -> DataFrame:
    """(field, nulls, blanks) of every column, in one pass."""
    kinds = dict(df.dtypes)
    aggs = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)] + [(F.count_if(F.trim(c) == "") if kinds[c] == "string" else F.lit(0).cast("long")).alias(f"b{i}") for i, c in enumerate(df.columns)]
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"n{i}").alias("nulls"), F.col(f"b{i}").alias("blanks")) for i, c in enumerate(df.columns)))
    return df.agg(*aggs).select(F.inline(rows))


def mode_by(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """The most frequent value of each group, the smaller of equals; nulls do not count."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*group).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def consensus(df: DataFrame, key: str, value: str) -> DataFrame:
    """Unanimous value, else a strict plurality, else null with a conflict."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.count("*").alias("kinds"), F.max("n").alias("most"), F.max_by(value, F.struct("n", value)).alias("v"), F.sort_array(F.collect_list("n"), asc=False).alias("ns"))
    tie = (F.col("kinds") > 1) & (F.get("ns", F.lit(1)) == F.col("most"))
    return best.select(key, F.when(~tie, F.col("v")).alias("value"), F.when(F.col("kinds") == 1, "unanimous").when(tie, "conflict").otherwise("plurality").alias("status"))


def stack_axes(df: DataFrame, id_col: str, axes: dict[str, Column]) -> DataFrame:
    """(id, axis, tag), distinct, of array columns."""
    rows = F.array(*(F.struct(F.lit(a).alias("axis"), c.alias("tags")) for a, c in axes.items()))
    return df.select(id_col, F.inline(rows)).select(id_col, "axis", F.explode("tags").alias("tag")).where("tag IS NOT NULL").distinct()


def mean_vectors(df: DataFrame, group: str, vector: str, scale: int = 1_000_000) -> DataFrame:
    """(group, n, mean): components are summed in fixed point, so the order of rows does not matter."""
    each = df.select(group, F.posexplode(vector).alias("i", "x"))
    sums = each.groupBy(group, "i").agg(F.sum(F.round(F.col("x").cast("double") * scale).cast("long")).alias("s"), F.count("*").alias("n"))
    mean = F.struct("i", (F.col("s") / F.col("n") / scale).alias("x"))
    return sums.groupBy(group).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(mean)), lambda e: e["x"]).alias("mean"))


def facets(claims: DataFrame, key: str, axis: str, value: str, confidence: str, source: str, direct: float = 0.85, support: float = 0.75) -> DataFrame:
    """Claims become facets: confirmed by one claim of high confidence, or by two sources of fair confidence."""
    best = claims.groupBy(key, axis, value).agg(F.max(confidence).alias("confidence"), F.count("*").alias("claims"), F.count_distinct(source).alias("sources"))
    status = F.when(F.col("confidence") >= direct, "confirmed").when((F.col("sources") >= 2) & (F.col("confidence") >= support), "confirmed").otherwise("candidate")
    return best.withColumn("status", status)


# --- windows -----------------------------------------------------------------------------------


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_n(df: DataFrame, keys: list[str], n: int, *order: Column, rank: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def positions(df: DataFrame, keys: list[str], *order: Column, name: str = "sort_order") -> DataFrame:
    """Gapless places from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """df with the sum of `value` over all rows before, in the order of a column without repeats.

    Rows are dealt into ranges and stored, a total per range (a row per partition) gives each its start, and a window runs inside a range only.
    """
    ranged = cut(df.repartitionByRange(order).withColumn("__p", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("__p").agg(F.sum(value).alias("__t"))
    ahead = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(totals.select("__p", F.coalesce(F.sum("__t").over(ahead), F.lit(0)).alias("__s")))  # a row for each range
    inside = Window.partitionBy("__p").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(starts, "__p").withColumn(name, F.col("__s") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("__p", "__s")


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with gapless numbers from 1 in the order of a column without repeats."""
    return running_total(df.withColumn("__one", F.lit(1).cast("long")), order, "__one", "__b").withColumn(name, F.col("__b") + 1).drop("__one", "__b")


# --- sets --------------------------------------------------------------------------------------


def key_parity(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, key) of keys that only one side has."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").select(F.lit("left").alias("side"), key).union(y.join(x, key, "left_anti").select(F.lit("right").alias("side"), key))


def schema_difference(a: DataFrame, b: DataFrame) -> list[tuple[str, str]]:
    """('+', '-' or '~', column) of the changes from a to b, by name."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return sorted([("-", c) for c in x if c not in y] + [("+", c) for c in y if c not in x] + [("~", c) for c in x if c in y and x[c] != y[c]])


# --- sampling ----------------------------------------------------------------------------------


def hash_sample(df: DataFrame, n: int, seed: str, *key: str) -> DataFrame:
    """The n rows of least SHA-256 of seed and key."""
    return df.withColumn("__h", F.sha2(F.concat_ws("|", F.lit(seed), *key), 256)).orderBy("__h", *key).limit(n).drop("__h")


def quotas(df: DataFrame, cell: list[str], n: int, at_least: int = 0) -> DataFrame:
    """(cell, size, quota): n dealt over cells in proportion, the rest to the largest remainders. One row per cell meets in one task."""
    sizes = df.groupBy(*cell).agg(F.count("*").alias("size"))
    total = Window.partitionBy()
    shared = sizes.withColumn("whole", (F.col("size") * n / F.sum("size").over(total))).withColumn("floor", F.floor("whole"))
    rest = F.lit(n) - F.sum("floor").over(total)
    rank = F.row_number().over(total.orderBy(F.desc(F.round(F.col("whole") - F.col("floor"), 9)), *cell))
    quota = F.col("floor") + F.when(rank <= rest, 1).otherwise(0)
    return shared.withColumn("quota", F.greatest(quota, F.lit(at_least)).cast("long")).select(*cell, "size", "quota")


def stratified(df: DataFrame, cell: list[str], n: int, seed: str, key: str) -> DataFrame:
    """Each cell's quota of rows, by the least SHA-256 of seed and key."""
    w = Window.partitionBy(*cell).orderBy(F.sha2(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")), 256), key)
    return df.withColumn("__n", F.row_number().over(w)).join(F.broadcast(quotas(df, cell, n)), cell).where("__n <= quota").drop("__n", "size", "quota")
