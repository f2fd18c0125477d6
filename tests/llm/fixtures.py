"""A small table of documents with nulls, empty and long texts, ties, copies and clashing names, and plain versions to compare with."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, letters="etaoinshr"):
    r = random.Random(seed)
    return [("".join(r.choice(letters) for _ in range(r.randint(2, 7)))) for _ in range(n)]


def rows():
    long_a, passage = words(400, 1), words(60, 2)
    out = [(0, None, "en", None), (1, "", "en", "a"), (2, " \t\n", None, "b"), (3, "###  123", "de", "a"), (4, "é", "fr", "c")]
    out += [(5 + i, " ".join(long_a), "en", "a") for i in range(3)]  # exact copies
    near = list(long_a)
    near[200] = "changed"
    out += [(8, " ".join(near), "en", "b"), (9, " ".join(words(150, 3)) + " " + " ".join(passage) + " " + " ".join(words(150, 4)), "de", "b")]
    out += [(10, " ".join(passage) + "\n" + " ".join(words(20, 5)), "de", "c"), (11, "ß" * 900, "de", None), (12, "ab" * 700, "fr", "c")]
    out += [(13, " ".join(words(3000, 6)), "en", "a"), (14, "Aa aA x  y", "fr", "b"), (14, "Aa aA x  y", "fr", "b")]
    out += [(15 + i, " ".join(words(40 + i, 50 + i, "aeiou" if i % 2 else "bcdfg")), "es" if i % 2 else "en", f"s{i % 3}") for i in range(60)]
    out += [(-7, "x y", "en", "a"), (2**40, " ".join(passage[:34]), "en", "a"), (2**40 + 1, " ".join(passage[:36]), "en", "a")]
    return [(*r, len(r[1] or "")) for r in out]


def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


def saved(spark, folder, more=()):
    """Folder with documents.parquet (and a column more), as the queries read it."""
    d = docs(spark)
    for name in more:
        from pyspark.sql import functions as F

        d = d.withColumn(name, F.lit("clash"))
    d.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)
