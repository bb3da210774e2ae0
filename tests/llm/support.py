"""Small tables with the odd rows that every operator must take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, words int, _label string, sig int"
WORDS = ["alpha", "beta", "gamma", "delta", "river", "stone", "Müller", "é", "x1", "THE", "end."]


def prose(seed, n, words=None):
    draw = random.Random(seed)
    return " ".join(draw.choice(words or WORDS) for _ in range(n))


def table(spark, texts, first=1):
    """A documents table of texts, with further columns whose names clash with inner ones."""
    rows = [(first + i, t, "en", "s", len(t or ""), "k", 1, "l", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", " \t\n ", "one", "one two three four", prose(1, 400), prose(1, 400), "ÀÉ ß   　 x", prose(2, 30) + "\n" + prose(3, 20000)]


def odd(spark):
    """Null, empty, blank, short, repeated and very long texts; a null id; a repeated row."""
    df = table(spark, ODD)
    return df.unionByName(df.where("doc_id = 6")).unionByName(df.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))


def empty(spark):
    return table(spark, ["x"]).limit(0)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
