"""Small tables with the awkward cases every text operator must stand."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORDS = [f"{a}{b}{c}" for a in "kmptr" for b in "aeiou" for c in ("l", "nd", "s", "v")]


def prose(seed, n):
    """``n`` words of made-up prose, the same for the same seed."""
    state, out = seed * 7919 + 1, []
    for i in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


#: Names that the operators use inside.
CLASHING = ("k", "h", "margin", "gone", "removed", "term", "pos", "win", "start", "rep", "id", "key", "u", "v", "ref", "e", "d", "dk", "c1", "K")


def awkward(spark):
    """Null ids and texts, empty and very long texts, repeated rows, copies, and columns of any name."""
    long_text = "\n".join(prose(100 + i, 400) for i in range(60))
    rows = [
        (1, prose(1, 120)), (2, None), (3, ""), (4, " \t\n\x0b "), (5, prose(1, 120)), (5, prose(1, 120)),
        (6, prose(2, 60)), (None, prose(2, 60)), (None, None), (7, long_text), (8, long_text + " tail"), (9, "kal"),
        (10, "KAL"), (11, "é 中文 \x00 \U0001f600 <|endoftext|> don't"), (11, prose(3, 80)), (12, "!!! ... 123"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.withColumns({"lang": F.when(F.col("doc_id") % 2 == 0, "xx"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint")})
    return df.withColumns({c: F.lit(1) for c in CLASHING if c != "K"})


def empty(df):
    return df.filter("1 = 2")


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shuffled(df):
    """The same rows over several partitions, in another order."""
    return df.repartition(5, F.xxhash64("text"))
