"""Quality rules: fixed counts, and divergence from what a language's texts usually look like.

Each document's shares of character classes and of its language's commonest words are compared
with those of the whole language by the Jensen-Shannon distance. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import stage

#: White space between words.
SPACE = r"[ \t\n\x0B\f\r]"
#: Classes of characters in the order they are taken out of a text; what is left is the last class.
CLASSES = ("[a-z]+", SPACE + "+", "[A-Z]+", "[0-9]+", r"[.,;:!?'\"()-]+", r"[\x00-\x7F]+")
#: Words a language's reference has.
COMMON = 16
#: So many repeated windows are looked up one by one.
FEW = 64
#: Texts shorter than this (words, characters) are not judged by divergence.
LEAST_WORDS, LEAST_CHARS = 50, 200
#: Largest distances; what chance alone makes of a distance in n draws is added to them.
FARTHEST_CLASSES, FARTHEST_WORDS = 0.3, 0.32


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used there."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def repeated_words(words: Column) -> Column:
    """Words lying in windows of three words that occur twice or more, the first time included."""

    def windows(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 3)
        return F.when(F.size(w) >= 3, F.transform(places, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))

    def covered(p: Column) -> Column:
        each = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(each, F.lit(0), lambda total, x: total + x)

    def equal_neighbours(s: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            same = [F.coalesce(F.get(s, i + step)["h"] == x["h"], F.lit(False)) for step in (-1, 1)]
            return same[0] | same[1]

        return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

    def places(h: Column, several: Column) -> Column:
        """Where the windows are that occur again: by looking each up if these are few, else by sorting all."""
        looked_up = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(several, x), i)), lambda i: i.isNotNull())
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(several) <= FEW, looked_up).otherwise(_let(pairs, equal_neighbours))

    def count(h: Column) -> Column:
        # Numbers alone are sorted many times faster than pairs.
        again = _let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.get(s, i + 1) == x)))
        some = F.size(F.array_distinct(h)) < F.size(h)
        return F.when(some, _let(_let(again, lambda several: places(h, several)), covered)).otherwise(F.lit(0))

    return F.coalesce(_let(_let(words, windows), lambda h: F.when(h.isNotNull(), count(h))), F.lit(0)).cast("bigint")


def class_counts(text: Column) -> Column:
    """How many characters of each class a text has."""

    def left(rest: Column, patterns: tuple[str, ...], lengths: tuple[Column, ...]) -> Column:
        """The lengths of what is left when one class after the other is taken out."""
        lengths = (*lengths, F.length(rest))
        if not patterns:
            return F.array(*lengths, F.lit(0))
        return _let(F.regexp_replace(rest, patterns[0], ""), lambda less: left(less, patterns[1:], lengths))

    lengths = _let(F.coalesce(text, F.lit("")), lambda whole: left(whole, CLASSES, ()))
    places = range(len(CLASSES) + 1)
    return _let(lengths, lambda n: F.array(*[(n[i] - n[i + 1]).cast("bigint") for i in places]))


def common_counts(text: Column, common: Column) -> Column:
    """How many other words a text has, and how often each of the ``common`` words (in lower case) occurs."""

    def counted(words: Column, places: Column) -> Column:
        times = [F.size(places) - F.size(F.array_remove(places, F.lit(k).cast("bigint"))) for k in range(1, COMMON + 1)]
        return F.array(*[x.cast("bigint") for x in (F.size(words) - F.size(places), *times)])

    def found(words: Column, longest: Column) -> Column:
        short = F.filter(words, lambda w: F.octet_length(w) <= longest)
        places = F.transform(short, lambda w: F.array_position(common, w))
        return _let(F.array_remove(places, F.lit(0).cast("bigint")), lambda p: counted(words, p))

    size = F.coalesce(F.array_max(F.transform(common, lambda w: F.octet_length(w))), F.lit(0))
    return _let(size, lambda longest: _let(word_list(F.lower(text)), lambda words: found(words, longest)))


def common_words(docs: DataFrame) -> DataFrame:
    """``ref, common``: the commonest words (in lower case) of each language, those of the same count in their order.

    All words are counted. Each task keeps only its commonest ones before a language's meet.
    """
    words = docs.select("ref", F.explode(word_list(F.col("text"))).alias("w")).select("ref", F.lower("w").alias("w"))
    place = F.row_number().over(Window.partitionBy("ref").orderBy(F.desc("count"), "w"))
    top = words.groupBy("ref", "w").count().withColumn("place", place).filter(F.col("place") <= COMMON)
    top = top.groupBy("ref").agg(F.sort_array(F.collect_list(F.struct("place", "w"))).alias("top"))
    return top.select("ref", F.transform("top", lambda x: x["w"]).alias("common"))


def features(docs: DataFrame) -> DataFrame:
    """The counts behind the rules, one row per row of ``docs``, written to the shared folder."""
    text = F.col("text").cast("string").alias("text")
    docs = docs.select("doc_id", text, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("ref"))
    # One row for each language.
    reference = stage(common_words(docs), "common").withColumnRenamed("ref", "r")
    rows = docs.join(reference, F.col("ref") == F.col("r"), "left").drop("r")
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t\x0B\f\r]"))
    lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def by_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        )

    counted = rows.select(
        "doc_id",
        "ref",
        _let(word_list(F.col("text")), by_words).alias("w"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        lines.cast("bigint").alias("n_dup_lines"),
        class_counts(F.col("text")).alias("classes"),
        common_counts(F.col("text"), F.coalesce("common", F.array().cast("array<string>"))).alias("commons"),
    )
    return stage(counted.select("doc_id", "ref", "w.*", "n_symbols", "n_dup_lines", "classes", "commons"), "features")


def shares(counts: Column) -> Column:
    """Counts as shares of their sum; all zero if there are none."""
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda t, x: t + x)
    return _let(total, lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (logarithms to base 2: from 0 to 1) of two lists of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda t, x: t + x), F.lit(0.0)))


def references(rows: DataFrame) -> DataFrame:
    """``r, ref_classes, ref_commons``: the shares of each language, over all its documents."""
    sums = [F.sum(F.col("classes")[i]) for i in range(len(CLASSES) + 1)]
    commons = [F.sum(F.col("commons")[i]) for i in range(COMMON + 1)]
    totals = rows.groupBy("ref").agg(F.array(*sums).alias("a"), F.array(*commons).alias("b"))
    return totals.select(F.col("ref").alias("r"), shares(F.col("a")).alias("ref_classes"), shares(F.col("b")).alias("ref_commons"))


def quality(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text, lang``) its counts, distances and verdicts.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. ``kept``:
    not ``base_failed``, and both distances are within their limits or the text is too short to
    tell. Documents without ``lang`` are a language of their own. Null and empty texts have no words
    and are not kept. Repeated rows get the same result each, a null ``doc_id`` is kept, other
    columns are not looked at, and an empty table gives no rows.
    """
    rows = features(docs)
    known = stage(references(rows), "references")
    rows = rows.join(known, F.col("ref") == F.col("r"), "left")
    by_class = distance(shares(F.col("classes")), F.col("ref_classes"))
    by_word = distance(shares(F.col("commons")), F.col("ref_commons"))
    chars = F.aggregate("classes", F.lit(0).cast("bigint"), lambda t, x: t + x)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))

    def limit(base: float, kinds: int, draws: Column) -> Column:
        return base + F.sqrt(kinds / (5.5 * F.greatest(draws, F.lit(1))))

    near = (F.col("class_distance") <= limit(FARTHEST_CLASSES, len(CLASSES), F.col("chars"))) & (
        F.col("word_distance") <= limit(FARTHEST_WORDS, COMMON, F.col("n_words"))
    )
    short = (F.col("n_words") < LEAST_WORDS) | (F.col("chars") < LEAST_CHARS)
    rows = rows.withColumns(
        {"class_distance": by_class, "word_distance": by_word, "chars": chars, "base_failed": failed}
    )
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "word_distance", (~F.col("base_failed") & (short | near)).alias("kept"),
    )
