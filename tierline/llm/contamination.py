"""Benchmark passages in documents, found with a positional inverted index. DataFrame functions only.

The index holds, for every word of the documents that the benchmark uses, its documents and
positions. Each benchmark window is looked up from its rarest word: that word's list, moved by its
place in the window, gives possible starts; the list of the next rarest word, moved likewise, must
meet them, and then those of all its other words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import fresh, stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Tables about the benchmark with at most so many rows (some 50 MB) are broadcast, larger ones shuffled.
BROADCAST_ROWS = 500_000


def word_list(text: Column) -> Column:
    """The words of a text in order, not yet in lower case; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def lower_word(word: Column) -> Column:
    """A-Z in lower case and everything else as it is (``lower`` alone is quicker, but changes É)."""
    ascii_only = F.length(word) == F.octet_length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def _small(df: DataFrame) -> DataFrame:
    """A staged table about the benchmark, to be broadcast if it was counted to be small enough."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def benchmark_windows(benchmark: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Windows of ``size`` consecutive words (``win, len, terms``) and the items that have them (``win, item_id``).

    An item with fewer words is one window, one without words none.
    """
    words = F.transform(word_list(F.col("text").cast("string")), lower_word)
    items = benchmark.select("item_id", words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    spans = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, size))).alias("terms"))
    keyed = stage(spans.select(F.md5(F.array_join("terms", " ")).alias("win"), "item_id", "terms"), "windows")
    windows = stage(keyed.dropDuplicates(["win"]).select("win", F.size("terms").alias("len"), "terms"), "windows")
    return windows, stage(keyed.select("win", "item_id").distinct(), "items")


def text_key(text: Column, doc_id: Column) -> Column:
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def vocabulary(windows: DataFrame) -> DataFrame:
    """``v, term``: the words of all windows, numbered. One task does so; it sees only the benchmark's words."""
    words = windows.select(F.explode("terms").alias("v")).distinct()
    return stage(words.withColumn("term", F.row_number().over(Window.orderBy("v"))), "terms")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``doc_id, k, term, pos`` of all words of ``docs`` that are among ``terms``.

    ``k`` stands for a document: rows with the same ``doc_id`` but different texts are different.
    """
    text = F.col("text").cast("string")
    tokens = docs.select("doc_id", text_key(text, F.col("doc_id")).alias("k"), F.posexplode(word_list(text)).alias("pos", "w"))
    found = tokens.join(_small(terms), lower_word(F.col("w")) == F.col("v"))
    return stage(found.select("doc_id", "k", "term", "pos"), "postings")


def _spot(block: Column) -> Column:
    """A term and a place (or block of places) in one number."""
    return F.shiftleft(F.col("term").cast("bigint"), 32) + block.cast("bigint")


def _meet(starts: DataFrame, entries: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """Those ``starts`` where each of the window's ``entries`` (``win, off, term, wanted``) is in place.

    In place means at most ``slop`` words away from it; ``exact`` turns false where one is not at it.
    """
    wide = 2 * slop + 1
    need = starts.join(entries, "win").withColumn("at", F.col("start") + F.col("off"))
    blocks = F.sequence(F.floor((F.col("at") - slop) / wide), F.floor((F.col("at") + slop) / wide))
    need = need.withColumn("block", F.explode(F.filter(blocks, lambda b: b >= 0)) if slop else F.col("at"))
    need = need.withColumn("spot", _spot(F.col("block"))).drop("term", "block")
    # Two numbers are all that is shuffled of a posting, unless its exact place matters.
    have = postings.select(F.col("k").alias("pk"), _spot(F.floor(F.col("pos") / wide)).alias("ps"), *(["pos"] if slop else []))
    met = need.join(have, (F.col("k") == F.col("pk")) & (F.col("spot") == F.col("ps")))
    if slop:
        met = met.filter(F.abs(F.col("pos") - F.col("at")) <= slop)
    else:
        met = met.withColumn("pos", F.col("at"))
    counted = met.groupBy("doc_id", "k", "start", "win", "len", "exact", "wanted").agg(
        F.count_distinct("off").alias("near"), F.count_distinct(F.when(F.col("pos") == F.col("at"), F.col("off"))).alias("same")
    )
    kept = counted.filter("near = wanted")
    return kept.select("doc_id", "k", "start", "win", "len", (F.col("exact") & (F.col("same") == F.col("wanted"))).alias("exact"))


def matches(postings: DataFrame, windows: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """Occurrences ``doc_id, k, start, win, len, exact`` of the windows in the indexed documents.

    With ``slop`` 0 exact phrases only; otherwise also places where every word of the window is at
    most so many words from its place (``exact`` false there), counted from the rarest word's.
    """
    lists = postings.groupBy("term").agg(F.count("*").alias("freq"))
    entries = windows.select("win", "len", F.posexplode("terms").alias("off", "v"))
    entries = entries.join(terms, "v").drop("v").join(lists, "term")
    order = Window.partitionBy("win").orderBy("freq", "term", "off")  # a window has few words
    whole = Window.partitionBy("win")
    entries = entries.withColumn("rank", F.row_number().over(order)).withColumn("found", F.count("*").over(whole))
    entries = stage(entries.filter("found = len").drop("found", "freq"), "entries")

    def ranked(condition: str, wanted: Column) -> DataFrame:
        return _small(stage(entries.filter(condition).select("win", "off", "term", wanted.alias("wanted")), "entries"))

    anchors = _small(stage(entries.filter("rank = 1").select("win", "len", "off", "term"), "entries"))
    starts = postings.join(anchors, "term").withColumn("start", F.col("pos") - F.col("off")).filter("start >= 0")
    starts = starts.select("doc_id", "k", "start", "win", "len", F.lit(True).alias("exact")).distinct()
    starts = stage(starts, "starts")
    second = ranked("rank = 2", F.lit(1))
    names = second.select(F.col("term").alias("t")).distinct()
    rare = postings.join(_small(stage(names, "terms")), F.col("term") == F.col("t"), "left_semi")
    two = stage(_meet(starts.filter("len > 1"), second, rare, slop), "starts")
    others = ranked("rank > 2", F.col("len") - 2)
    full = _meet(two.filter("len > 2"), others, postings, slop)
    return stage(full.unionByName(two.filter("len = 2")).unionByName(starts.filter("len = 1")), "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, slop: int = 0) -> DataFrame:
    """Per row of ``docs``: ``doc_id, k, n_words, n_hit, n_near, n_items, items, contaminated``.

    A word is hit if it lies inside an exact occurrence of a window; ``items`` are the sorted ids of
    the items with such windows, as text. ``n_near`` counts occurrences that are not exact (none
    unless ``slop`` is given). A null or empty text has no words. Repeated rows get the same result
    each; a null ``doc_id`` is kept. Items without ``item_id`` hit words, but are not counted. Either
    table can be empty. Columns other than ``doc_id, text`` and ``item_id, text`` are not looked at.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    windows, items = benchmark_windows(benchmark, size)
    terms = vocabulary(windows)
    found = matches(index(docs, terms), windows, terms, slop)
    exact = found.filter("exact")
    spots = exact.select("doc_id", "k", F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos")).distinct()
    hits = spots.groupBy("doc_id", "k").agg(F.count("*").alias("n_hit"))
    named = exact.select("doc_id", "k", "win").distinct().join(_small(items), "win")
    named = named.select("doc_id", "k", F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy("doc_id", "k").agg(F.sort_array(F.collect_list("item")).alias("items"))
    near = found.filter("not exact").groupBy("doc_id", "k").agg(F.count("*").alias("n_near"))
    rows = docs.select("doc_id", text_key(F.col("text"), F.col("doc_id")).alias("k"), F.size(word_list(F.col("text"))).cast("bigint").alias("n_words"))
    for extra in (hits, named, near):
        extra = extra.withColumnsRenamed({"doc_id": "d", "k": "dk"})
        on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("dk"))
        rows = rows.join(extra, on, "left").drop("d", "dk")
    none = F.array().cast("array<string>")
    return rows.select(
        "doc_id",
        "k",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no exact occurrence of a window."""
    windows, _ = benchmark_windows(benchmark, size)
    body = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    terms = vocabulary(windows)
    bad = matches(index(body, terms), windows, terms).select(F.col("doc_id").alias("d"), F.col("k").alias("dk")).distinct()
    key = fresh("k", docs)
    rows = docs.withColumn(key, text_key(F.col("text").cast("string"), F.col("doc_id")))
    bad = bad.withColumnsRenamed({"d": fresh("d", rows), "dk": fresh("dk", rows)})
    ids, keys = bad.columns
    on = F.col("doc_id").eqNullSafe(F.col(ids)) & (F.col(key) == F.col(keys))
    return rows.join(bad, on, "left_anti").drop(key)
