import os
import re
import zlib
from collections import Counter, defaultdict

import pytest
from text_cases import awkward, empty, prose, read, shuffled

from tierline.llm import variants

LOW = {i: i + 32 for i in range(65, 91)}


def plain_words(rows, thinned=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if thinned and h % thinned == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    """Whether one inserted, deleted or replaced letter sets two words apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def neighbours(words):
    """Near words by what deleting a letter leaves; ``one_edit`` has the last word."""
    groups = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            groups[w[:i] + w[i + 1 :]].add(w)
        groups[w].add(w)
    return {w: {x for i in range(len(w) + 1) for x in groups[w[:i] + w[i + 1 :]] if one_edit(w, x)} for w in words}


def plain(words, near=neighbours):
    near, rows = near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        rows[w] = best if best and words[best] >= 2 * n else None
    found = []
    for w, n in words.items():
        root = w
        while rows[root]:
            root = rows[root]
        found.append((w, rows[w], root, n, len(near[w]), words.get(rows[w])))
    return sorted(found)


def check(found, words, near=neighbours):
    assert sorted(map(tuple, found.collect())) == plain(words, near)


def test_words_of_documents_against_plain_version(spark):
    docs = shuffled(read(spark, "documents", "/root/testdata/sf0.01"))
    words = plain_words(docs.select("doc_id", "text").collect())
    assert len(words) > 5000 and any(not w.isascii() for w in words)
    found = variants.spelling_variants(docs, thinned=97).cache()
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    check(found, words)
    assert found.filter("root <> form").count() > 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(variants.spelling_variants(docs, thinned=97), plain_words(docs.select("doc_id", "text").collect()))
    check(variants.spelling_variants(docs), plain_words(docs.select("doc_id", "text").collect(), None))
    assert variants.spelling_variants(empty(docs)).collect() == []


def test_edits_ties_and_chains(spark):
    words = {
        "aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 30, "baaaaaaa": 30, "aabaa": 6, "abaaa": 6, "abcde": 100, "edcba": 3,
        "bacde": 3, "abcdé": 50, "ébcde": 50, "abcdefg": 4, "abcdeg": 9, "中文中文中": 3, "中文中文": 8,
    }
    check(variants.variants(spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)), words)
    chain = {"x" * (5 + i): 2 ** (i + 2) for i in range(40)}
    found = variants.variants(spark.createDataFrame(list(chain.items()), "word string, n bigint")).collect()
    assert {r["root"] for r in found} == {"x" * 44} and {r["n_near"] for r in found} == {1, 2}


@pytest.mark.parametrize("tile, chars", [(7, 1 << 20), (1024, 300)])
def test_crowded_blocks_in_tiles(spark, monkeypatch, tile, chars):
    # One half shared by all words, so that one block holds them all.
    words = {f"common{prose(i, 1)}{'abcdefghij'[i % 10]}{prose(i // 7, 1)[:2]}": 3 + i for i in range(600)}
    words |= {f"common{a}{b}{c}": 5 for a in "abcd" for b in "abcd" for c in "ab"}
    monkeypatch.setattr(variants, "TILE", tile)
    monkeypatch.setattr(variants, "TILE_CHARS", chars)
    rows = spark.createDataFrame(list(words.items()), "word string, n bigint")
    check(variants.variants(rows), words)


def all_pairs(words):
    """Near words by what each pair has in common at both ends, for a few long words."""

    def near(a, b):
        ends = len(os.path.commonprefix([a, b])) + len(os.path.commonprefix([a[::-1], b[::-1]]))
        return a != b and abs(len(a) - len(b)) < 2 and ends >= max(len(a), len(b)) - 1

    return {w: {x for x in words if near(w, x)} for w in words}


def test_very_long_words(spark):
    long = "".join(prose(i, 400) for i in range(60)).replace(" ", "").replace(".", "")
    words = {long: 3, long[:-1]: 9, "x" + long: 4, long[:500] + "q" + long[501:]: 5, long[1:] + "z": 7, long[::-1]: 3}
    assert len(long) > 70_000
    rows = [(i, " ".join(w for w, n in words.items() for _ in range(n))) for i in range(1)]
    check(variants.spelling_variants(spark.createDataFrame(rows, "doc_id bigint, text string")), words, all_pairs)


def test_pairs_once_and_blocks_stay_small(spark):
    words = list({prose(i, 3).replace(" ", "").replace(".", "") for i in range(4000)})
    rows = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    pairs = [(r["word"], r["near"]) for r in variants.near_pairs(rows).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(w, x) for w, near in neighbours(words).items() for x in near}
    assert variants.tiles(variants.blocks(rows)).count() < 5 * len(words)
