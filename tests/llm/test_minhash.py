import re
import sys
from itertools import combinations

import pytest
from text_cases import awkward, empty, prose, read

from tierline.llm import minhash
from tierline.llm.components import components


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def plain(rows, width, percent):
    """Component of every document by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    links = [
        (a, b) for (a, x), (b, y) in combinations(sets, 2)
        if x and y and a != b and 100 * len(x & y) >= percent * len(x | y)
    ]
    return roots({i for i, _ in sets}, links)


def check(docs, width=4, percent=80):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = [tuple(r)[:4] for r in minhash.near_duplicates(docs, width, percent).collect()]
    root = plain(rows, width, percent)
    wanted = [(i, len(shingles(t, width)), root.get(i), i is None or root[i] == i) for i, t in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    return found


def test_against_all_pairs(spark):
    found = check(read(spark, "documents"))
    assert any(not r[3] for r in found)


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = check(docs)
    assert {r[0] for r in found if not r[3]} == {5, 8, 10}
    check(docs, width=5)


def test_empty_table(spark):
    assert minhash.near_duplicates(empty(awkward(spark))).count() == 0
    assert minhash.without_copies(empty(awkward(spark))).count() == 0


def test_crowded_bucket_of_near_copies(spark):
    """Copies of one text with two to eight words changed: some pairs are linked, most only by others."""
    base = prose(5, 150).split()
    rows = []
    for i in range(160):
        words = list(base)
        for j in range(2 + i % 7):
            words[(i * 37 + j * 53) % len(words)] = f"x{i}y{j}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = check(docs)
    assert 1 < len({r[2] for r in found}) < 160


def test_one_of_each_stays_with_its_columns(spark):
    docs = awkward(spark)
    kept = minhash.without_copies(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 2, 3, 4, 6, 7, 9, 11, 11, 12]
    assert ids.count(None) == 2


def test_estimate_is_corrected_for_chance(spark):
    rows = [(1, prose(1, 400)), (2, prose(2, 400)), (3, prose(1, 400) + " " + prose(2, 400))]
    sketch = minhash.signatures(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)
    short = [f"s{i}" for i in range(4)]
    a = sketch.select("doc_id", *[sketch[c].alias(f"a_{c}") for c in short]).withColumnRenamed("doc_id", "a")
    b = sketch.select("doc_id", *[sketch[c].alias(f"b_{c}") for c in short]).withColumnRenamed("doc_id", "b")
    pairs = a.join(b, a["a"] < b["b"]).select("a", "b", minhash.estimate(minhash.equal_lanes("a_", "b_")).alias("j"))
    for a, b, j in pairs.collect():
        x, y = shingles(dict(rows)[a], 4), shingles(dict(rows)[b], 4)
        assert j == pytest.approx(len(x & y) / len(x | y), abs=0.2)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 90), (95, 90), (7, 7)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 90, 95: 90, 90: 90}


def writes(monkeypatch, run):
    """How many tables ``run`` stages."""
    names, stage = [], minhash.stage

    def counted(df, name):
        names.append(name)
        return stage(df, name)

    for module in (minhash, sys.modules[components.__module__]):
        monkeypatch.setattr(module, "stage", counted)
    run()
    return len(names)


def test_links_that_are_trees_take_no_rounds(spark, monkeypatch):
    star = spark.createDataFrame([(i, 0) for i in range(1, 40)], "u bigint, v bigint")
    assert writes(monkeypatch, lambda: components(star).collect()) == 1
    chain = spark.createDataFrame([(i, i + 1) for i in range(64)], "u bigint, v bigint")
    assert writes(monkeypatch, lambda: components(chain).collect()) <= 9
    none = spark.createDataFrame([], "u bigint, v bigint")
    assert writes(monkeypatch, lambda: components(none).collect()) == 1


def test_links_with_several_ends(spark):
    """A hub above its leaves, a ring, and two trees that meet."""
    links = [(99, i) for i in range(1, 20)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    links += [(310, 300), (320, 305), (330, 310), (330, 320)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == roots({n for link in links for n in link}, links)


def test_few_steps(spark, monkeypatch):
    """The number of tables written does not come from labelling all documents again for every kind of link."""
    docs = read(spark, "documents")
    assert writes(monkeypatch, lambda: check(docs)) <= 25


def test_texts_of_a_repeated_id_join_groups(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(4, a), (5, a), (5, b), (6, b), (3, b + " end"), (7, c), (7, c), (8, c + " end"), (9, prose(4, 60))]
    found = check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert {r[0]: r[2] for r in found} == {3: 3, 4: 3, 5: 3, 6: 3, 7: 7, 8: 7, 9: 9}
