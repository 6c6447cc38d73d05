import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from text_cases import awkward, empty, read, shuffled

from tierline.llm import toxicity
from tierline.llm.common import chunks


def plain_expressions(text):
    """Runs of eight bytes of every word with its limits, or all of a shorter one."""
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words, own = [], b""
    for b in low + b" ":
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            own += bytes([b])
        elif own:
            words.append(b"\0" + own + b"\0")
            own = b""
    return [w[i : i + 8] for w in words for i in range(max(1, len(w) - 7))]


def as_number(expression):
    return int.from_bytes(expression.ljust(8, b"\0"), "little")


def test_expressions_against_plain_version():
    rows = ["", "a", "The Idiot, twice idiot!", "é ÉÉ worthless", "x" * 40, "  ", "ab cd"]
    (_, _, data, limits), = chunks(pa.array(rows, pa.large_string()))
    found, at = toxicity.expressions(data, limits)
    for i, text in enumerate(rows):
        assert found[at[i] : at[i + 1]].tolist() == [as_number(x) for x in plain_expressions(text)]


def test_model_against_plain_version(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01").join(read(spark, "labels", "/root/testdata/sf0.01"), "doc_id")
    keys, ratios = toxicity.fit(shuffled(docs.select("text", "toxic")))
    counts = [Counter(), Counter()]
    for r in docs.collect():
        counts[r["toxic"]].update(set(plain_expressions(r["text"])))
    plain, toxic = (sum(c.values()) for c in counts)
    both, kinds = plain + toxic, len(counts[0] | counts[1])
    share, rest = toxic / both, toxicity.DISCOUNT * kinds / both
    wanted = {}
    for x in counts[0] | counts[1]:
        a, b = counts[1][x], counts[0][x]
        if abs(a - (a + b) * share) / math.sqrt((a + b) * share * (1 - share)) > toxicity.TELLING:
            p = max(a - toxicity.DISCOUNT, 0) / toxic + rest * (a + b) / both
            q = max(b - toxicity.DISCOUNT, 0) / plain + rest * (a + b) / both
            wanted[as_number(x)] = math.log(p / q)
    assert keys.tolist() == sorted(wanted)
    assert np.allclose(ratios, [wanted[k] for k in sorted(wanted)])


def test_margin_is_normalised_by_length(spark):
    model = (np.array(sorted(as_number(b"\0idiot\0") for _ in range(1)), np.uint64), np.array([2.0]))
    rows = [(1, "you idiot"), (2, "Idiot idiot"), (3, "nothing"), (4, None), (5, "")]
    found = toxicity.margins(spark.createDataFrame(rows, "doc_id int, text string"), model)
    assert {r["doc_id"]: r["margin"] for r in found.collect()} == {1: 1.0, 2: 2.0, 3: 0.0, 4: 0.0, 5: 0.0}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = read(spark, "documents", sf)
    found = {r["doc_id"]: r for r in toxicity.scored(docs, read(spark, "labels", sf)).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, "labels", sf).collect()}
    out = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i]["held_out"] for i in out) and len(found) == docs.count()
    hit = sum(found[i]["predicted"] and labels[i] for i in out)
    assert hit / sum(found[i]["predicted"] for i in out) > 0.95
    assert hit / sum(labels[i] for i in out) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())


def test_held_out_labels_are_not_used(spark):
    docs, labels = (read(spark, t, "/root/testdata/sf0.01") for t in ("documents", "labels"))
    changed = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    as_rows = lambda df: sorted((r[0], round(r[2], 9), r[3]) for r in df.collect())
    assert as_rows(toxicity.scored(docs, labels)) == as_rows(toxicity.scored(shuffled(docs), changed))


def test_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (5, 0), (6, None), (None, 1), (7, 5), (99, 1)], "doc_id bigint, toxic int")
    found = toxicity.scored(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(r["predicted"] == 0 for r in found)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.scored(docs, empty(labels)).count() == docs.count()
    assert toxicity.scored(empty(docs), labels).count() == 0


def test_threshold_puts_most_on_the_right_side(spark):
    rows = [(0.0, 0), (0.01, 0), (0.02, 0), (0.3, 0), (0.05, 1), (0.2, 1), (0.4, 1)]
    found = toxicity.threshold(spark.createDataFrame(rows, "margin double, toxic int"))
    assert 0.02 < found < 0.05


def test_model_has_every_telling_expression(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MODEL_ROWS", 5, raising=False)
    word = lambda i: "".join("bcdfghjk"[i // 8**k % 8] + "aeiou"[k] for k in range(3))
    rows = [(" ".join(word(i) for i in range(20)), 1)] * 60 + [(" ".join(word(i) for i in range(100, 120)), 0)] * 60
    keys, ratios = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"))
    assert len(keys) == len(ratios) == 40 and (ratios > 0).sum() == 20


def plain_kneser_ney(counts):
    """Probability of a gram's last byte behind the others, from the documents per expression of one class."""
    raw, levels = Counter(), [set() for _ in range(9)]
    for x, n in counts.items():
        for k in range(2, len(x) + 1) if x[0] == 0 else [len(x)]:
            raw[x[:k]] += n
    for x in raw:
        levels[len(x)].add(x)
    found = Counter(raw)
    for k in range(8, 1, -1):
        found.update(x[1:] for x in levels[k])
        levels[k - 1].update(x[1:] for x in levels[k])
    total, kinds = Counter(), Counter()
    for x, n in found.items():
        total[x[:-1]] += n
        kinds[x[:-1]] += 1

    def probability(x):
        if not x:
            return 1 / 256
        lower, c = probability(x[1:]), x[:-1]
        d = toxicity.DISCOUNT
        return (max(found[x] - d, 0) + d * kinds[c] * lower) / total[c] if total[c] else lower

    return probability


def test_kneser_ney_against_plain_version(spark):
    docs, labels = (read(spark, t, "/root/testdata/sf0.01") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id").filter(toxicity.fold(F.col("doc_id"), 5) > 1)
    counts = [Counter(), Counter()]
    for r in known.collect():
        counts[r["toxic"]].update(set(plain_expressions(r["text"])))
    plain, toxic = (plain_kneser_ney(c) for c in counts)
    keys, ratios = toxicity.kneser_ney(shuffled(known.select("text", "toxic")))
    assert keys.tolist() == toxicity.fit(known)[0].tolist() and len(keys) > 10
    wanted = {}
    for x in counts[0] | counts[1]:
        ends = [x[:k] for k in range(2, len(x) + 1)] if x[0] == 0 else [x]
        wanted[as_number(x)] = sum(math.log(toxic(y) / plain(y)) for y in ends) if as_number(x) in keys else 0
    assert np.allclose(ratios, [wanted[k] for k in keys.tolist()])
    (learnt, weights), _ = toxicity.learn(docs, labels)
    assert learnt.tolist() == keys.tolist() and np.allclose(weights, ratios)


def test_contexts_and_short_words_have_their_weight(spark):
    rows = [("abcdefghij a zzz", 1)] * 40 + [("abcdefghik b zzz", 0)] * 40
    keys, ratios = toxicity.kneser_ney(spark.createDataFrame(rows, "text string, toxic int"))
    found = dict(zip(keys.tolist(), ratios))
    ends = [as_number(x) for x in (b"\0a\0", b"\0b\0", b"cdefghij", b"cdefghik")]
    assert [found[x] > 0 for x in ends] == [True, False, True, False] and as_number(b"\0zzz\0") not in found
    assert toxicity.kneser_ney(spark.createDataFrame(rows[:40], "text string, toxic int"))[0].tolist() == []


def plain_weights(rows, others):
    """The weight of every expression, from ``text, toxic``: both classes' models, each with the shared one."""
    counts = [Counter(), Counter()]
    for text, toxic in rows:
        counts[toxic].update(set(plain_expressions(text)))
    both = counts[0] + counts[1]
    models = [plain_kneser_ney(c) for c in (counts[1], counts[0], both)]
    share, g = sum(counts[1].values()) / sum(both.values()), math.lgamma

    def evidence(x):
        a, b = counts[1][x], counts[0][x]
        own = g(a + share) + g(b + 1 - share) - g(a + b + 1) - g(share) - g(1 - share)
        return own - a * math.log(share) - b * math.log(1 - share)

    steps = Counter(round(min(max(evidence(x), -50), 50) * 100) for x in both)
    prior = 0.5
    for _ in range(20_000):
        prior = sum(n / (1 + math.exp(-k / 100) * (1 - prior) / prior) for k, n in steps.items()) / len(both)
    found = {}
    for x in set(both).union(*map(plain_expressions, others)):
        ends = [x[:k] for k in range(2, len(x) + 1)] if x[0] == 0 else [x]
        toxic, plain, shared = (math.prod(m(y) for y in ends) for m in models)
        differ = 1 / (1 + math.exp(-evidence(x)) * (1 - prior) / prior)
        found[x] = math.log((differ * toxic + (1 - differ) * shared) / (differ * plain + (1 - differ) * shared))
    return found, both


def test_every_expression_weighs(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART", 10_000)
    docs, labels = (read(spark, t, "/root/testdata/sf0.01") for t in ("documents", "labels"))
    known = docs.join(labels, "doc_id").filter(toxicity.fold(F.col("doc_id"), 5) > 1)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    wanted, learnt = plain_weights([(r["text"], r["toxic"]) for r in known.collect()], texts.values())
    assert len(wanted) > 1.5 * len(learnt) > 80_000
    found = {r["doc_id"]: r["margin"] for r in toxicity.scored(shuffled(docs), labels).collect()}
    different = set()
    for i, text in texts.items():
        own = plain_expressions(text)
        different.add(tuple(sorted(own)))
        assert math.isclose(found[i], sum(wanted[x] for x in own) / max(1, len(own)), rel_tol=1e-5, abs_tol=1e-9)
    assert len(set(found.values())) > 0.98 * len(different) > 900  # nearly all were 0 when only telling ones weighed


def test_an_expression_that_does_not_tell_weighs_something(spark):
    plain = [(i, f"abc def {'kfo' if i % 9 else 'tzu'} ghi", 0) for i in range(0, 900)]
    toxic = [(i, f"abc def {'kfo' if i % 6 else 'tzu'} ghi insult", 1) for i in range(1000, 1300)]
    rows = spark.createDataFrame(plain + toxic, "doc_id long, text string, toxic int")
    other = spark.createDataFrame([(5000, "tzu"), (5001, "kfo"), (5002, "insult"), (5003, "insuls")], "doc_id long, text string")
    found = toxicity.scored(rows.select("doc_id", "text").union(other), rows.select("doc_id", "toxic"))
    margin = {r["doc_id"]: r["margin"] for r in found.filter("doc_id >= 5000").collect()}
    assert margin[5002] > margin[5000] > 0 > margin[5001]
    assert margin[5003] != 0  # no labelled text has it; lower orders know most of it


def test_nothing_is_toxic_without_a_toxic_text_above_the_threshold(spark):
    docs, labels = (read(spark, t, "/root/testdata/sf0.001") for t in ("documents", "labels"))
    model, limit = toxicity.learn_whole(docs, labels)
    found = toxicity.scored(docs, labels).collect()
    assert limit > 1 and not any(r["predicted"] for r in found)
    assert len({r["score"] for r in found}) > 100


def test_share_of_differing_expressions(spark):
    rows = [(5, 95)] * 900 + [(50, 50)] * 100
    per = spark.createDataFrame(rows + [(0, 0)] * 50, "a long, b long")
    assert 0.08 < toxicity.differing(per, 0.05) < 0.12
    assert toxicity.differing(per.filter("b = 95"), 0.05) < 0.01


def test_model_that_executors_have_copies_of(spark, tmp_path):
    keys = np.sort(np.array([as_number(b"\0idiot\0"), as_number(b"\0you\0")], np.uint64))
    (tmp_path / "model-of-two").write_bytes(keys.tobytes() + np.array([0.5, 0.5]).tobytes())
    spark.sparkContext.addFile(str(tmp_path / "model-of-two"))
    rows = spark.createDataFrame([(1, "you idiot"), (2, "idiot or not")], "doc_id int, text string")
    found = toxicity.margins(rows, ["model-of-two"]).collect()
    assert {r["doc_id"]: round(r["margin"], 9) for r in found} == {1: 0.5, 2: round(0.5 / 3, 9)}


def test_blocks_keep_rows_of_one_kind_together(monkeypatch):
    monkeypatch.setattr(toxicity, "_BLOCK", 10)
    parts = np.repeat(np.arange(9), [3, 1, 25, 2, 9, 1, 14, 4, 3])
    batches = pa.table({"part": parts, "v": np.arange(len(parts))}).to_batches(max_chunksize=4)
    found = list(toxicity._blocks(iter(batches)))
    assert np.concatenate([t["v"].to_numpy() for t in found]).tolist() == list(range(len(parts))) and len(found) > 2
    kinds = [set(t["part"].to_pylist()) for t in found]
    assert sum(map(len, kinds)) == len(set().union(*kinds)) == 9
    assert list(toxicity._blocks(iter([]))) == []
