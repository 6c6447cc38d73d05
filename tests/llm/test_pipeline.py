import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_contamination import plain as benchmark_words
from test_minhash import plain as components
from test_toxicity import as_number, plain_expressions
from text_cases import SF, awkward, empty, read
from tokenizers import Tokenizer

from tierline.llm import secrets, toxicity


def plain(spark, rows, model, limit, formats, items):
    """The documents' texts after all stages but the last, stage by stage over all rows."""
    keys = dict(zip(model[0].tolist(), model[1]))

    def margin(text):
        own = [as_number(x) for x in plain_expressions(text)]
        return sum(keys.get(x, 0) for x in own) / max(1, len(own))

    rows = [r for r in rows if margin(r[1]) < limit]
    root = components(rows, 5, 80)
    rows = [r for r in dict.fromkeys(rows) if r[0] is None or root[r[0]] == r[0]]
    rows = [r for r in rows if not benchmark_words(r[1], items, 10)[1]]
    run = secrets._mask(formats, "[secret]")
    return [(i, None if t is None else next(run(iter([spark.createDataFrame([(t,)], "text string").toArrow().to_batches()[0]])))["text"][0].as_py()) for i, t in rows]


def test_against_plain_version(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    docs, labels = read(spark, "documents"), read(spark, "labels")
    model, limit = toxicity.learn(docs, labels)
    items = [tuple(r) for r in read(spark, "benchmark").select("item_id", "text").collect()]
    kept = docs
    for _, step in corpus_pipeline.STAGES[:3]:
        kept = step(spark, kept, SF)
    wanted = plain(spark, [tuple(r) for r in docs.select("doc_id", "text").collect()], model, limit, secrets.fit(kept), items)
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for p in pieces:
        found.setdefault(p["doc_id"], []).append(p)
    assert sorted(found) == sorted(i for i, _ in wanted)
    assert 0 < len(wanted) < docs.count()
    for i, text in wanted:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 2]
        for p in sorted(found[i], key=lambda p: p["start"]):
            own = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            assert (p["doc_tokens"], p["ids_crc32"]) == (len(ids), zlib.crc32(own))
    assert sum(p["length"] for p in pieces) == max(p["sequence_id"] * 4096 + p["offset"] + p["length"] for p in pieces)


def test_every_stage_keeps_columns_and_stands_awkward_rows(spark):
    docs = awkward(spark)
    for start in (docs, empty(docs)):
        rows = start
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, rows, SF)
            if name != "packing":
                assert out.columns == rows.columns, name
                assert out.dtypes == rows.dtypes, name
                rows = out
            else:
                assert sum(r["doc_tokens"] for r in out.filter("start = 0").collect()) == sum(r["length"] for r in out.collect())


def test_decisions_take_effect(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, "labels", "/root/testdata/sf0.01").collect()}
    counts = Counter()
    rows = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.stage(step(spark, rows, "/root/testdata/sf0.01"), name)
        counts[name] = rows.count()
        if name == "toxicity":
            kept = {r["doc_id"] for r in rows.collect()}
            assert sum(i in kept for i, x in labels.items() if x == 0) >= 0.98 * sum(x == 0 for x in labels.values())
            assert sum(i not in kept for i, x in labels.items() if x) >= 0.55 * sum(labels.values())
    assert counts["near_duplicates"] < counts["toxicity"] and counts["decontamination"] < counts["near_duplicates"]
    assert counts["secrets"] == counts["decontamination"]
    assert not rows.filter(F.col("text").rlike("[0-9a-f]{24}")).count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    assert re.match("[a-z]", corpus_pipeline.STAGES[0][0])


def test_recall_of_the_toxicity_stage(spark):
    for sf, least in (("/root/testdata/sf0.01", 0.64), ("/root/testdata/sf0.1", 0.94)):
        toxic = read(spark, "labels", sf).filter("toxic = 1").select("doc_id")
        kept = corpus_pipeline.not_toxic(spark, read(spark, "documents", sf), sf).select("doc_id").distinct()
        assert toxic.join(kept, "doc_id", "left_anti").count() >= least * toxic.count()


def test_toxicity_stage_judges_by_every_expression(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, "documents", sf), read(spark, "labels", sf)
    kept = {r["doc_id"] for r in corpus_pipeline.not_toxic(spark, docs, sf).collect()}
    scored = toxicity.scored(docs, labels).collect()
    assert kept == {r["doc_id"] for r in scored if not r["predicted"]}
    gone = {r["doc_id"] for r in toxicity.margins(docs, toxicity.learn(docs, labels)[0]).filter("margin = 0").collect()} - kept
    assert gone  # of telling expressions they have none
