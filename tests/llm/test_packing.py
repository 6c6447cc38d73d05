import zlib

import numpy as np
import public_tokenizers
import pytest
from text_cases import awkward, empty, read
from tokenizers import Tokenizer

from tierline.llm import packing


def whole(texts, name="word_bpe_49k.json"):
    encoder = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*encoder.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def check(docs, length):
    pieces = [r.asDict() for r in packing.packed(docs, length).collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    ids = whole([t for _, t in rows])
    # The sequences are whole, and the row of all tokens falls into the documents again.
    pieces.sort(key=lambda p: (p["sequence_id"], p["offset"]))
    row, documents, at = [], [], 0
    for p in pieces:
        own = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(own) == p["length"] > 0
        assert (p["sequence_id"], p["offset"]) == divmod(at, length)
        assert p["offset"] + p["length"] <= length
        if p["start"] == 0:
            documents.append((p["doc_id"], []))
        assert documents[-1][0] == p["doc_id"] and len(documents[-1][1]) == p["start"]
        documents[-1][1].extend(own)
        at += len(own)
        row += own
    assert at == sum(map(len, ids))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(documents, key=key) == sorted(zip([i for i, _ in rows], ids), key=key)
    return pieces


def test_round_trip(spark):
    check(read(spark, "documents").repartition(7), 4096)


@pytest.mark.parametrize("length", [1, 16, 1000])
def test_awkward_rows(spark, length):
    check(awkward(spark).repartition(3), length)


def test_checksums(spark):
    pieces = packing.packed(awkward(spark), 64)
    for p, d in zip(pieces.collect(), packing.digests(pieces).collect()):
        assert d["ids_crc32"] == zlib.crc32(p["ids"])


def test_empty_table(spark):
    assert packing.packed(empty(awkward(spark))).count() == 0


def test_words_are_put_together_as_the_tokenizer_does():
    texts = [
        "Don't it's we'd 's '", "J̌ café CAFÉ À×b ÷ naïve.ß", "İstanbul 中文 3.14",
        "x y\x1cz \x00a\x7f", "<|startoftext|>a<|endoftext|>", "a_b-c/d!!??...", "", " \n\t ", "\U0001f600\U0001f600x", "ﬁ K ſ",
    ]
    found = [np.frombuffer(x, "<u4").tolist() for x in packing._encoder("word_bpe_49k.json")(texts)]
    assert found == [x[:-1] for x in whole(texts)]


def test_tokenizer_that_keeps_white_space(spark):
    docs = spark.createDataFrame([(1, "a  b\n c"), (2, "word")], "doc_id bigint, text string")
    rows = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.packed(docs, 99, "byte_bpe_50k.json").collect()}
    assert rows == dict(zip((1, 2), whole(["a  b\n c", "word"], "byte_bpe_50k.json")))
