import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from text_cases import awkward, empty, prose, read, shuffled

from tierline.llm import crf, pii, pii_examples


def plain(text):
    """Spans of the four patterns, written as they are stated."""
    text, found = text or "", []
    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    found += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [(m.start(), 1, m.end())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m[0])[::-1]
        luhn = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
        found += [(m.start(), 2, m.end())] if 12 <= len(d) <= 19 and luhn % 10 == 0 else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [(m.start(), 3, m.end())] if 9 <= len(digits(m[0])) <= 15 else []
    return sorted(found)


TEXTS = [
    "a@b.cd@e.fg h@i x@y.z_d@e.fg q@w@e.rt @a.b a.b%c+d-e@x-y.z.. é@b.c ü.a@b.c@d",
    "1.2.3.4.5.6.7.8 255.255.255.255 256.1.1.1 01.002.0003.4 1..2.3.4 1.2.3 a1.2.3.4b 99999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 5500005555555559 1 4111111111111111 378282246310005x 0000000000000",
    "+1 (017) 555-7713 +12345678 +123456789 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +1-800-555.0199. ++49 30 901820 +", "\x00+49\x0030 12 345 678 中 +49 (0)30 / 12 34 567", "",
]


def spans(field, text):
    found = list(pii.find(field, pa.array([text], pa.large_string())))
    return [(pii._kind(s, field.kinds), s[0], s[2]) for s in found[0][1]] if found else []


def test_patterns_against_plain_version(spark):
    for text in [*TEXTS, *(r["text"] for r in read(spark, "documents", "/root/testdata/sf0.01").collect())]:
        assert [s[:3] for s in pii.base_spans(text or "")] == plain(text)


def test_patterns_on_very_long_runs():
    for text in ("9" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "a.b-" * 100_000 + "@x", "+1" + " " * 300_000, "1.2.3." * 100_000):
        pii.base_spans(text)


def test_query_columns(spark):
    docs = spark.createDataFrame(list(enumerate([*TEXTS, None])), "doc_id bigint, text string")
    for r in pii.personal(shuffled(docs)).collect():
        base = plain([*TEXTS, None][r["doc_id"]])
        names = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        listed = [x for x in r["spans"].split(",") if x]
        assert [x for x in listed if x.split(":")[0] in pii.KINDS] == names and len(listed) == len(names) + r["n_added"]


def test_added_spans_of_unseen_rows_and_of_written_lines():
    field = pii.fit()
    wanted = found = right = 0
    for text, own in pii_examples.labelled(600, first=500_000):
        base = plain(text)
        own = {s for s in own if not any(a < s[2] and b > s[1] for a, _, b in base)}
        got = {s for s in spans(field, text) if s[0] in pii.ADDED}
        wanted, found, right = wanted + len(own), found + len(got), right + len(own & got)
    assert right > 0.85 * wanted and right > 0.9 * found
    lines = {
        "Please ring Mrs Weber on (030) 901-8200 before noon.": ["Weber", "(030) 901-8200"],
        "you can mail jane.doe [at] example [dot] org or call 555-0199": ["jane.doe [at] example [dot] org", "555-0199"],
        "Her SSN is 078-05-1120, IBAN DE89 3704 0044 0532 0130 00.": ["078-05-1120", "DE89 3704 0044 0532 0130 00"],
        "The meeting is on 2024-05-01 at 12:30, room 101, costs $1,200.50": [],
        "logged in from fe80::1ff:fe23:4567:890a at 10:15:33": ["fe80::1ff:fe23:4567:890a"],
        "We met in Paris on Monday. The Chapter 12 of Volume 3, pages 45-67, was read.": [],
        "build 3.11.2, commit 9f86d081884c7d659a2feaa0c55ad015, 42% done": [],
        "Nobody told Dr. Smith anything.": ["Smith"],
    }
    for line, values in lines.items():
        assert [line[a:b] for _, a, b in spans(field, line)] == values


def test_clean_documents_are_left_alone(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    assert pii.personal(docs).agg(F.sum("n_added")).first()[0] <= 3


def test_cutting_at_plain_words_changes_nothing(spark):
    field = pii.fit()
    texts = [r["text"] for r in read(spark, "documents").collect()] + [t for t, _ in pii_examples.labelled(300, first=9000)] + TEXTS
    column = pa.array(texts * 2, pa.large_string())
    for _, _, data, limits in pii.chunks(pii.texts(pa.RecordBatch.from_arrays([column], ["text"]))):
        _, _, text, score = field.score(data, limits)
        cut, whole = (field.labels(text, score, cut=c) for c in (True, False))
        assert (cut == whole).all() and whole.any()


def test_scores_in_bulk_are_those_of_the_features():
    field = pii.fit()
    texts = [t for t, _ in pii_examples.labelled(60, first=77)] + ["Mr. A b.C ÉA éa. xX!! ... . ! ::1 a:b 1:b é1 \x00 [at] Telefon TELEFON phone phones", "", " \n", "x"]
    for _, _, data, limits in pii.chunks(pa.array(texts, pa.large_string())):
        starts, ends, text, score = field.score(data, limits)
        for i in range(len(texts)):
            words = [data[a:b].tobytes().decode() for a, b in zip(starts[text == i], ends[text == i])]
            wanted = [field.chain.weight(f) for f in field._features(words)]
            assert score[text == i] == pytest.approx(np.array(wanted).reshape(-1, len(field.kinds)), abs=1e-3)


def small_chain(seed):
    rng = np.random.default_rng(seed)
    chain = crf.Chain(["a", "b", "c"], [])
    chain.parts = [rng.normal(size=(6, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)]
    rows = [([[int(x) for x in rng.integers(0, 6, rng.integers(1, 4))] for _ in range(n)], rng.integers(0, 3, n).tolist()) for n in (1, 4, 2, 3)]
    return chain, rows


def value(chain, row, labels):
    weights, steps, starts = chain.parts
    total = starts[labels[0]] + sum(weights[row[i]].sum(axis=0)[x] for i, x in enumerate(labels))
    return total + sum(steps[a, b] for a, b in zip(labels, labels[1:]))


def test_likelihood_and_its_slopes_against_all_labellings():
    chain, rows = small_chain(1)
    batch = crf.Batch(rows)

    def plain_mean():
        each = []
        for row, labels in rows:
            all_values = [value(chain, row, x) for x in itertools.product(range(3), repeat=len(row))]
            each.append(value(chain, row, labels) - np.log(np.exp(all_values).sum()))
        return np.mean(each)

    mean, slopes = crf.objective(batch, *chain.parts)
    assert mean == pytest.approx(plain_mean())
    for part, slope in zip(chain.parts, slopes):
        for place in np.ndindex(part.shape):
            part[place] += 1e-5
            up = plain_mean()
            part[place] -= 2e-5
            assert slope[place] == pytest.approx((up - plain_mean()) / 2e-5, abs=1e-6)
            part[place] += 1e-5


def test_viterbi_against_all_labellings():
    for seed in range(20):
        chain, rows = small_chain(seed)
        score = np.concatenate([[chain.parts[0][x].sum(axis=0) for x in row] for row, _ in rows])
        length = np.array([len(row) for row, _ in rows])
        first = np.cumsum(length) - length
        found = chain.likeliest(score, first, np.repeat(np.arange(4), length), np.tile(chain.starts, (4, 1)), np.zeros((4, 3)))
        for (row, _), at in zip(rows, first):
            best = max(itertools.product(range(3), repeat=len(row)), key=lambda x: value(chain, row, x))
            assert tuple(found[at : at + len(row)]) == best


def test_labelled_table_of_ones_own(spark):
    rows = [(f"{prose(i, 4)} badge {chr(65 + i % 26)}{i % 10}{i % 7}-{i % 3} {prose(i + 50, 3)}", i) for i in range(80)]
    rows = [(t, [("badge", m.start(1), m.end(1))]) for t, _ in rows if (m := re.search(r"badge (\S+)", t))] + [(prose(i, 9), None) for i in range(40)] + [(None, [])]
    table = spark.createDataFrame(rows, "text string, spans array<struct<kind string, start int, end int>>")
    text = f"{prose(900, 5)} badge Q83-1 {prose(901, 5)}"
    found = pii.personal(spark.createDataFrame([(1, text), (2, prose(5, 30))], "doc_id bigint, text string"), table).collect()
    at = text.index("Q83-1")
    assert {r["doc_id"]: r["spans"] for r in found} == {1: f"badge:{at}:{at + 5}", 2: ""}
    nobody = pii.personal(spark.createDataFrame([(1, "mail x@y.zz")], "doc_id bigint, text string"), empty(table)).collect()
    assert [r["spans"] for r in nobody] == ["email:5:11"]


def test_masking(spark):
    docs = awkward(spark).unionByName(
        spark.createDataFrame([(50, "é write x@y.zz, ask Mr. Kemp or call (030) 555-0123."), (50, TEXTS[3])], "doc_id bigint, text string"), allowMissingColumns=True
    )
    out = pii.masked(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() == docs.count()
    before, after = ({(r["doc_id"], r["text"]) for r in df.collect()} for df in (docs, out))
    assert {x for x in before if x[0] != 50} == {x for x in after if x[0] != 50}
    texts = sorted(t for i, t in after if i == 50)
    assert "[phone]" in texts[0] and "555-7713" not in texts[0] and texts[1] == "é write [email], ask Mr. [name] or call [like_phone]."


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = pii.personal(docs).collect()
    assert len(found) == docs.count() and all(r["spans"] == "" for r in found)
    assert pii.personal(empty(docs)).count() == 0
    long = " ".join(["+49 30 1234567", prose(3, 40), "a@b.cd"] * 4000)
    (row,) = pii.personal(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).collect()
    assert (row["n_phone"], row["n_email"]) == (4000, 4000) and row["spans"].count(":") >= 16_000
