import re

from text_cases import awkward, empty, prose, read

from tierline.llm import repeats


def units(text):
    """Sentences by walking over the text."""
    out = []
    for line in re.finditer(r"[^\n]+", text or ""):
        at, body = line.start(), line[0]
        begin = None
        for i, c in enumerate(body):
            if begin is None:
                if c.isspace():
                    continue
                begin = i
            last = i + 1 == len(body)
            if last or (c in ".!?" and body[i + 1].isspace()):
                raw = body[begin : i + 1].rstrip()
                out.append((at + begin, at + begin + len(raw), raw.lower().split()))
                begin = None
    return out


def plain(rows, least):
    seen, all_units = {}, []
    for i, text in dict.fromkeys(rows):
        for no, (start, end, words) in enumerate(units(text)):
            all_units.append((i, text, no, start, end, words))
            rank = (i is None, i or 0)
            key = " ".join(words)
            if key not in seen or (rank, start) < seen[key][0]:
                seen[key] = ((rank, start), i)
    found, run = set(), []

    def close():
        if run and sum(len(u[5]) for u in run) >= least:
            found.add((run[0][0], run[0][3], run[-1][4], sum(len(u[5]) for u in run), len(run)))
        run.clear()

    for u in all_units:
        first = seen[" ".join(u[5])][0]
        repeated = first != ((u[0] is None, u[0] or 0), u[3])
        if run and (run[-1][:2] != u[:2] or not repeated):
            close()
        if repeated:
            run.append(u)
    close()
    return found


def check(docs, least):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = {tuple(r) for r in repeats.repeated_spans(docs, least_words=least).select("doc_id", "start", "end", "n_words", "n_units").collect()}
    assert found == plain(rows, least)
    return found


def test_against_plain_version(spark):
    assert check(read(spark, "documents").repartition(4), 25)


def test_awkward_rows(spark):
    docs = awkward(spark).filter("doc_id <> 11 or doc_id is null")
    assert {r[0] for r in check(docs, 25)} == {5, 8, None}
    check(docs, 1)


def test_planted_passage_within_a_line(spark):
    passage = prose(9, 60)
    rows = [(1, f"{prose(1, 40)} end. {passage}\nlast"), (2, f"start here. {passage} {prose(2, 30)}"), (3, prose(3, 200)), (4, passage.upper())]
    found = repeats.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] for r in found} == {2, 4}
    assert all(r["first_doc_ids"] == [1] and r["n_words"] >= 50 for r in found)


def test_removal_keeps_everything_else(spark):
    docs = awkward(spark)
    out = repeats.without_repeats(docs)
    assert out.columns == [*docs.columns, "removed_"]
    spans = {}
    for r in repeats.repeated_spans(docs).collect():
        spans.setdefault((r["doc_id"], r["end"]), []).append((r["start"], r["end"]))
    after = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (1, prose(1, 120)) in after and (5, prose(1, 120)) not in after and (2, None) in after
    assert out.count() == docs.count() and spans


def test_empty_table_and_lines(spark):
    assert repeats.repeated_spans(empty(awkward(spark))).count() == 0
    rows = [(1, prose(4, 30) + "\nb"), (2, "c\n" + prose(4, 30))]
    found = repeats.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string"), unit="line").collect()
    assert [(r["doc_id"], r["start"], r["n_words"]) for r in found] == [(2, 2, 30)]


def test_every_later_occurrence_of_a_short_line(spark):
    rows = [(1, "All rights reserved.\nown text here"), (2, "Menu\nsomething else\nall  rights reserved."), (3, "menu\n\n Menu"), (4, "new")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert repeats.repeated_spans(docs).count() == 0  # runs of sentences leave lines below the floor
    found = sorted(repeats.repeated_lines(docs).select("doc_id", "start", "end", "n_units", "first_doc_ids").collect())
    assert [tuple(r) for r in found] == [(2, 20, 41, 1, [1]), (3, 0, 11, 2, [2])]


def test_all_lines_of_the_documents_that_others_have(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    seen, later = set(), 0
    for r in docs.select("doc_id", "text").orderBy("doc_id").collect():
        for line in (r["text"] or "").split("\n"):
            key = " ".join(line.lower().split())
            later += bool(key) and key in seen
            seen.add(key)
    assert repeats.repeated_lines(docs.repartition(4)).groupBy().sum("n_units").first()[0] == later > 0
