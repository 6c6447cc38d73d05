"""One query per text operator over the test tables, with SQL for the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    contamination, extraction, infill, language, minhash, packing, pii, quality, repeats, secrets, toxicity, urls, variants,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _with_first(spans: DataFrame) -> DataFrame:
    """Repeated spans with the first of the documents that keep them, and how many these are."""
    ids = F.col("first_doc_ids")
    found = spans.withColumns({"first_doc_id": F.array_min(ids), "n_first_docs": F.size(ids).cast("bigint")})
    return found.drop("h", "first_doc_ids")


@query(rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
spot AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle FROM spot),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.size, y.size
  HAVING 100 * count(*) >= 80 * (x.size + y.size - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION
  SELECT reach.doc_id, link.v FROM reach JOIN link ON link.u = reach.r),
root AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN root USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op1_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash.near_duplicates(_read(spark, sf, "documents"), width=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op2_packed_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digests(packing.packed(_read(spark, sf, "documents"), length=4096))


@query(rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
span AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS words FROM span),
size AS (SELECT DISTINCT len(words) AS n FROM win),
place AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, size WHERE len(w) >= n),
hit AS (
  SELECT doc_id, item_id, i, n FROM place JOIN win ON win.words = place.w[place.i:place.i + place.n - 1]),
spot AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM hit),
hits AS (SELECT doc_id, count(*) AS n_hit FROM spot GROUP BY doc_id),
item AS (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM item GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op9_benchmark_passages(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.contaminated(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"), size=10)
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


@query()
def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    found = toxicity.scored(_read(spark, sf, "documents"), _read(spark, sf, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query()
def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.secrets(_read(spark, sf, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS ref,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup_lines FROM line
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 2]) AS n FROM spot),
twice AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM win WHERE n > 1),
repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM twice GROUP BY doc_id),
word AS (SELECT doc_id, ref, lower(unnest(w)) AS x FROM d),
top AS (
  SELECT ref, x, row_number() OVER (PARTITION BY ref ORDER BY count(*) DESC, x) AS kind FROM word
  GROUP BY ref, x QUALIFY kind <= 16),
common AS (
  SELECT doc_id, word.ref, coalesce(kind, 0) AS kind, count(*) AS n
  FROM word LEFT JOIN top ON top.ref = word.ref AND top.x = word.x GROUP BY ALL),
s1 AS (SELECT doc_id, ref, t, regexp_replace(t, '[a-z]+', '', 'g') AS a FROM d),
s2 AS (SELECT *, regexp_replace(a, '[\x20\x09-\x0D]+', '', 'g') AS b FROM s1),
s3 AS (SELECT *, regexp_replace(b, '[A-Z]+', '', 'g') AS c FROM s2),
s4 AS (SELECT *, regexp_replace(c, '[0-9]+', '', 'g') AS e FROM s3),
s5 AS (SELECT *, regexp_replace(e, '[.,;:!?''"()-]+', '', 'g') AS f FROM s4),
s6 AS (SELECT *, regexp_replace(f, '[\x00-\x7f]+', '', 'g') AS g FROM s5),
class AS (
  SELECT doc_id, ref, unnest([0, 1, 2, 3, 4, 5, 6]) AS kind, unnest([len(t) - len(a), len(a) - len(b), len(b) - len(c),
    len(c) - len(e), len(e) - len(f), len(f) - len(g), len(g)]) AS n FROM s6),
counted AS (
  SELECT 'class' AS what, * FROM class UNION ALL
  SELECT 'word', doc_id, ref, kind, coalesce(n, 0) FROM (
    SELECT d.doc_id, d.ref, k.kind, c.n FROM d CROSS JOIN (SELECT unnest(range(0, 17)) AS kind) k
    LEFT JOIN common c ON c.doc_id = d.doc_id AND c.kind = k.kind)),
own AS (SELECT what, doc_id, ref, kind, n / nullif(sum(n) OVER (PARTITION BY what, doc_id), 0) AS p FROM counted),
reference AS (
  SELECT what, ref, kind, sum(n) / nullif(sum(sum(n)) OVER (PARTITION BY what, ref), 0) AS q FROM counted GROUP BY what, ref, kind),
both_ AS (SELECT what, doc_id, coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM own JOIN reference USING (what, ref, kind)),
far AS (
  SELECT what, doc_id, sqrt(greatest(sum((CASE WHEN p > 0 THEN p * log2(p * 2 / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q * 2 / (p + q)) ELSE 0 END) / 2), 0)) AS x FROM both_ GROUP BY what, doc_id),
rules AS (
  SELECT d.doc_id, t, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM rules)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (n_words < 50 OR len(t) < 200
    OR (c.x <= 0.3 + sqrt(6 / (5.5 * greatest(len(t), 1))) AND v.x <= 0.32 + sqrt(16 / (5.5 * greatest(n_words, 1))))) AS kept
FROM judged JOIN far c USING (doc_id) JOIN far v USING (doc_id) WHERE c.what = 'class' AND v.what = 'word'
""")
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.quality(_read(spark, sf, "documents"))
    return found.drop("class_distance", "word_distance")


@query()
def op6_languages(spark: SparkSession, sf: str) -> DataFrame:
    return language.languages(_read(spark, sf, "documents"))


@query()
def op5_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.extracted(_read(spark, sf, "pages"))


@query()
def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judged(_read(spark, sf, "pages")).drop("margin")


@query(r"""
WITH m AS (
  SELECT doc_id, regexp_extract_all(text, '[\s\x0b]*(?:[^\s\x0b.!?][^\n.!?]*(?:[.!?]+[^\s\x0b.!?][^\n.!?]*)*[.!?]*|[.!?]+(?:[^\s\x0b.!?][^\n.!?]*(?:[.!?]+[^\s\x0b.!?][^\n.!?]*)*[.!?]*)?)') AS parts
  FROM documents),
part AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS no, unnest(parts) AS part FROM m),
unit AS (
  SELECT doc_id, no, regexp_replace(regexp_replace(part, '^[\s\x0b]+', ''), '[\s\x0b]+$', '') AS body,
    coalesce(sum(len(part)) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + len(part) - len(regexp_replace(part, '^[\s\x0b]+', '')) AS start
  FROM part),
words AS (SELECT doc_id, no, start, start + len(body) AS stop, string_split_regex(lower(body), '[\s\x0b]+') AS w FROM unit),
ranked AS (
  SELECT *, first_value(doc_id) OVER same AS first_doc, first_value(start) OVER same AS first_start FROM words
  WINDOW same AS (PARTITION BY w ORDER BY doc_id, start)),
later AS (
  SELECT *, no - row_number() OVER (PARTITION BY doc_id ORDER BY no) AS run FROM ranked
  WHERE doc_id <> first_doc OR start <> first_start)
SELECT doc_id, min(start)::INTEGER AS start, max(stop)::INTEGER AS "end", sum(len(w))::BIGINT AS n_words, count(*) AS n_units,
  min(first_doc) AS first_doc_id, count(DISTINCT first_doc) AS n_first_docs
FROM later GROUP BY doc_id, run HAVING sum(len(w)) >= 25
""")
def op3_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return _with_first(repeats.repeated_spans(_read(spark, sf, "documents")))


@query(r"""
WITH m AS (SELECT doc_id, regexp_extract_all(text, '[\s\x0b]*[^\s\x0b][^\n]*') AS parts FROM documents),
part AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS no, unnest(parts) AS part FROM m),
unit AS (
  SELECT doc_id, no, regexp_replace(regexp_replace(part, '^[\s\x0b]+', ''), '[\s\x0b]+$', '') AS body,
    coalesce(sum(len(part)) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      + len(part) - len(regexp_replace(part, '^[\s\x0b]+', '')) AS start
  FROM part),
words AS (SELECT doc_id, no, start, start + len(body) AS stop, string_split_regex(lower(body), '[\s\x0b]+') AS w FROM unit),
ranked AS (
  SELECT *, first_value(doc_id) OVER same AS first_doc, first_value(start) OVER same AS first_start FROM words
  WINDOW same AS (PARTITION BY w ORDER BY doc_id, start)),
later AS (
  SELECT *, no - row_number() OVER (PARTITION BY doc_id ORDER BY no) AS run FROM ranked
  WHERE doc_id <> first_doc OR start <> first_start)
SELECT doc_id, min(start)::INTEGER AS start, max(stop)::INTEGER AS "end", sum(len(w))::BIGINT AS n_words, count(*) AS n_units,
  min(first_doc) AS first_doc_id, count(DISTINCT first_doc) AS n_first_docs
FROM later GROUP BY doc_id, run
""")
def op3_repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _with_first(repeats.repeated_lines(_read(spark, sf, "documents")))


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
g AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
    ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM g),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
    coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN len(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
""")
def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    found = infill.filled_in(_read(spark, sf, "documents"))
    digests = [
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    ]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query()
def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.spelling_variants(_read(spark, sf, "documents"), thinned=97)


@query()
def op12_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.personal(_read(spark, sf, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
