"""Filter for web addresses: rules for hosts and paths, and a classifier for the rest.

Names put together without hyphens are split into words by the likeliest segmentation under a
unigram model (Viterbi). Multinomial naive Bayes then scores the words of host and path. It starts
from a few labelled names and learns from the addresses of all pages: each counts for the class it
is judged to be in, and all are judged again until no verdict changes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import map_arrow, stage

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its own.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Labelled names to start from: words of hosts to be blocked, and of ordinary ones.
BLOCKED = (
    "adserver ad-click click-tracker best-poker online-casino slot-jackpot "
    "sports-betting lucky-spin win-prize free-prize buy-viagra cialis-shop diet-pills payday-loan quick-cash "
    "easy-money crypto-giveaway bitcoin-doubler free-money xxx-videos porn-tube adult-cams sex-chat hot-girls nude-pics "
    "escort-dating link-farm seo-spam backlink-shop traffic-bot pop-ads popup-banner ad-banner tracker-pixel tracking-ads "
    "malware-download crack-keygen warez-torrent pirate-movies phishing-login account-verify fake-rolex replica-watches "
    "gambling-bonus roulette-vegas blackjack-bets lottery-winner coupon-spam clickbait-farm content-farm spam-mail"
).split()
ORDINARY = (
    "blog news shop-home city-library open-university state-museum research-lab daily-times health-service school-board "
    "music-review travel-guide garden-club recipe-book weather-report science-journal history-archive public-radio "
    "art-gallery book-store cooking-school forum-help wiki-docs code-hosting developer-tools student-portal sports-club "
    "local-paper village-council history-society nature-park mail-server photo-album film-festival house-garden farm-house "
    "bank-holiday free-software track-record winter-sports car-repair"
).split()
#: Longest word of the unigram model, in letters.
LONGEST = 24
#: Times that all addresses are judged while the classes are learnt, at most.
ROUNDS = 20
#: Part of a class's words that are its own; the others are words that any address has.
OWN = 0.5
_COMMON_HOST = {"www", "com", "org", "net", "example", "m", "html", "htm", "php", "index", "http", "https"}
_RUN = re.compile(r"[^\W\d_]+")
_RUNS = r"[^\p{L}]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of an address; both empty without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        one = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, one).otherwise(found)
    return found


class Segmenter:
    """Splits a run of letters into the likeliest words; ``total`` counts words that are not in ``counts``, too."""

    def __init__(self, counts: Mapping[str, float], total: float | None = None):
        self.total = (sum(counts.values()) if total is None else total) + 1.0
        self.cost = {w: math.log(self.total / n) for w, n in counts.items()}

    def _unknown(self, length: int) -> float:
        """Cost of a word that was never seen: rarer than any seen one, and more so the longer it is."""
        return math.log(self.total) + 3.0 + 1.5 * length

    def split(self, run: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            options = []
            for start in range(max(0, end - LONGEST), end):
                word = run[start:end]
                options.append((best[start] + self.cost.get(word, self._unknown(end - start)), -start))
            cost, start = min(options)
            best.append(cost)
            back.append(-start)
        words, end = [], len(run)
        while end:
            words.append(run[back[end] : end])
            end = back[end]
        return words[::-1]

    def words(self, name: str) -> list[str]:
        return [w for run in _RUN.findall(name.lower()) if run not in _COMMON_HOST for w in self.split(run)]


class Classifier:
    """Multinomial naive Bayes over the words of names; ``block``, ``allow`` and ``every`` count words.

    A class's share of a word is mixed with the share of the word in all names, so that smoothing
    does not depend on how many words there are.
    """

    def __init__(self, block: Mapping[str, float], allow: Mapping[str, float], every: Mapping[str, float]):
        self.block, self.allow, self.every = dict(block), dict(allow), dict(every)
        self.sums = (sum(block.values()), sum(allow.values()), sum(every.values()))

    def margin(self, words: Iterable[str]) -> float:
        """How much likelier, in logarithms, the words are those of a name to be blocked; without any word both
        classes are as likely."""
        total = 0.0
        for w in words:
            if w in self.every:
                shared = (1 - OWN) * self.every[w] / self.sums[2]
                b = OWN * self.block.get(w, 0) / self.sums[0] + shared
                a = OWN * self.allow.get(w, 0) / self.sums[1] + shared
                total += math.log(b / a)
        return total


def _name_words(names: Iterable[str]) -> list[str]:
    return [w for name in names for w in _RUN.findall(name)]


def _segmenter(pages: DataFrame, names: DataFrame) -> Segmenter:
    """Word counts of the titles of all pages, and labelled names.

    Only words that are a part of some run of letters in ``names`` come back to the driver; no other
    word can be a piece of one.
    """
    title = F.lower(F.regexp_extract(F.coalesce(F.col("html").cast("string"), F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1))
    words = pages.select(F.explode(F.split(title, _RUNS)).alias("w")).filter(F.length("w").between(1, LONGEST))
    words = stage(words.groupBy("w").count(), "title_words")
    runs = names.select(F.explode(F.split("name", " ")).alias("run")).filter("run <> ''").distinct()
    at = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("at"))
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("run") - F.col("at") + 1)))
    parts = at.select("run", "at", size.alias("size")).select(F.substring("run", F.col("at"), F.col("size")).alias("w")).distinct()
    counts = {r["w"]: r["count"] for r in words.join(parts, "w", "left_semi").collect()}
    total = words.agg(F.sum("count")).first()[0] or 0
    known = total / 2000 + 1
    for w in _name_words([*BLOCKED, *ORDINARY]):
        counts[w] = counts.get(w, 0) + known
        total += known
    return Segmenter(counts, total)


def _segmented(segmenter: Segmenter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [segmenter.words(name) for name in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), batch.column(1)], ["words", "n"])

    return run


def _tally(classifier: Classifier):
    """Words of the pages of each class, summed up within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        for batch in batches:
            for words, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                side = 0 if classifier.margin(words) > 0 else 1
                for w in words:
                    found.setdefault(w, [0, 0])[side] += n
        sides = [pa.array([c[k] for c in found.values()], pa.int64()) for k in range(2)]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), *sides], ["w", "block", "allow"])

    return run


def fit(pages: DataFrame) -> tuple[Segmenter, Classifier]:
    """Segmenter from titles and labelled names, classifier from labelled names and all addresses.

    The counts of all words of hosts and paths come back to the driver. Verdicts that alternate end
    the learning, and so do ROUNDS of it.
    """
    labelled = [Counter(_name_words(names)) for names in (BLOCKED, ORDINARY)]
    host, path = host_and_path(F.col("url"))
    runs = F.trim(F.regexp_replace(F.lower(F.concat_ws("/", host, path)), _RUNS, " "))
    names = stage(pages.select(runs.alias("name")).groupBy("name").agg(F.count("*").alias("n")), "names")
    segmenter = _segmenter(pages, names)
    addresses = stage(map_arrow(names, _segmented(segmenter), "words array<string>, n bigint"), "addresses")
    words = addresses.select(F.explode("words").alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n"))
    every = labelled[0] + labelled[1] + Counter({r["w"]: r["n"] for r in words.collect()})
    classifier, seen = Classifier(*labelled, every), set()
    for _ in range(ROUNDS):
        found = map_arrow(addresses, _tally(classifier), "w string, block bigint, allow bigint").groupBy("w")
        found = found.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).collect()
        block, allow = (Counter({r["w"]: r[k] for r in found if r[k]}) for k in ("block", "allow"))
        state = hash(frozenset(block.items()))
        if state in seen:
            break
        seen.add(state)
        classifier = Classifier(labelled[0] + block, labelled[1] + allow, every)
    return segmenter, classifier


def _judge(segmenter: Segmenter, classifier: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            margins = []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = []
                for name in (host, path):
                    for part in re.split(r"[./]", name):
                        if part not in known:
                            if len(known) > 200_000:
                                known.clear()
                            known[part] = segmenter.words(part)
                        words += known[part]
                margins.append(classifier.margin(words))
            yield batch.append_column("margin", pa.array(margins, pa.float64()))

    return run


def judged(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row of ``pages`` (``page_id, url, html``): ``page_id, host, path, rule, verdict, margin``.

    The verdict is that of the longest rule that fits, else ``block`` if the words of host and path
    are likelier in a name to be blocked. A null or empty url, or one without ``://``, has an empty
    host and path and is allowed; repeated rows get the same verdict each, a null ``page_id`` is
    kept, other columns are not looked at, and an empty table gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = map_arrow(rows, _judge(*fit(pages)), "page_id bigint, host string, path string, margin double")
    found = rule_of(F.col("host"), F.col("path"), tuple(rules))
    own = F.when(F.col("margin") > 0, F.lit("block")).otherwise(F.lit("allow"))
    rows = rows.withColumn("found", found)
    return rows.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"), "margin"
    )
