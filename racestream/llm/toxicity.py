"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, homoglyphs to Latin letters, digits and signs
that stand for letters to those letters, everything else to single spaces. A
lexicon entry is the start of a word; one Aho-Corasick automaton finds all
entries and all exception phrases of a text in one pass. A hit inside an
exception phrase does not count. The score is a logistic function of the summed
weights and of their density (sum by text length).

Learned from at most ``SAMPLE`` labelled rows (chosen by a hash of the id):

* *entries*: word starts of ``STARTS`` letters (shorter words whole) that occur in
  a minimum share of the toxic rows, at least ``MIN_LIFT`` times as often (in log
  odds) as in the others, more often than chance would have it, and after several different words, so that copies of
  one passage do not make entries. Of nested entries the longest that still has
  nearly all occurrences stays. The weight is the log odds ratio;
* *exceptions*: two-word phrases around an entry that are rather found in clean rows;
* the logistic weights, by ridge-regularised Newton steps.

Defined results: a null or empty text has no hits and gets the score of a text
without hits; without labels of both kinds nothing is learned and every score
is the share of toxic labels (0 without labels). Repeated label rows of an id
count once (the larger label); null labels are not used.
"""

from __future__ import annotations

import re
from collections import Counter
from math import exp, log, log1p

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, fold, map_text, release_kept, table

SAMPLE = 50_000
STARTS = range(4, 11)
MIN_LIFT = 3.0
#: nats by which an entry's toxic share must beat chance (Chernoff): one in a million
MIN_EVIDENCE = 13.8
MIN_SHARE, MIN_DOCS, MIN_NEIGHBOURS = 0.005, 4, 4
THRESHOLD = 0.7
_FLUSH = 300_000

# Letters that look like Latin ones, and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"

_FOLD = str.maketrans({**HOMOGLYPHS, **SUBSTITUTIONS, **dict.fromkeys(INVISIBLE, None)})
_GAP = re.compile(r"[\W_]+")


def folded(text: bytes | None) -> str:
    """Words with one space before and after each; empty for a text without words."""
    words = _GAP.sub(" ", text.decode().lower().translate(_FOLD)).strip() if text else ""
    return f" {words} " if words else ""


def _starts(words: list[str]):
    """(term, word before) of every word: its starts, or the whole word if it is short."""
    before = ""
    for w in words:
        if len(w) < STARTS[0]:
            yield f" {w} ", before
        else:
            for n in STARTS:
                if n > len(w):
                    break
                yield f" {w[:n]}", before
        before = w


class Lexicon:
    """Entries with weights, exception phrases, and the automaton over both."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], coefficients: list[float]):
        self.weights, self.exceptions, self.coefficients = weights, exceptions, coefficients
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries that no exception phrase covers."""
        import ahocorasick

        if not text or not self.weights:
            return []
        if self._automaton is None:
            automaton = ahocorasick.Automaton()
            for phrase in self.exceptions:
                automaton.add_word(phrase, (len(phrase), None))
            for term, weight in self.weights.items():
                automaton.add_word(term, (len(term), weight))
            automaton.make_automaton()
            self._automaton = automaton
        found, excused = [], []
        for end, (n, weight) in self._automaton.iter(text):
            (excused if weight is None else found).append((end + 1 - n, end + 1, weight))
        if excused:
            found = [h for h in found if not any(s <= h[0] and h[1] <= e for s, e, _ in excused)]
        return found

    def features(self, text: str) -> tuple[float, float]:
        weight = sum(h[2] for h in self.hits(text))
        return log1p(weight), log1p(100 * weight / (text.count(" ") + 10))

    def score(self, text: str) -> float:
        a, b, c = self.coefficients
        x, y = self.features(text)
        return 1 / (1 + exp(-max(-500.0, min(500.0, a + b * x + c * y))))


def _pieces(batches, columns: int):
    release_kept()
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield [part.column(i).to_pylist() for i in range(columns)]


def _term_counts(wanted):
    """Rows term, n, neighbours (bit mask of hashed words before) over the texts; only wanted terms, if given."""
    import pyarrow as pa
    import xxhash

    def run(batches):
        terms = wanted.value if wanted else None
        counts: dict[str, list] = {}

        def rows():
            return pa.RecordBatch.from_arrays([
                pa.array(list(counts), pa.string()), pa.array([v[0] for v in counts.values()], pa.int64()),
                pa.array([v[1] for v in counts.values()], pa.int64())], ["term", "n", "neighbours"])

        for (texts,) in _pieces(batches, 1):
            for t in texts:
                mine: dict[str, int] = {}
                for term, before in _starts(folded(t).split()):
                    if terms is None or term in terms:
                        mine[term] = mine.get(term, 0) | 1 << (xxhash.xxh3_64_intdigest(before) & 31)
                for term, mask in mine.items():
                    v = counts.setdefault(term, [0, 0])
                    v[0] += 1
                    v[1] |= mask
            if len(counts) > _FLUSH:
                yield rows()
                counts = {}
        if counts:
            yield rows()
    return run


def _phrases(shared):
    """Rows phrase, toxic, clean: documents with each two-word phrase around a hit."""
    import pyarrow as pa

    def run(batches):
        lexicon = shared.value
        toxic, clean = Counter(), Counter()
        for texts, labels in _pieces(batches, 2):
            for t, label in zip(texts, labels):
                text, mine = folded(t), set()
                for start, end, _ in lexicon.hits(text):
                    stop = text.index(" ", end - 1)
                    back = text.rfind(" ", 0, start)
                    if back >= 0:
                        mine.add(text[back:stop + 1])
                    ahead = text.find(" ", stop + 1)
                    if ahead >= 0:
                        mine.add(text[start:ahead + 1])
                (toxic if label else clean).update(mine)
        names = list(toxic | clean)
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()),
            pa.array([clean[x] for x in names], pa.int64())], ["phrase", "toxic", "clean"])
    return run


def _lift(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return log((toxic + 0.5) / (n_toxic + 1)) - log((clean + 0.5) / (n_clean + 1))


def _evidence(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """n * KL(toxic share || share of all toxic rows): minus the log of how likely chance gives as much."""
    n, p = toxic + clean, n_toxic / (n_toxic + n_clean)
    q = toxic / n
    if q <= p:
        return 0.0
    return toxic * log(q / p) + (clean * log((1 - q) / (1 - p)) if clean else 0.0)


def choose_entries(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """{term: weight} from {term: (toxic, clean)}: strong terms, of nested ones the longest that keeps the occurrences."""
    strong = {t: w for t, (a, b) in counts.items() if (w := _lift(a, b, n_toxic, n_clean)) >= MIN_LIFT
              and _evidence(a, b, n_toxic, n_clean) >= MIN_EVIDENCE}
    chosen: dict[str, float] = {}
    for term in sorted(strong, key=lambda t: (len(t), t)):
        if any(term[:n] in strong for n in range(STARTS[0] + 1, len(term))):
            continue  # a shorter start decides
        while True:
            longer = [t for t in strong if len(t) == len(term) + 1 and t.startswith(term)
                      and sum(counts[t]) >= 0.95 * sum(counts[term])]
            if not longer:
                break
            term = longer[0]
        chosen[term] = strong[term]
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> list[float]:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def learn_lexicon(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Lexicon:
    """From ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); at most ``sample`` labels are used."""
    spark = docs.sparkSession
    chosen = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select("doc_id", F.col(f"`{text}`").cast("binary").alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("text", "toxic"))  # at most `sample` ids
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        return Lexicon({}, [], [-500.0 if not share else 500.0, 0.0, 0.0])

    schema = "term string, n long, neighbours long"
    support = max(MIN_DOCS, MIN_SHARE * n_toxic)

    def counted(part, wanted=None):
        return (part.select("text").mapInArrow(_term_counts(wanted), schema).groupBy("term")
                .agg(F.sum("n").alias("n"), F.bit_or("neighbours").alias("m")))

    # at most the sampled rows' terms over the support
    toxic = {r["term"]: r["n"] for r in counted(rows.where("toxic = 1")).where(
        (F.col("n") >= support) & (F.bit_count("m") >= MIN_NEIGHBOURS)).collect()}
    wanted = spark.sparkContext.broadcast(frozenset(toxic))
    clean = {r["term"]: r["n"] for r in counted(rows.where("toxic = 0"), wanted).collect()}
    weights = choose_entries({t: (n, clean.get(t, 0)) for t, n in toxic.items()}, n_toxic, n_clean)

    first = spark.sparkContext.broadcast(Lexicon(weights, [], [0.0, 0.0, 0.0]))
    phrases = (rows.mapInArrow(_phrases(first), "phrase string, toxic long, clean long").groupBy("phrase")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("clean >= 3").collect())
    exceptions = [r["phrase"] for r in phrases if _lift(r["toxic"], r["clean"], n_toxic, n_clean) < 0]

    second = spark.sparkContext.broadcast(Lexicon(weights, exceptions, [0.0, 0.0, 0.0]))

    def features():
        lexicon = second.value
        return lambda texts: list(zip(*[lexicon.features(folded(t)) for t in texts])) or [[], []]

    points = map_text(rows, "text", ["toxic"], features, "x double, y double").select("row.toxic", "x", "y").toArrow()
    data = points.to_pandas()  # at most `sample` rows of three numbers
    return Lexicon(weights, exceptions, _logistic(data[["x", "y"]].to_numpy(), data.toxic.to_numpy(float)))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text") -> DataFrame:
    """``row`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        score = shared.value.score
        return lambda texts: ([score(folded(t)) for t in texts],)
    return map_text(docs, text, keep, make, "score double")


def training_labels(spark, sf_dir: str) -> DataFrame:
    """The labels that may be learned from: fold 1 of 3 is held out."""
    return table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1).select("doc_id", "toxic")


def q_op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn_lexicon(docs, training_labels(spark, sf_dir))
    return score_toxicity(docs, lexicon, ["doc_id"]).select(
        "row.doc_id", (fold(F.col("row.doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
