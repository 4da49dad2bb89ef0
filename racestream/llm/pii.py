"""Personal data: bootstrapped contextual extraction.

*Seeds* are the entities that fixed formats find: e-mail, IPv4 address, card with
Luhn check, international phone number, and keys (32 or more hexadecimal digits, letters
among them). Their contexts induce lexical *patterns*: the word before, the two words
before, the word after, the words on both sides. Patterns and the *instances* that
stand in them form a weighted bipartite graph over the whole corpus, which Spark
scores in rounds:

* a pattern's confidence for a kind is the weighted share of *everything* that
  stands in it that is an instance of that kind (so "the" stays near 0);
* an instance that no format found gets the noisy-or of its patterns' confidences;
* in the next round such instances count for the patterns they stand in.

Patterns of high confidence then discover identifiers that the formats miss: a
token with a digit or @ and of at least ``MIN_LENGTH`` characters, or
the run of digit groups and separators that starts there, spaces included, of at
least ``MIN_LENGTH`` digits. Keys are no base spans: they count only as seeds, and are
found (as kind ``secret``) only where a pattern says so.
A pattern needs ``MIN_SEEDS`` distinct seeds as support, at every size of the
corpus. What stands in the patterns is counted in passes of about ``PASS_PATTERNS``
of them; the confident ones are collected and broadcast.

Tokens are split at ASCII white space, and behind a name with a colon or equals sign
(``tel:``, but not ``http://``). Brackets, quotes and commas around a token belong to neither
the word nor the instance, so ``mail <a@b.org>`` has the context ``mail``.

Spans are in code points, end exclusive. Matches are leftmost and do not overlap
within a kind; one that fails its test is dropped without a retry. Discovered
spans never overlap others; base spans always stay.

Defined results: a null or empty text has no spans; repeated rows are extracted
(and counted) each; without seeds or confident patterns only formats count; invalid
UTF-8 is read with replacement characters. A text is read whole, however long, one at a
time, in time near linear in its length. Input columns travel in the struct ``row``, so
their names never clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, materialise, slices, table

# The kinds, in their order.
KINDS = ["email", "ip", "card", "phone"]
#: kinds of seeds: those of the formats, and keys, whose spans come through patterns alone
SEED_KINDS = [*KINDS, "secret"]
MIN_SEEDS, PASS_PATTERNS = 5, 200_000
CONFIDENT, ROUNDS = 0.8, 3
MIN_LENGTH = 5
_FLUSH = 200_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN_END = re.compile(r"[\x20\x09-\x0D.,;!?()\[\]{}<>\"']")
_TOKEN = re.compile(r"[A-Za-z]{2,}+[:=](?![\x20\x09-\x0D/])|[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")
_KEY = re.compile(r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,}+(?![A-Za-z0-9])")
_RUN = re.compile(r"\+?\(?[0-9](?:[\x20().-]*+[0-9])*+")
_EDGE = ".,;!?()[]{}<>\"'"
_BEFORE_RUN = _EDGE.replace("(", "")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str):
    """Every @ is tried once: the run of name characters before it, the domain after it."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def _octets(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in match.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _digits(match: str) -> str:
    return "".join(_DIGIT.findall(match))


def _card(match: str) -> bool:
    digits = _digits(match)
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) that the formats find, by kind and start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(1, *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
        out += [(2, *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and _card(m[0])]
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


class _Spans:
    """The spans of a text, for questions that take no pass over all of them."""

    def __init__(self, spans):
        by_start = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in by_start]
        self.reach = list(accumulate((e for _, e in by_start), max))

    def next_start(self, at: int, end: int) -> int:
        """The first start behind ``at``, ``end`` if that comes before."""
        i = bisect_right(self.starts, at)
        return min(end, self.starts[i]) if i < len(self.starts) else end

    def meets(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.reach[i - 1] > start


def seed_spans(text: str, base) -> list[tuple[int, int, int]]:
    """The base spans, then keys that meet none of them."""
    taken = _Spans(base)
    keys = [(len(KINDS), *m.span()) for m in _KEY.finditer(text)
            if _DIGIT.search(m[0]) and not m[0].isdigit() and not taken.meets(*m.span())]
    return base + keys


def _word(token: str) -> str:
    return token.strip(_EDGE).lower()


class _Tokens:
    """Tokens of a text that hold more than brackets and marks: where their words start and end, and the words."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends, self.words = text, [], [], []
        for m in _TOKEN.finditer(text):
            token = m[0]
            bare = token.lstrip(_EDGE)
            if bare:
                self.starts.append(m.end() - len(bare))
                self.ends.append(m.end())
                self.words.append(bare.rstrip(_EDGE).lower())

    def contexts(self, i: int, end: int) -> tuple[list[str], int]:
        """The patterns around the instance from token i to the place ``end``, and the token behind it.
        Words hold no white space: "a b" stands before, "\\tc" behind, "b\\tc" on both sides."""
        w, j = self.words, bisect_left(self.starts, end, i + 1)
        out = [w[i - 1]] if i else []
        if i > 1:
            out.append(w[i - 2] + " " + w[i - 1])
        if j < len(w):
            out.append("\t" + w[j])
            if i:
                out.append(w[i - 1] + "\t" + w[j])
        return out, j

    def marked(self):
        """Tokens that may start an instance."""
        return [i for i, (s, e) in enumerate(zip(self.starts, self.ends)) if _MARK.search(self.text, s, e)]


def _candidate(token: str) -> bool:
    return len(token) >= MIN_LENGTH and ("@" in token or bool(_DIGIT.search(token)))


def _candidate_at(text: str, s: int, e: int, base: _Spans) -> tuple[int, int] | None:
    """The place of the candidate that starts in the token at s (behind its brackets) to e, if there is one.
    A run of digit groups may go on over spaces, up to the next span of a format and never into part of a token."""
    run = _RUN.match(text, s - 1 if s and text[s - 1] == "(" else s)
    if run and run.end() > e:
        start, end = run.span()
        end = base.next_start(start, end)
        if end == run.end() and end < len(text) and not _TOKEN_END.match(text, end):
            end = max(text.rfind(" ", start, end), start)
        end = start + len(text[start:end].rstrip(" ().-"))
        if end > e and len(_digits(text[start:end])) >= MIN_LENGTH:
            return start, end
    e = s + len(text[s:e].rstrip(_EDGE))
    return (s, e) if e > s and _candidate(text[s:e]) else None


def _texts(batches):
    for batch in batches:
        for part in slices(batch, batch.column(0)):
            for t in part.column(0).to_pylist():
                if t:
                    yield t.decode("utf-8", "replace")


def _rows(names, types, counts: Counter):
    import pyarrow as pa

    cols = list(zip(*[(*k, n) for k, n in counts.items() if n])) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _seed_contexts(batches):
    """Rows pattern, kind, instance, n."""
    import pyarrow as pa

    names, types = ["pattern", "kind", "instance", "n"], [pa.string(), pa.int32(), pa.string(), pa.int64()]
    counts: Counter = Counter()
    for text in _texts(batches):
        seeds = seed_spans(text, base_spans(text))
        tokens = _Tokens(text) if seeds else None
        for kind, s, e in seeds:
            i = bisect_left(tokens.starts, s)
            if i < len(tokens.starts) and tokens.starts[i] == s:
                for pattern in tokens.contexts(i, e)[0]:
                    counts[pattern, kind, text[s:e].lower()] += 1
        if len(counts) > _FLUSH:
            yield _rows(names, types, counts)
            counts = Counter()
    yield _rows(names, types, counts)


def _followers(shared):
    """Rows pattern, kind, instance, n: what stands in the given patterns. kind -1: a candidate that no
    format found; kind -2: anything else, without instance."""
    import pyarrow as pa

    names, types = ["pattern", "kind", "instance", "n"], [pa.string(), pa.int32(), pa.string(), pa.int64()]

    def run(batches):
        patterns = shared.value
        behind = {p[1:] for p in patterns if p[0] == "\t"}
        pairs, around = any(" " in p for p in patterns), any("\t" in p[1:] for p in patterns)
        counts, others = Counter(), Counter()
        for text in _texts(batches):
            # every word stands in the patterns around it
            if _MARK.search(text):
                tokens = _Tokens(text)
                w = tokens.words
            else:
                tokens, w = None, [x for t in _TOKEN.findall(text) if (x := t.strip(_EDGE).lower())]
            others.update(filter(patterns.__contains__, w[:-1]))
            if pairs:
                others.update(filter(patterns.__contains__, map(" ".join, zip(w[:-2], w[1:-1]))))
            if around:
                others.update(filter(patterns.__contains__, map("\t".join, zip(w, w[2:]))))
            if behind:
                others.update("\t" + x for x in w[1:] if x in behind)
            if tokens:
                # the instances among them
                spans = base_spans(text)
                known, taken = {s: (k, e) for k, s, e in reversed(seed_spans(text, spans))}, _Spans(spans)
                done = 0
                for i in tokens.marked():
                    s, e = tokens.starts[i], tokens.ends[i]
                    if s < done:
                        continue
                    kind, place = -1, None
                    if s in known:
                        kind, place = known[s][0], (s, known[s][1])
                    else:
                        place = _candidate_at(text, s, e, taken)
                    if not place:
                        continue
                    done = place[1]
                    around_it, j = tokens.contexts(i, done)
                    for p in around_it:
                        if p in patterns:
                            counts[p, kind, text[slice(*place)].lower()] += 1
                            # an instance of several tokens is not among the words with one on both sides
                            if j == i + 1 or "\t" not in p[1:]:
                                others[p] -= 1
            if len(counts) + len(others) > _FLUSH:
                counts.update({(p, -2, ""): n for p, n in others.items()})
                yield _rows(names, types, counts)
                counts, others = Counter(), Counter()
        counts.update({(p, -2, ""): n for p, n in others.items()})
        yield _rows(names, types, counts)
    return run


def learn_patterns(docs: DataFrame, text: str = "text") -> dict[str, tuple[int, float]]:
    """{pattern: (kind, confidence)} of the confident patterns."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{text}`").cast("binary").alias("text"))
    schema = "pattern string, kind int, instance string, n long"
    seeds = materialise(source.mapInArrow(_seed_contexts, schema)
                        .groupBy("pattern", "kind", "instance").agg(F.sum("n").alias("n")), "seeds")
    supported = materialise(seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
                            .where(F.col("seeds") >= MIN_SEEDS).select("pattern").distinct(), "supported")
    passes = -(-supported.count() // PASS_PATTERNS)
    if not passes:
        return {}
    parts = []
    for i in range(passes):
        own = supported.where(F.pmod(F.hash("pattern"), F.lit(passes)) == i).collect()
        shared = spark.sparkContext.broadcast(frozenset(r["pattern"] for r in own))
        parts.append(materialise(source.mapInArrow(_followers(shared), schema)
                                 .groupBy("pattern", "kind", "instance").agg(F.sum("n").alias("n")), "edges"))
    edges = reduce(DataFrame.union, parts)
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    found = edges.where("kind >= 0").groupBy("pattern", "kind").agg(F.sum("n").alias("w"))
    unseen = edges.where("kind = -1").select("pattern", "instance", "n")
    scores = None
    for _ in range(ROUNDS):
        weight = found
        if scores is not None:
            more = unseen.join(scores, "instance").select("pattern", "kind", (F.col("n") * F.col("score")).alias("w"))
            weight = found.union(more).groupBy("pattern", "kind").agg(F.sum("w").alias("w"))
        conf = materialise(weight.join(totals, "pattern").select(
            "pattern", "kind", (F.col("w") / (F.col("total") + 1)).alias("confidence")), "patterns")
        miss = F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))
        scores = (unseen.join(conf, "pattern").groupBy("instance", "kind").agg((1 - F.exp(miss)).alias("score")))
        scores = materialise(scores, "instances")
    best = (conf.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("b"))
            .where(F.col("b.confidence") >= CONFIDENT).collect())
    return {r["pattern"]: (r["b"]["kind"], r["b"]["confidence"]) for r in best}


def all_spans(text: str, patterns: dict) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, found by a format), by kind and start."""
    base = base_spans(text)
    out = [(k, s, e, True) for k, s, e in base]
    if patterns and _MARK.search(text):
        done, taken, tokens = 0, _Spans(base), _Tokens(text)
        for i in tokens.marked():
            s = tokens.starts[i]
            place = _candidate_at(text, s, tokens.ends[i], taken) if s >= done else None
            if not place or taken.meets(*place):
                continue
            known = [patterns[p] for p in tokens.contexts(i, place[1])[0] if p in patterns]
            if known:
                out.append((max(known, key=lambda x: x[1])[0], *place, False))
                done = place[1]
    return sorted(out)


def redacted(text: str, spans) -> str:
    """The text with every span replaced by its kind; overlapping spans by the first one's."""
    out, at = [], 0
    for kind, s, e, _ in sorted(spans, key=lambda x: (x[1], x[0])):
        if s >= at:
            out += [text[at:s], f"[{SEED_KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def extract(docs: DataFrame, keep: list[str], patterns: dict, text: str = "text", redact: bool = False) -> DataFrame:
    """``row``, ``spans`` (kind, start, end, base) and, if asked for, the ``redacted`` text."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def make():
        patterns = shared.value

        def run(texts):
            spans, clean = [], []
            for t in texts:
                text = t.decode("utf-8", "replace") if t else ""
                found = all_spans(text, patterns)
                spans.append([{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in found])
                if redact:
                    clean.append(None if t is None else redacted(text, found) if found else text)
            return (spans, clean) if redact else (spans,)
        return run

    return map_text(docs, text, keep, make, "spans array<struct<kind:int,start:int,end:int,base:boolean>>"
                    + ", redacted string" * redact)


def span_text(spans):
    """kind:start:end of a column of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in SEED_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def q_op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = extract(docs, ["doc_id"], learn_patterns(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found.select("row.doc_id", *[count(k) for k in range(len(KINDS))],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
