import random
import re

from racestream.llm import pii

from .fixtures import DOCS, doc, messy, with_clashes, words

# the formats as they are stated
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = [True, all(int(x) <= 255 for x in m[0].split(".")) if kind == 1 else True,
                    16 <= len(digits) <= 19 and pii.luhn(digits), 8 <= len(digits) <= 15][kind]
            if fine:
                out.append((kind, *m.span()))
    return out


def test_base_against_the_stated_patterns():
    rng = random.Random(8)
    samples = ["a@b.c", "x.y%z@mail.example.com", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
               "4111-1111-1111-1111", "+1 (234) 555-6789", "+12", "@", ".", "-", " ", "+", "é", "7", "a", "00000000000000000",
               "@x.y", "a@b", "a@b.c_d@e.f", "\n", "256.1.1.1", "0255.1.1.1"]
    for _ in range(20_000):
        text = "".join(rng.choice(samples) for _ in range(rng.randint(1, 7)))
        assert pii.base_spans(text) == brute(text), repr(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def bootstrap_rows():
    rng = random.Random(6)
    rows = []
    for i in range(60):
        w = words(rng, 30)
        if i < 40:
            w[10:10] = ["Call", "Desk:", f"+1 (555) 010-{1000 + i}"]
        elif i < 50:
            w[10:10] = ["call", "desk:", f"ext-{7000 + i},"]
        rows.append(doc(i, " ".join(w)))
    return rows


def test_confident_patterns_discover_what_formats_miss(spark):
    docs = spark.createDataFrame(bootstrap_rows(), DOCS)
    patterns = pii.learn_patterns(docs)
    assert patterns["call desk:"][0] == 3 and patterns["call desk:"][1] >= pii.CONFIDENT
    found = {r.doc_id: r for r in pii.extract(docs, ["doc_id"], patterns, redact=True)
             .select("row.doc_id", "spans", "redacted").collect()}
    for i, text, *_ in bootstrap_rows():
        spans = [(s.kind, text[s.start:s.end], s.base) for s in found[i].spans]
        if i < 40:
            assert spans == [(3, f"+1 (555) 010-{1000 + i}", True)]
        elif i < 50:
            assert spans == [(3, f"ext-{7000 + i}", False)] and "[PHONE]," in found[i].redacted
        else:
            assert spans == [] and found[i].redacted == text


def test_support_does_not_grow_with_the_seeds(spark, monkeypatch):
    """Six numbers make a pattern beside 70,000 others, also in passes of few patterns."""
    monkeypatch.setattr(pii, "PASS_PATTERNS", 1, raising=False)
    many = [doc(i, " ".join(f"+1 555 {100_0000 + 700 * i + j} w" for j in range(700))) for i in range(100)]
    few = [doc(1000 + i, f"please ring +44 20 7946 {1000 + i} x") for i in range(6)]
    patterns = pii.learn_patterns(spark.createDataFrame(many + few, DOCS))
    assert patterns["please ring"][0] == 3 and patterns["w"][0] == 3


def test_candidates_cross_spaces():
    patterns = {"call": (3, 0.9), "card:": (2, 0.9)}

    def found(text):
        return [(k, text[s:e]) for k, s, e, base in pii.all_spans(text, patterns) if not base]

    assert found("call (017) 555-7713, please") == [(3, "(017) 555-7713")]
    assert found("call 0171 555 7713.") == [(3, "0171 555 7713")]
    assert found("card: 4111 1111 1111 1112 x") == [(2, "4111 1111 1111 1112")]
    assert found("call 01715 557713 4x now") == [(3, "01715 557713")]
    assert found("call 12345 1.2.3.4") == [(3, "12345")]
    assert found("call 12 34 x") == [] and found("call ext-7000, 5") == [(3, "ext-7000")]
    assert found("see 0171 555 7713") == []
    patterns["line 2"] = (3, 0.9)
    assert found("line 2 01715557713") == [(3, "01715557713")]


def test_spaced_numbers_are_unseen_instances_of_their_pattern():
    import pyarrow as pa
    from types import SimpleNamespace

    batch = pa.RecordBatch.from_arrays([pa.array([b"call (017) 555-7713 now", b"call 0171 555 7713"])], ["text"])
    rows = [r for b in pii._followers(SimpleNamespace(value=frozenset(["call"])))([batch]) for r in b.to_pylist()]
    assert sorted((r["kind"], r["instance"], r["n"]) for r in rows) == [(-1, "(017) 555-7713", 1), (-1, "0171 555 7713", 1)]


def test_common_words_are_no_patterns(spark):
    rows = [doc(i, f"the the the the a@b{i}.com the the") for i in range(50)]
    assert pii.learn_patterns(spark.createDataFrame(rows, DOCS)) == {}


def test_messy_rows_and_clashing_names(spark):
    docs = with_clashes(messy(spark))
    assert pii.learn_patterns(docs) == {}
    out = pii.extract(docs, docs.columns, {}, redact=True)
    assert out.select("row.*").columns == docs.columns
    rows = out.select("row.text", "redacted", "spans").collect()
    assert len(rows) == 13 and all(r.text == r.redacted and r.spans == [] for r in rows)
    assert pii.extract(docs.limit(0), ["doc_id"], {}).count() == 0 and pii.learn_patterns(docs.limit(0)) == {}


def test_overlapping_spans_are_replaced_once():
    text = "to +1 4111 1111 1111 1111 end"
    spans = [(2, 6, 25, True), (3, 3, 25, True)]
    assert pii.redacted(text, spans) == "to [PHONE] end"


def test_span_text(spark):
    docs = spark.createDataFrame([doc(1, "é 1.2.3.4 a@b.c 9.9.9.9"), doc(2, None)], DOCS)
    rows = pii.extract(docs, ["doc_id"], {}).select("row.doc_id", pii.span_text("spans").alias("s")).collect()
    assert {r.doc_id: r.s for r in rows} == {1: "email:10:15,ip:2:9,ip:16:23", 2: ""}


def test_seeds_in_brackets_and_behind_names(spark):
    """The word before counts, whatever brackets or name stand between, however long it is."""
    long = "x" * 300
    rows = [doc(i, f"contact mail <user{i}@site{i}.org> {i % 3}a") for i in range(20)]
    rows += [doc(100 + i, f"{long} +1 555 010 {1000 + i} q{i}") for i in range(20)]
    rows += [doc(200 + i, f'w{i} tel:+44 20 7946 {1000 + i}, r{i}') for i in range(20)]
    patterns = pii.learn_patterns(spark.createDataFrame(rows, DOCS))
    assert patterns["mail"][0] == patterns["contact mail"][0] == 0
    assert patterns[long][0] == 3 and patterns["tel:"][0] == 3

    def found(text):
        return [(k, text[s:e]) for k, s, e, base in pii.all_spans(text, patterns) if not base]

    assert found("mail [joe-at-site9]") == [(0, "joe-at-site9")] and found("see tel:0171-555-77, x") == [(3, "0171-555-77")]
    assert found(long + "x 12345678") == []


def test_contexts_behind_and_on_both_sides(spark):
    rng = random.Random(3)
    rows = [doc(i, f"{' '.join(words(rng, 5))} 10.0.{i}.7 hostaddr") for i in range(30)]
    rows += [doc(100 + i, f"q{i} from +1 555 010 {1000 + i} home from the home from here") for i in range(30)]
    rows += [doc(200 + i, " ".join(words(rng, 20))) for i in range(10)]
    patterns = pii.learn_patterns(spark.createDataFrame(rows, DOCS))
    assert patterns["\thostaddr"][0] == 1 and "from" not in patterns and "from\thome" not in patterns
    assert [t[:3] for t in pii.all_spans("zz node-0017 hostaddr", patterns)] == [(1, 3, 12)]


def test_keys_are_found_by_their_patterns_alone(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(12)]
    rows = [doc(i, f'{" ".join(words(rng, 4))} token = "{k}" {" ".join(words(rng, 4))}') for i, k in enumerate(keys)]
    rows.append(doc(50, f"hash {keys[0]} end"))
    rows.append(doc(51, 'and token = "Zq-77.Kx/19" end'))
    docs = spark.createDataFrame(rows, DOCS)
    patterns = pii.learn_patterns(docs)
    assert patterns["token ="][0] == pii.SEED_KINDS.index("secret")
    got = {r.doc_id: r for r in pii.extract(docs, ["doc_id"], patterns, redact=True)
           .select("row.doc_id", "redacted", pii.span_text("spans").alias("s")).collect()}
    for i, k in enumerate(keys):
        at = rows[i][1].index(k)
        assert got[i].s == f"secret:{at}:{at + 40}" and 'token = "[SECRET]"' in got[i].redacted
    assert got[50].s == "" and got[51].redacted == 'and token = "[SECRET]" end'


def test_counts_of_a_pattern_are_everything_that_stands_in_it():
    """Against a plain count: one row more per word in a pattern, an instance of several words once."""
    import pyarrow as pa
    from types import SimpleNamespace

    rng = random.Random(9)
    parts = ["a", "b", "a.", "(b", "1.2.3.4", "<a@b.cd>", "+1 (555) 010-1000", "x12345", "0171 555 7713", "!"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    patterns = frozenset(["a", "b", "a b", "b a", "\ta", "\tb", "a\tb", "b\tb"])
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts])], ["text"])
    rows = [r for out in pii._followers(SimpleNamespace(value=patterns))([batch]) for r in out.to_pylist()]
    assert all(r["n"] > 0 for r in rows)
    total = dict.fromkeys(patterns, 0)
    for t in texts:
        w = [x for x in (pii._word(y) for y in t.split()) if x]
        for i in range(len(w)):
            for p in ([w[i - 1]] if i else []) + ([f"{w[i - 2]} {w[i - 1]}"] if i > 1 else []) + (
                    ["\t" + w[i + 1]] if i + 1 < len(w) else []) + ([f"{w[i - 1]}\t{w[i + 1]}"] if 0 < i < len(w) - 1 else []):
                if p in total:
                    total[p] += 1
    for p in patterns:
        got = sum(r["n"] for r in rows if r["pattern"] == p)
        assert got == total[p] if "\t" not in p[1:] else got >= total[p], p


def test_invalid_bytes_and_very_long_texts(spark):
    text = ("a@b.cd 1.2.3.4 " * 20_000) + "x" * 500_000
    docs = spark.createDataFrame([(1, bytearray(b"\xff a@b.cd \xc3")), (2, bytearray(text.encode()))], "doc_id long, text binary")
    rows = {r.doc_id: r.n for r in pii.extract(docs, ["doc_id"], {"a": (0, 0.9)}).selectExpr("row.doc_id", "size(spans) n").collect()}
    assert rows == {1: 1, 2: 40_000}
