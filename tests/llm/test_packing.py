import random
import zlib

import numpy as np
import pytest

from racestream.llm import packing
from racestream.llm.tokens import WordIds, vocabulary_path

from .fixtures import messy, messy_rows, with_clashes


def test_ids_equal_the_tokenizer():
    ids, rng = WordIds(vocabulary_path()), random.Random(5)
    signs = "aZé ÉàΣσςİı̇'ds1٣½²中あ한‘’“…–,.!#$%&()<|>'ll're　\t\x0b\x1c\x85Åǻ̈ßﬁǅ\U0001f600‍﻿\x00"
    for _ in range(3000):
        s = "".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) + rng.choice(["", "", " <|endoftext|>"])
        want = ids.tokenizer.encode(s, add_special_tokens=False).ids
        assert np.frombuffer(ids.text_ids(s.encode()), "<u4").tolist() == want, repr(s)


def check(out, texts, capacity):
    """Pieces of every document in order, sequences gapless and not over-full; the number of sequences."""
    ids = WordIds(vocabulary_path())
    want, got = [], []
    for t in texts:
        full = ids.text_ids((t or "").encode()) + b"\1\0\0\0"
        want += [(k, a // 4, len(full[a:a + 4 * capacity]) // 4, zlib.crc32(full[a:a + 4 * capacity]))
                 for k, a in enumerate(range(0, len(full), 4 * capacity))]
    used = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
        got.append((r.piece, r.start, r.length, r.ids_crc32))
    assert sorted(got) == sorted(want) and max(used.values(), default=0) <= capacity
    return len(used)


def test_messy_rows_and_clashing_names(spark):
    docs = with_clashes(messy(spark))
    out = packing.pack_documents(docs, ["doc_id", "uid", "length"])
    rows = out.collect()
    assert check(rows, [r[1] for r in messy_rows()], 4096) == -(-sum(r.length for r in rows) // 4096)
    assert {r.row.uid for r in rows} == {"x"}
    assert packing.pack_documents(docs.limit(0), ["doc_id"]).collect() == []


def test_many_cells_and_repacking(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_PIECES", 40)
    rng = random.Random(2)
    texts = [" ".join("ab" for _ in range(rng.randint(0, 150))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(docs, ["doc_id"], capacity=100, with_ids=True)
    n = check(rows.collect(), texts, 100)
    bound = -(-sum(r.length for r in rows.collect()) // 100)
    assert n <= 1.06 * bound + 1
    # round trip: every document's ids come back from the sequences
    ids = {r.sequence_id: r.ids for r in packing.sequences(rows).collect()}
    parts = {}
    for r in rows.collect():
        parts.setdefault(r.row.doc_id, []).append((r.piece, ids[r.sequence_id][r.offset:r.offset + r.length]))
    whole = WordIds(vocabulary_path())
    for i, t in enumerate(texts):
        assert sum((p for _, p in sorted(parts[i])), []) == np.frombuffer(whole.text_ids(t.encode()), "<u4").tolist() + [1]


@pytest.mark.parametrize("seed", range(5))
def test_evolution_is_valid_and_never_worse_than_its_elites(seed):
    rng = random.Random(seed)
    size = [rng.randint(1, 70) for _ in range(120)]
    elite = [[x] for x in range(120)]
    bins = packing.evolve(size, [elite], seed, 100)
    assert sorted(x for b in bins for x in b) == list(range(120))
    assert all(sum(size[x] for x in b) <= 100 for b in bins)
    fitness = lambda b: packing._fitness(b, size, 100)
    assert fitness(packing.evolve(size, [bins], seed + 1, 100)) >= fitness(bins)
    child = packing._crossover(bins, elite, size, 100, rng)
    assert sorted(x for b in child for x in b) == list(range(120))


def best_fit(size, capacity):
    return packing._packed([], list(range(len(size))), size, capacity)


def test_generations_beat_best_fit_where_it_misses_the_bound():
    """Islands with migration, as the operator runs them, against plain best fit decreasing."""
    plain = evolved = bound = 0
    counted = packing.Counter()
    for seed in range(10):
        rng = random.Random(seed)
        size = [rng.randint(20, 70) for _ in range(300)]
        elites = [packing.evolve(size, [], 2 * seed + i, 100, counted) for i in (0, 1)]
        elites = [packing.evolve(size, e, 2 * seed + i, 100, counted) for i, e in enumerate([elites, elites[::-1]])]
        own = max(elites, key=lambda b: packing._fitness(b, size, 100))
        assert sorted(x for b in own for x in b) == list(range(300)) and max(sum(size[x] for x in b) for b in own) <= 100
        assert len(own) <= len(best_fit(size, 100))
        plain, evolved, bound = plain + len(best_fit(size, 100)), evolved + len(own), bound - (-sum(size) // 100)
    assert counted["crossovers"] > 300 and bound <= evolved < plain


def test_evolution_goes_on_at_the_bound_until_one_bin_is_loose():
    rng = random.Random(1)
    size = [min(4095, int(rng.lognormvariate(5.5, 1)) + 1) for _ in range(500)]
    plain, counted = best_fit(size, 4096), packing.Counter()
    best = packing.evolve(size, [], 1, counted=counted)
    assert len(plain) == len(best) == -(-sum(size) // 4096) and counted["crossovers"] == packing.GENERATIONS
    assert packing._fitness(best, size, 4096) >= packing._fitness(plain, size, 4096)
    # nothing is left to improve where all bins are full
    assert len(packing.evolve([50, 50, 25, 75, 10], [], 1, 100, counted)) == 3 and counted["crossovers"] == packing.GENERATIONS


def test_pieces_that_fill_no_bin_end_after_a_pass(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_PIECES", 20)
    pieces = spark.createDataFrame([(i, 60 if i % 9 else 40) for i in range(200)], "id long, length long")
    rows = packing.pack(pieces, 100).collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert len(rows) == 200 and len(used) <= 190 and max(used.values()) == 100


def test_words_of_a_large_vocabulary_are_encoded_once(monkeypatch):
    from racestream.llm import tokens

    asked = []
    monkeypatch.setattr(tokens.WordIds, "_ids", lambda self, chunk: asked.append(chunk) or b"")
    ids = tokens.WordIds(tokens.vocabulary_path())
    words = b" ".join(b"w%d" % i for i in range(300_000))
    for _ in range(2):
        ids.text_ids(words)
    assert len(asked) == 300_000


def test_lower_case_letters_are_their_own_lower_case():
    from racestream.llm.tokens import _letters

    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            assert _letters(f"a{c}") in ("", f"a{c.lower()}"), hex(i)
