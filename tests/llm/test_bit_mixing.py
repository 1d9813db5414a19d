"""Language-model scores: base figures against a plain version, codes, probabilities that add up, held-out bits."""

import itertools
import math
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfstar.llm import bit_mixing as lm, queries

from . import brute
from .test_operators import SF, folder, given, odd_rows  # noqa: F401


def tokens(text):
    return [w.encode().lower() for w in brute.WORDS.findall(text or "")] + [None]


def in_fold(key):
    return None if key is None else zlib.crc32(str(key).encode()) % 7 == 2


def base(rows):
    counts = Counter(w for key, text in rows if in_fold(key) is False for w in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return {(key, text): (in_fold(key) is True, len(tokens(text)), sum(counts[w] > 0 for w in tokens(text)), n,
                          sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(text))) for key, text in rows}


@pytest.mark.parametrize("where", ["odd", "given"])
def test_base_figures_equal_plain_version(spark, odd_rows, folder, where):  # noqa: F811
    rows, root = ([r[:2] for r in odd_rows], folder) if where == "odd" else (given(spark, "documents", "doc_id", "text"), SF)
    got = queries.op12_lm_scores(spark, root).collect()
    want = base(rows)
    told = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got)
    assert told == Counter((key, *want[key, text][:4], round(want[key, text][4], 5)) for key, text in rows)
    sizes = Counter(len((text or "").encode()) for _, text in rows)
    assert all(r["score"] < 0 for r in got) and sum(r["bits_per_byte"] is None for r in got) == sizes[0]
    held = [r for r in got if r["held_out"]]
    if where == "given":
        assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
        texts = dict(rows)
        assert -sum(r["score"] for r in held) / math.log10(2) < 3 * sum(len(texts[r["doc_id"]].encode()) for r in held)


def plain_counts(texts):
    counts = Counter(w or b"" for t in texts for w in tokens(t))
    return [(w, n) for w, n in counts.items()]


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the cat sat", "on a mat", "in the hat", "zebra", f"rare{k}"]) for _ in range(rng.randint(0, 30))) for k in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, word string")
    return docs, lm.fit(docs, table_bytes=600)


def test_words_outside_the_table_are_spelled(small):
    docs, model = small
    codes = model.words.codes
    assert b"the" in codes.table and b"rare7" not in codes.table and codes.others(b"the rare7 RARE7 odd") == {b"rare7": 2, b"odd": 1}
    assert codes.symbols(b"the rare7").tolist() == [codes.table[b"the"], codes.escape, codes.escape - 1]
    assert model.spelling.codes.symbols(b"a\xff").tolist() == [97, 255, 256]


def test_codes_are_complete_and_shorter_for_frequent_symbols():
    counts = [50, 1, 7, 7, 0, 20]
    codes = lm.Codes(counts, ((), (1,)), 64)
    assert sum(2.0 ** -int(n) for n in codes.lengths) == 1
    paths = {tuple(codes.steps[s : s + n] & 1) for s, n in zip(codes.starts, codes.lengths)}
    assert len(paths) == len(counts) and codes.lengths[0] == 1 and all(codes.lengths[0] <= n for n in codes.lengths)
    assert set(codes.steps >> 4) == set(range(len(counts) - 1))


def test_probabilities_of_all_continuations_add_up_to_one():
    """Bits of each symbol after a shared beginning, from differences of whole texts within one block."""
    codes = lm.Codes([5, 3, 2, 1, 1], ((), (1,), (1, 2)), 64)
    rng = np.random.default_rng(1)
    odds = [rng.integers(-40, 40, lm.PLACES).astype(np.int8) for _ in codes.contexts]
    mixer = lm.Mixer(codes, odds, rng.random((codes.inputs, codes.gates)), lm.first_map(codes))
    for length in (0, 3, 40):
        start = rng.integers(0, 5, length)
        one_more = [np.append(start, s).astype(np.int32) for s in range(5)]
        all_bits = mixer.run([start.astype(np.int32), *one_more])
        assert math.isclose(sum(2.0 ** -(b - all_bits[0]) for b in all_bits[1:]), 1, rel_tol=1e-4)


def test_a_text_scores_alike_in_any_company(small):
    docs, model = small
    texts = [b"the cat sat on a mat", b"", b"zebra " * 3000, b"in the hat in the hat"]
    symbols = [model.words.codes.symbols(t) for t in texts]
    alone = [model.words.run([s])[0] for s in symbols]
    assert np.allclose(model.words.run(symbols), alone, rtol=1e-6) and np.allclose(model.words.run(symbols[::-1]), alone[::-1], rtol=1e-6)


def plain_bits(mixer, symbols):
    """One bit after the other, with what a text teaches taken over at the ends of its blocks."""
    codes = mixer.codes
    weights, refined = mixer.weights.astype(float).copy(), mixer.map.astype(float).copy()
    own, total = Counter(), 0.0
    ends = sorted({lm.FIRST_BLOCK * 2**k for k in range(6)} | set(range(lm.LONGEST_BLOCK, len(symbols) + lm.LONGEST_BLOCK, lm.LONGEST_BLOCK)) | {len(symbols)})
    start = 0
    for end in [e for e in ends if e <= len(symbols)]:
        seen = []
        for at in range(start, end):
            s, node_at = symbols[at], int(codes.starts[symbols[at]])
            for depth in range(int(codes.lengths[s])):
                node, bit = int(codes.steps[node_at + depth]) >> 4, int(codes.steps[node_at + depth]) & 1
                places = []
                for lags in codes.contexts:
                    h = len(lags)
                    for lag in lags:
                        h = scrambled(h * 0x9E3779B1 + (int(symbols[at - lag]) + 1 if at >= lag else 0))
                    places.append(scrambled(h + node * 0x9E3779B1) >> 33 - lm.PLACES.bit_length() if lags else node)
                key = places[1] % codes.own
                zeros, ones = min(own[key, 0], 15), min(own[key, 1], 15)
                x = [table[p] / 16 for table, p in zip(mixer.odds, places)] + [math.log((ones + 0.4) / (zeros + 0.4)), 0.5]
                level = 2 * max((k for k in range(1, len(places)) if x[k]), default=0) + (zeros + ones > 0)
                gate = level * 6 + (depth.bit_length() if depth < 16 else 5)
                mixed = float(np.dot(weights[:, gate], x))
                p = 1 / (1 + math.exp(-min(max(mixed, -11.9), 11.9)))
                step = (min(max(mixed, -7.99), 7.99) + 8) * 2
                low, share = int(step), step - int(step)
                told = 0.5 * (p + refined[level, low] * (1 - share) + refined[level, low + 1] * share)
                total -= math.log2(told if bit else 1 - told)
                seen.append((gate, level, low + (share >= 0.5), np.array(x), bit - p, bit, key))
        by_gate, by_cell = Counter(r[0] for r in seen), Counter((r[1], r[2]) for r in seen)
        for gate, _, _, x, error, _, _ in seen:
            weights[:, gate] += lm.STEP / (by_gate[gate] + 16) * error * x
        for (level, cell), n in by_cell.items():
            hits = sum(r[5] for r in seen if (r[1], r[2]) == (level, cell))
            refined[level, cell] += (hits - n * refined[level, cell]) / (n + lm.MAP_START)
        own.update((r[6], r[5]) for r in seen)
        start = end
    return total


def scrambled(x):
    x &= 0xFFFFFFFF
    x ^= x >> 15
    x = x * 0x85EBCA6B & 0xFFFFFFFF
    return x ^ x >> 13


def test_bits_equal_one_bit_after_the_other(small):
    docs, model = small
    for row in docs.limit(15).collect() + [{"text": " ".join(itertools.islice(itertools.cycle(["the", "cat", "zebra", "rare1", "mat"]), 700))}]:
        symbols = model.words.codes.symbols((row["text"] or "").encode())
        assert math.isclose(model.words.run([symbols])[0], plain_bits(model.words, symbols), rel_tol=1e-3), row["text"]
    for word in (b"rare17", b"unseen", b"\xc3\xa9"):
        symbols = model.spelling.codes.symbols(word)
        assert math.isclose(model.spelling.run([symbols])[0], plain_bits(model.spelling, symbols), rel_tol=1e-3)


def test_places_are_counted_over_all_texts(spark, small):
    docs, model = small
    codes = model.words.codes
    want = [Counter() for _ in codes.contexts]
    for row in docs.collect():
        together = lm.Together(codes, [codes.symbols(row["text"].encode())])
        d = together.decisions(0, len(together.symbols))
        for w, places in zip(want, d.places):
            w.update(zip(places.tolist(), d.bit.tolist()))
    with lm._sent(spark, codes) as held:
        odds = lm.odds_of(lm.place_counts(docs, held), codes)
    for w, table in zip(want, odds):
        places = {p for p, _ in w}
        assert set(np.flatnonzero(table).tolist()) == places
        for p in itertools.islice(places, 200):
            value = round(16 * math.log((w[p, 1] + 0.4) / (w[p, 0] + 0.4)))
            assert abs(int(table[p]) - (min(max(value, -127), 127) or 1)) <= 1


def test_salted_sums_are_the_same(spark, small, monkeypatch):
    docs, model = small
    codes = model.words.codes
    with lm._sent(spark, codes) as held:
        plain = lm.odds_of(lm.place_counts(docs, held), codes)
    monkeypatch.setattr(lm, "estimated_bytes", lambda df: 600 * lm.TASK_BYTES)
    monkeypatch.setattr(lm, "_chunk_tasks", lambda codes: 2)
    with lm._sent(spark, codes) as held:
        salted = lm.odds_of(lm.place_counts(docs.repartition(6), held), codes)
    assert all((a == b).all() for a, b in zip(plain, salted))


def test_what_tasks_get_is_small_and_the_same(small):
    docs, model = small
    again = pickle.loads(data := pickle.dumps(model.words))
    assert len(data) < 1 << 18 and again.codes.table == model.words.codes.table
    for name in ("lengths", "starts", "steps", "counts"):
        assert (getattr(again.codes, name) == getattr(model.words.codes, name)).all()
    assert all((a == b).all() for a, b in zip(again.odds, model.words.odds))
    assert pickle.loads(pickle.dumps(lm.Words([], [], 0, 0))).table == {b"": 0}


def test_word_pieces_keep_every_word():
    text = b"Ab\x0bc " + b"x" * 3_000_000 + b" \t" + b"de FG\n" * 400_000
    assert [w for words in lm.words_in(text) for w in words] == text.lower().split()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = lm.fit(docs.limit(0))
    got = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    assert got[1]["n_tokens"] == 3 and got[1]["n_known"] == 0 and got[1]["base_score"] == 0 and got[1]["train_tokens"] == 0
    assert got[1]["score"] < got[2]["score"] < 0 and got[2]["bits_per_byte"] is None
    assert lm.score(docs.limit(0), model).count() == 0


def test_repeated_texts_cost_less_the_second_time(small):
    docs, model = small
    line = b" ".join(sorted(w for w in model.words.codes.table if w)) + b" "
    once, often = (model.words.run([model.words.codes.symbols(line * k)])[0] for k in (1, 12))
    assert often < 0.9 * 12 * once


def even_mixer(codes):
    return lm.first_mixer(codes, [np.zeros(lm.PLACES, np.int8) for _ in codes.contexts])


def test_own_counts_of_a_long_text_stay_full():
    mixer = even_mixer(lm.Codes([5, 3, 2, 1, 1], ((), (1,)), 64))
    before, full, more = (mixer.run([np.zeros(n, np.int32)])[0] for n in ((1 << 16) - 512, 1 << 16, (1 << 16) + 512))
    assert more - full < 1.01 * (full - before)


def test_only_texts_that_go_on_have_weights_of_their_own(monkeypatch):
    asked, of = [], lm.Shown.of
    monkeypatch.setattr(lm.Shown, "of", lambda mixer, many, counting: asked.append((many, counting)) or of(mixer, many, counting))
    even_mixer(lm.Codes([5, 3, 2], ((), (1,)), 64)).run([np.zeros(n, np.int32) for n in (10, 17, 16, 40, 1)])
    assert asked == [(1, 0), (2, 2)]


def test_symbols_of_one_context_are_counted_together(monkeypatch):
    codes, done, path = lm.Codes([5, 3, 2], ((), (1,)), 64), [], lm.Codes.path
    monkeypatch.setattr(lm.Codes, "path", lambda self, symbols: done.append(len(symbols)) or path(self, symbols))
    tables = np.zeros((2, lm.PLACES * 2), np.int32)
    lm._add_places(tables, codes, [lm.Together(codes, [np.array([0, 1, 2, 0, 1], np.int32)] * 100)])
    assert sum(done) == 4 and tables[1].sum() == 100 * codes.lengths[[0, 1, 2, 0, 1]].sum()
