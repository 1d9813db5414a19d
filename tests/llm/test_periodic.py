"""Runs against a plain search of every period."""

import random
import zlib
from collections import Counter

import pytest

from shelfstar.llm import periodic, queries

from . import brute
from .test_operators import SF, empty, folder, given, odd_rows  # noqa: F401


def encoded(words):
    return [str(w).encode() for w in words]


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_a_search_of_every_period(least):
    rng = random.Random(least)
    for turn in range(400):
        letters, n = rng.choice([1, 2, 3, 8]), rng.choice([0, 1, 2, 11, 12, 30, 80])
        words = [rng.randrange(letters) for _ in range(n)]
        if turn % 2 and n:
            a, p = rng.randrange(n), rng.randint(1, n)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            for _ in range(turn % 3):
                words[rng.randrange(n)] = -1
        found = periodic.find_runs(encoded(words), least)
        assert found == brute.runs(words, least), words
        assert periodic.collapsed(encoded(words), found) == b" ".join(encoded(brute.without_repeats(words, found)))


def test_runs_of_long_and_nested_repeats():
    one = encoded([0] * 60_000)
    assert periodic.find_runs(one) == [(0, 60_000, 1)]
    assert periodic.collapsed(one, [(0, 60_000, 1)]) == b"0"
    block = [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2]
    words = block * 500
    found = periodic.find_runs(encoded(words))
    assert found[0] == (0, 12, 1) and (0, 6500, 13) in found and len(found) == 501
    rng = random.Random(1)
    line = list(range(1000, 1007))
    spread = [x for _ in range(5000) for x in [*line, rng.randrange(10**9)]]
    assert periodic.find_runs(encoded(spread)) == []


def test_fibonacci_words_have_runs_of_many_periods():
    a, b = [1], [1, 2]
    while len(b) < 300:
        a, b = b, b + a
    assert periodic.find_runs(encoded(b)) == brute.runs(b, 12) and len(brute.runs(b, 12)) > 20


def test_no_run_below_two_words():
    with pytest.raises(ValueError):
        periodic.find_runs([b"a"], 1)


@pytest.mark.parametrize("where", ["odd", "given"])
def test_query_equals_plain_version(spark, odd_rows, folder, where):  # noqa: F811
    rows, root = ([r[:2] for r in odd_rows], folder) if where == "odd" else (given(spark, "documents", "doc_id", "text"), SF)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op11_periodic_runs(spark, root)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(plain(i, t) for i, t in rows if len(t or "") < 60_000) + Counter(
        tuple(r) for r in got.select(*columns).collect() if r["doc_id"] in {i for i, t in rows if len(t or "") >= 60_000})
    assert any(r["n_runs"] for r in got.collect()) or where == "odd"


def plain(key, text):
    words = brute.WORDS.findall(text or "")
    n, h = len(words), 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute.runs(words, 12)
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    lines = "".join(f"{s},{x},{p}\n" for s, x, p in found)
    return key, len(found), *top, 1000 * top[1] // top[2] if found else None, brute.sha(lines), brute.sha(" ".join(brute.without_repeats(words, found)))
