"""Periodic runs against plain Python over all periods and places."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import periodic
from tests.llm.conftest import ODD, SF


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, k, q) for (s, k), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(key, words):
    h = zlib.crc32(b"%d" % key)
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def found(texts):
    return [[tuple(r) for r in runs.tolist()] for runs in periodic.runs_of_texts([t.encode() for t in texts])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 5), st.integers(0, 12), st.integers(1, 3)), min_size=1, max_size=6), st.randoms(use_true_random=False))
def test_runs_of_made_texts(parts, rng):
    words = []
    for period, times, rest, letters in parts:
        base = [rng.choice("abcdefgh"[: letters * 2]) for _ in range(period)]
        words += base * times + base[:rest]
    texts = [" ".join(words), " ".join(words[::-1]), "", "x " * 30]
    assert found(texts) == [brute_runs(split(t)) for t in texts]
    for t, runs in zip(texts, found(texts), strict=True):
        assert periodic.collapsed(t.encode(), np.array(runs or np.empty((0, 3)), dtype=np.int64)).decode() == brute_collapse(split(t), runs)


def test_long_periods_of_few_letters():
    rng = random.Random(4)
    for _ in range(25):
        period = rng.randint(9, 700)
        base = rng.choices("ab", k=period)
        words = rng.choices("ab", k=rng.randint(0, 200)) + base * 3 + base[: rng.randint(0, period)] + rng.choices("abc", k=100)
        text = " ".join(words)
        assert found([text]) == [brute_runs(words)]


def test_every_period_from_shortest_texts():
    rng = random.Random(5)
    for period in range(1, 130):
        words = [f"{rng.random()}" for _ in range(period)] * 3
        words += words[: max(0, 24 - len(words))] if period < 8 else []
        words = words if len(words) >= 24 else (words * 24)[:24]
        assert found([" ".join(words), " ".join(words[:-1])]) == [brute_runs(words), brute_runs(words[:-1])], period


def test_upper_case_and_hard_spaces_count():
    assert found(["A a " * 12, "a a " * 24]) == [[(0, 24, 2)], [(0, 24, 1)]]


def test_query_against_brute_force(spark, texts):
    rows = periodic.op11_minimizer_periodic_runs(spark, SF).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        words = planted(r["doc_id"], split(texts[r["doc_id"]]))
        runs = [tuple(x) for x in periodic.runs_of_texts([" ".join(words).encode()])[0].tolist()]
        if len(words) <= 1500:
            assert runs == brute_runs(words)
        assert r["n_runs"] == len(runs)
        some += bool(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == expected
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
    assert some > len(texts) // 20


def test_odd_rows_of_runs(spark, frame):
    df = frame([*ODD, (6, "a b " * 13), (None, "z " * 24)])
    out = periodic.find_runs(df).collect()
    assert len(out) == len(ODD) + 2
    by = {(r["doc_id"], r["collapsed"]): [tuple(x) for x in r["runs"]] for r in out}
    assert by[(7, "word")] == [(0, 30000, 1)] and by[(6, "a b")] == [(0, 26, 2)] and by[(None, "z")] == [(0, 24, 1)]
    assert by[(5, "")] == by[(3, "")] == by[(9, "")] == by[(None, "b c")] == []
    done = periodic.collapse(df)
    assert done.columns == df.columns and done.count() == len(ODD) + 2
    assert {r["text"] for r in done.filter("doc_id in (5, 7, 9)").collect()} == {None, "word", ""}
    assert periodic.find_runs(frame([])).count() == 0 and periodic.collapse(frame([])).count() == 0
