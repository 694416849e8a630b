"""Periodic runs (12) against brute force over all lags."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import periodic_runs as pr
from tests.llm.conftest import DOCS, docs_of


def brute_runs(w):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    w = (text or "").encode().split()
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *tail, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def periodic(rng, n, letters):
    w = []
    while len(w) < n:
        kind = rng.random()
        if kind < 0.5:
            base = [rng.randrange(letters) for _ in range(rng.randint(1, 60))]
            k = rng.randint(1, 150)
            w += (base * (k // len(base) + 2))[:k]
        elif kind < 0.8:
            w += [rng.randrange(letters) for _ in range(rng.randint(1, 30))]
        elif w:
            w += w[rng.randrange(len(w)) :][: rng.randint(1, 80)]
    return w[:n]


@pytest.mark.parametrize(("seed", "letters"), [(s, a) for s in range(12) for a in (1, 2, 3, 10, 200)])
def test_runs_against_brute_force(seed, letters):
    rng = random.Random(seed * 1000 + letters)
    docs = [periodic(rng, rng.choice([0, 1, 11, 12, 13, 40, 150, 400]), letters) for _ in range(8)]
    got = pr.find_runs([np.array(d, dtype=np.int64) for d in docs])
    assert got == [brute_runs(d) for d in docs]


def test_fibonacci_words_and_long_periods():
    """Words with very many runs, and squares of every length."""
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    squares = [x for k in (5, 6, 11, 12, 23, 24, 25, 47, 48, 97) for x in [*[1000 * k + i for i in range(k)] * 2, -k]]
    docs = [b[:900], squares, [0] * 700, [0, 1] * 300 + [0, 1, 2] * 100]
    docs = [[x + 200 for x in d] for d in docs]
    assert pr.find_runs([np.array(d, dtype=np.int64) for d in docs]) == [brute_runs(d) for d in docs]


def test_splitting_keeps_what_may_run():
    """A word that occurs once splits; the parts are split by their own counts, and short ones go."""
    w = np.array([0, 1] * 6 + [9] + [2, 3, 4] * 3 + [5] * 3 + [0], dtype=np.int64)
    live, seg = pr.segments(w, np.zeros(len(w), dtype=np.int64))
    assert list(live) == [*range(12), *range(13, 25)] and list(seg) == [0] * 12 + [1] * 12


def test_million_words_in_linear_time():
    rng = np.random.default_rng(1)
    docs = [np.zeros(300_000, dtype=np.int64), np.tile(rng.integers(0, 50, 70_000), 4), rng.integers(0, 20, 300_000)]
    one, two, _ = pr.find_runs(docs)
    assert one == [(0, 300_000, 1)] and (0, 280_000, 70_000) in two


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(10**6), " ".join(f"w{x}" for x in periodic(rng, rng.randint(0, 200), rng.choice([2, 5, 40]))).replace(" w1 ", "\tw1\n\x0b")) for _ in range(120)]
    rows += [(None, None), (None, "a " * 30), (5, None), (6, ""), (7, " \n\t "), (8, "a " * 11), (9, "A a " * 6), (9, "A a " * 6), (10, "é b " * 12), (11, "x y z " * 4000)]
    docs = docs_of(spark, rows).withColumns({"n_runs": F.lit("clash"), "start": F.lit(1)}).repartition(3)
    for plant in (True, False):
        got = sorted(map(tuple, pr.periodic_runs(docs, plant=plant).collect()), key=str)
        assert got == sorted((brute(*r, plant=plant) for r in rows), key=str)
    assert pr.periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
