"""Substring dedup (9) against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.llm import substring_dedup
from tests.llm.conftest import DOCS, docs_of


def brute(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in docs:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < (i, k):
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("seed", "window", "gram"), [(1, 20, 6), (2, 8, 3), (3, 5, 5), (4, 3, 1)])
def test_against_brute_force(spark, seed, window, gram):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    passages = [[rng.choice(words) for _ in range(rng.randint(window, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.4 else [rng.choice(words) for _ in range(rng.randint(0, 40))]
        rows.append((rng.randrange(100), " ".join(w)))
    rows += [(200, " ".join(["a"] * 100)), (201, rows[0][1]), (202, rows[0][1]), (5, rows[1][1])]
    got = substring_dedup.remove_repeats(docs_of(spark, rows).repartition(3), window=window, gram=gram).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)


def test_small_automata_and_edge_cases(spark, monkeypatch):
    long = " ".join(f"x{k % 3000}" for k in range(9000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, long), (6, long), (6, long), (7, "y " + long), (None, long), (8, " ".join(["z"] * 19)), (9, " ".join(["z"] * 19)), (10, " ".join(["z"] * 20)), (11, "é b c" * 30)]
    docs = docs_of(spark, rows).withColumns({"mark": F.lit("clash"), "digest": F.lit(1), "anchor": F.lit(2)})
    got = substring_dedup.remove_repeats(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 20)
    assert substring_dedup.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_locator_over_many_automata():
    """The windows of one anchor that fall into several automata are still one group."""
    rng = random.Random(5)
    words = [b"a", b"b", b"c"]
    rows = [(7, i, 0, 0, b" ".join(rng.choice(words) for _ in range(9))) for i in range(60)]
    whole = substring_dedup.Locator(4)
    want = whole.locate(rows)
    parts = substring_dedup.Locator(4)
    got = [s for k in range(0, 60, 7) for s in parts.locate(rows[k : k + 7])]
    assert sorted(got) == sorted(want) and want


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_hot_anchor_is_dealt_out_by_window(spark, monkeypatch, salts):
    """A phrase in every document, with varied and with equal words around it: right results, and no task gets the phrase's windows under one key."""
    rng = random.Random(7)
    phrase, keys = [f"p{k}" for k in range(4)], []
    around = [[rng.choice("abcd") for _ in range(6)] for _ in range(5)]
    rows = [(rng.randrange(150), " ".join([f"x{i}", *rng.choice(around), *phrase, *rng.choice(around), f"y{i % 40}"])) for i in range(200)]
    monkeypatch.setattr(substring_dedup, "SALTS", salts)
    sharded = substring_dedup._sharded

    def spy(stretches):
        keys.append(stretches.groupBy("anchor").agg(F.count("*").alias("n"), F.countDistinct("words").alias("words"), F.countDistinct("doc_id").alias("docs")).collect())
        return sharded(stretches)

    monkeypatch.setattr(substring_dedup, "_sharded", spy)
    got = substring_dedup.remove_repeats(docs_of(spark, rows).repartition(3), window=8, gram=4, hot=20).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 8)
    cold, dealt, firsts = keys
    assert max((r.n for r in cold), default=0) <= 20 * 5 and dealt and all(r.words == 1 for r in dealt + firsts)
    assert salts == 1 or max(r.docs for r in dealt) < 150 * 2 / salts + 20


def test_only_windows_that_may_recur_are_digested(monkeypatch):
    """Stretches that share an anchor but no window cost no digest or automaton; those that do are all found."""
    window, digests, blake2b = 5, [], hashlib.blake2b
    monkeypatch.setattr(substring_dedup.hashlib, "blake2b", lambda data, **kw: digests.append(data) or blake2b(data, **kw))
    rows = [(a, d, 0, 0, b" ".join([b"%dd%dk%d" % (a, d % 7 if a == 3 else d, k) for k in range(9)])) for a in range(50) for d in range(8)]
    locator = substring_dedup.Locator(window)
    assert locator.locate(rows) == [(7, 0, 0, 9)]  # anchor 3: documents 0 and 7
    assert len(digests) == 2 * 5 + 8 * 5  # and the last anchor, whose rows may go on
    assert locator.locate([(49, 9, 0, 0, rows[-1][4])]) == [(9, 0, 0, 9)]


def test_window_hashes():
    rng = random.Random(3)
    words = [rng.choice([b"a", b"b", b"aa", b"ab", "é".encode()]) for _ in range(2000)]
    for window in (1, 2, 3, 100):
        got, want = substring_dedup.window_hashes(b" ".join([*words, b""]), window).tolist(), [tuple(words[k : k + window]) for k in range(2001 - window)]
        assert len(got) == len(want) and len(set(got)) == len(set(want)) == len(set(zip(got, want, strict=True)))
    assert len(substring_dedup.window_hashes(b"a b ", 3)) == 0


def test_equal_stretches_go_as_a_whole(spark, monkeypatch):
    """Stretches that an anchor had before, word for word, reach no automaton; their windows go all the same, as do those of rows that share a doc_id."""
    rng, given, locate = random.Random(9), [], substring_dedup.Locator.locate
    monkeypatch.setattr(substring_dedup.Locator, "locate", lambda self, rows: given.append([(r[0], r[4]) for r in rows]) or locate(self, rows))
    passage = [b"p%d" % k for k in range(9)]
    rows = [(a, d, d, 3, b" ".join([b"%d" % a, *passage])) for a in range(4) for d in range(50)]
    rows.insert(1, (0, 0, 77, 3, rows[0][4]))  # the same doc_id and place: both are first
    batch = substring_dedup.batch_of(substring_dedup.STRETCH, *zip(*rows, strict=True))
    got = [tuple(r.values()) for b in substring_dedup._locate(5)([batch]) for r in b.to_pylist()]
    assert sorted(got) == sorted((d, d, 3, 13) for _ in range(4) for d in range(1, 50))
    assert given == [[(0, rows[0][4])] * 2 + [(a, b" ".join([b"%d" % a, *passage])) for a in (1, 2, 3)]]
    texts = [[f"w{rng.randrange(30)}" for _ in range(40)] for _ in range(4)]
    docs = [(rng.randrange(40), " ".join(sum((t[: rng.choice([40, 40, 15])] for t in rng.sample(texts, 3)), [f"x{i}"]))) for i in range(60)]
    out = substring_dedup.remove_repeats(docs_of(spark, docs).repartition(3), window=8, gram=3).collect()
    assert sorted(map(tuple, out), key=str) == brute(docs, 8)


@pytest.mark.parametrize("width", [1, 2, 3, 7, 15, 16, 50])
def test_first_least(width):
    rng = random.Random(width)
    values = [rng.randrange(6) for _ in range(300)]
    want = [min(range(i, i + width), key=lambda k: (values[k], k)) for i in range(301 - width)]
    assert substring_dedup.first_least(np.array(values, dtype=np.uint64), width).tolist() == want
