import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cardledger.llm import periodic_runs as op
from cardledger.llm.queries import op11_periodic_runs

SCHEMA = "doc_id long, text string, runs string, n_words string"


def brute_runs(words):
    """All runs (start, length, period), from the definition: every period, every maximal stretch."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)  # smaller periods come first
            i = max(j, i) + 1
    return sorted((a, length, q) for (a, length), q in out.items())


def brute(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def made(rng):
    """A text with planted repeats of several periods, some within others."""
    parts = []
    for _ in range(rng.randint(1, 6)):
        root = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.3:
            root = root * rng.randint(4, 5) + [rng.choice("abcd")]
        parts += (root * 9)[: rng.randint(1, 6 * len(root))]
    return rng.choice([" ", "\n", "  ", "\t"]).join(parts)


@pytest.mark.parametrize("seed", range(4))
def test_query_against_every_period(spark, tmp_path, seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a", "a a a a a", "a a a a a a", "ab " * 200, "é é é é é é é é", "a\x0bb " * 4, "a b a b"]
    texts += [made(rng) for _ in range(150)] + [made(rng)] * 2
    rows = [(i, t, None, "x") for i, t in enumerate(texts)] + [(3, texts[20], None, None)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect())
    assert [r[:1] + r[1:] for r in got] == sorted((i, *brute(i, t)) for i, t, *_ in rows)


def test_runs_within_runs():
    rng = np.random.default_rng(5)
    inner = list("ab" * 5 + "c")
    words = inner * 6 + list(rng.choice(list("xyz"), 200)) + ["q"] * 1000
    symbol = np.unique(words, return_inverse=True)[1].astype(np.int64)
    n = len(words)
    got = op.runs_of(symbol, np.zeros(n, np.int64), np.full(n, n)).tolist()
    assert sorted(map(tuple, got)) == brute_runs(words)


def test_hash_collisions_change_nothing(monkeypatch):
    class Blind:  # every range has the same hash
        def __init__(self, values):
            pass

        def hashes(self, start, end):
            return np.zeros(len(start), np.uint64)

    monkeypatch.setattr(op, "Prefix", Blind)
    words = list("xyabababababcxyzzzzzzzzab")
    symbol = np.unique(words, return_inverse=True)[1].astype(np.int64)
    n = len(words)
    got = op.runs_of(symbol, np.zeros(n, np.int64), np.full(n, n)).tolist()
    assert sorted(map(tuple, got)) == brute_runs(words)


def test_wavelet_neighbours():
    rng = np.random.default_rng(1)
    values = rng.permutation(500)
    lo = rng.integers(0, 490, 200)
    hi = lo + rng.integers(1, 10, 200)
    x = values[rng.integers(lo, hi)]
    above, below = op.Wavelet(values).neighbours(lo, hi, x)
    for a, b, v, up, down in zip(lo, hi, x, above, below):
        inside = sorted(values[a:b].tolist())
        i = inside.index(v)
        assert up == inside[min(i + 1, len(inside) - 1)] and down == inside[max(i - 1, 0)]


def test_very_long_text_and_empty_table(stored):
    long = " ".join(f"w{i % 37}" for i in range(200_000))
    docs = stored([(1, "a b c " + long, None, None)], SCHEMA)
    (row,) = op.find(docs).collect()
    assert [tuple(r) for r in row.runs] == [(3, 200_000, 37)] and len(row.collapsed.split()) == 40
    assert op.digest(op.find(stored([], SCHEMA))).count() == 0
