import hashlib
import random

import numpy as np
import pytest

from cardledger.llm import substring_dedup as op
from cardledger.llm.plain_words import PlainWords
from cardledger.llm.texts import Prefix

SCHEMA = "doc_id long, text string, row string, key string, first string, spans string"


def brute(texts, width):
    """Per text, in order of place: (n_words, n_removed, digest), by listing every window."""
    seen, out = set(), []
    for text in texts:
        words = (text or "").encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            gone[i : i + width] |= window in seen
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, letters="abcdefg"):
    """Texts of few words that share passages, whole and in part, with runs and periodic stretches."""
    rng = random.Random(seed)
    prose = lambda n: [rng.choice(letters) for _ in range(n)]
    passages = [prose(n) for n in (7, 12, 30, 60)] + [["r"] * 40, list("pq") * 30]
    texts = [None, "", " \t", "a", " ".join("b" * 50), " ".join(prose(300))]
    for _ in range(50):
        words = prose(rng.randint(0, 25))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += (p, p[a:], p[:a] + ["#"] + p[a:])[rng.randrange(3)] + prose(rng.randint(0, 9))
        texts.append(rng.choice([" ", "\n", " \x0b "]).join(words))
    return texts + [texts[10], texts[20], texts[20]]


def digests(docs, width):
    rows = op.digest(op.without_repeats(docs, width)).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}


@pytest.mark.parametrize("seed, width, letters", [(1, 20, "abcdefg"), (2, 20, "ab"), (3, 6, "abcdefgh"), (4, 3, "abc"), (5, 1, "abcdefgh")])
def test_against_every_window(stored, seed, width, letters):
    texts = corpus(seed, letters)
    order = list(range(len(texts)))
    random.Random(seed).shuffle(order)  # places in the table say nothing about ids
    docs = stored([(i, texts[i], *"rkfs") for i in order], SCHEMA)
    got = digests(docs, width)
    assert [got[i] for i in range(len(texts))] == brute(texts, width)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    words = PlainWords([bytes(rng.choice(list(b"abc"), 3000)).replace(b"", b" "), b"a b c " * 300])
    key, _, first, count = op.anchors_of(words, 8)
    named = {}
    ids = words.id.tolist()
    for k, a, n in zip(key.tolist(), first.tolist(), count.tolist()):
        for i in range(a, a + n):
            assert named.setdefault(tuple(ids[i : i + 8]), k) == k
    assert sum(count.tolist()) == sum(max(0, n - 7) for n in np.diff(words.first).tolist())


def test_rounds_rewrite_equal_stretches_alike():
    rng = np.random.default_rng(8)
    shared = list(rng.integers(0, 5, 60))
    ids = np.array([9, 9, *shared, 7, *shared, 8, 8, 8], np.uint64)
    symbols = op.Symbols(Prefix(ids), np.zeros(len(ids), np.int64))
    lo, hi = np.array([2, 63]), np.array([62, 123])
    for step in range(5):
        lo, hi = symbols.pairs(lo, hi, step) if step else symbols.runs(lo, hi)
        cores = [list(zip(symbols.name[a:b], symbols.start[a:b] - s)) for a, b, s in zip(lo, hi, (2, 63))]
        assert cores[0] == cores[1]
    assert 0 < len(cores[0]) < 40


def test_nulls_repeated_rows_and_one_id_twice(stored):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (4, text), (4, text), (5, "x " + text), (6, None), (6, "")]
    docs = stored([(*r, None, None, None, None) for r in rows], SCHEMA, parts=1)
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in op.without_repeats(docs).collect())
    assert got == [(0, 30, 0), (4, 30, 30), (4, 30, 30), (5, 31, 30), (6, 0, 0), (6, 0, 0)]


def test_very_long_text_and_empty_table(stored):
    rng = random.Random(1)
    long = [str(rng.randrange(5000)) for _ in range(150_000)]
    texts = [" ".join(long), " ".join(long[70_000:90_000] + ["x"] + long[:30]), " ".join(["y"] * 50_000)]
    docs = stored([(i, t, *"rkfs") for i, t in enumerate(texts)], SCHEMA)
    got = digests(docs, 20)
    assert [got[i][1] for i in range(3)] == [0, 20_030, 49_999]
    assert op.without_repeats(stored([], SCHEMA)).count() == 0
