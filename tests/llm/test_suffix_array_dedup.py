import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cardledger.llm import suffix_array_dedup as op

SCHEMA = "doc_id long, text string, row string, spans string"


def brute(texts, length):
    """Per text (n_bytes, n_removed, n_spans, kept) by counting every string of `length` bytes."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(k) for k in (12, 14, 25, 40)]
    texts = [None, "", "x", prose(3), "ab" * 90, "z" * 200]
    for _ in range(60):
        parts = [prose(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.4:  # a piece of it, or with one letter changed
                a = rng.randrange(len(p))
                p = p[a:] if rng.random() < 0.5 else p[:a] + "#" + p[a + 1 :]
            parts += [p, prose(rng.randint(0, 9))]
        texts.append(" ".join(parts))
    return texts + [texts[10], texts[11], texts[11]]


@pytest.mark.parametrize("seed, most", [(1, 2000), (2, 2000), (3, 4), (4, 2)])
def test_against_counting_every_string(stored, seed, most):
    texts = corpus(seed)
    docs = stored([(i, t, "r", "s") for i, t in enumerate(texts)], SCHEMA)
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in op.without_repeats(docs, 40, 16, most, digest=True).collect()
    }
    assert [got[i] for i in range(len(texts))] == brute(texts, 40)


def test_production_lengths(stored):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage = prose(80)
    texts = [prose(100) + passage + prose(50), passage + prose(3), passage[:399] + "!" + prose(9), passage[1:401], prose(70)]
    docs = stored([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op.without_repeats(docs, digest=True).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 400)


def test_empty_table(stored):
    assert op.without_repeats(stored([], SCHEMA)).count() == 0


def test_sort_orders_suffixes():
    rng = random.Random(5)
    cuts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    group = np.sort(np.array([rng.randrange(9) for _ in cuts]))
    size = np.array([len(c) for c in cuts])
    s = op.Suffixes(np.frombuffer(b"".join(cuts) + b"\0", np.uint8), np.cumsum(size) - size, size)
    order = s.sort(group)
    assert sorted(order) == list(range(200))
    assert [(group[i], cuts[i]) for i in order] == sorted((group[i], cuts[i]) for i in range(200))


def test_long_text_in_segments(monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.choice(b"abc") for _ in range(5000))
    whole = op.anchors_of([text], 40, 16)
    monkeypatch.setattr(op, "SEGMENT", 300)
    cut = op.anchors_of([text], 40, 16)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_passages_are_told_by_bytes_not_words(stored):
    """A repeated passage of over 50 words goes from 400 bytes on; n_removed tells, n_bytes is the text's size."""
    short = " ".join("s%04d" % i for i in range(60))  # 359 bytes
    long = " ".join("l%06d" % i for i in range(60))  # 479 bytes
    texts = [f"{a} {passage} {b}" for passage in (short, long) for a, b in (("on", "two"), ("three", "four"))]
    docs = stored([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in op.without_repeats(docs, digest=True).collect()}
    assert [got[i].n_bytes for i in range(4)] == [len(t) for t in texts]
    assert [got[i].n_removed for i in range(4)] == [0, 0, len(long) + 2, len(long) + 2]
