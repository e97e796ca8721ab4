import random
import re
from collections import Counter

import numpy as np
import pytest

from cardledger.llm import quality_rules as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", "\n\n", " \t ", "a", "a b", "a a a a", "\x1f\xa0 é\r\né", "#*$%&|<>", "x\n\nx\n x\nx"]
    for _ in range(60):
        words = [rng.choice(["a", "b", "Ü", "c#", "日本", "d|e", "f"]) for _ in range(rng.randint(1, 150))]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\t", "\x0b"]) for w in words))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_base_counts(frame, seed):
    texts = corpus(seed)
    docs = frame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, kept string")
    rows = {r.doc_id: r for r in op.score(docs, (None, None)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t)
        assert r.kept == (not r.base_failed)


def labelled(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(2000)]
    texts, good, toxic = [], [], []
    for _ in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(60, 400))]
        bad, rude = rng.random() < 0.2, rng.random() < 0.2
        if bad:
            body = [w.upper() + "!!" for w in body]
        if rude:
            for _ in range(3):
                body[rng.randrange(len(body))] = rng.choice(["scoundrel", "rascal", "Scoundrelly"])
        texts.append(" ".join(body).encode())
        good.append(not bad)
        toxic.append(rude)
    return texts, np.array(good, int), np.array(toxic, int)


def test_held_out_accuracy():
    models = op.train(*labelled(500, 1))
    texts, good, toxic = labelled(300, 2)
    made = op.judge(texts, models)
    assert ((made["good"] >= op.MIN_GOOD) == good).mean() > 0.97
    assert ((made["toxic"] >= op.MAX_TOXIC) == toxic).mean() > 0.95
    # Calibrated: the mean probability is near the share.
    assert abs(made["toxic"].mean() - toxic.mean()) < 0.06


def test_scores_do_not_depend_on_neighbours():
    models = op.train(*labelled(200, 1))
    texts = labelled(20, 3)[0]
    whole = op.judge(texts, models)
    for i, t in enumerate(texts):
        alone = op.judge([t], models)
        assert np.isclose(alone["good"][0], whole["good"][i]) and np.isclose(alone["toxic"][0], whole["toxic"][i])


def test_labels_with_gaps(frame):
    docs = frame([(1, "a b"), (2, None), (2, "c"), (None, "d")], "doc_id long, text string")
    labels = frame([(1, 1, 0), (2, None, 1), (9, 1, 1), (None, 1, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    texts, good, toxic = op.labelled_rows(docs, labels)
    assert sorted(zip(texts, good, toxic)) == [(b"", -1, 1), (b"a b", 1, 0), (b"a b", 1, 0), (b"c", -1, 1)]
    assert op.train(texts, good, toxic) == (None, None)
    assert len(op.labelled_rows(docs, labels, 2)[0]) <= 2
    assert op.train([], np.zeros(0, int), np.zeros(0, int)) == (None, None)


def test_keep_and_empty_table(frame):
    text = " ".join("w%d" % i for i in range(80))
    docs = frame([(1, text, "a"), (1, "short", "b"), (None, text, "c")], "doc_id long, text string, kept string")
    kept = op.keep(docs, (None, None))
    assert kept.columns == docs.columns and sorted(r.kept for r in kept.collect()) == ["a", "c"]
    empty = frame([], "doc_id long, text string, kept string")
    assert op.keep(empty, (None, None)).count() == 0 and op.score(empty, (None, None)).count() == 0


def test_features_from_tasks_give_the_same_models(stored, monkeypatch):
    texts, good, toxic = labelled(120, 3)
    monkeypatch.setattr(op, "PART_ROWS", 50)
    docs = stored([(i, t.decode()) for i, t in enumerate(texts)] + [(7, texts[7].decode())], "doc_id long, text string")
    labels = stored([(i, int(g), int(x)) for i, (g, x) in enumerate(zip(good, toxic))], "doc_id long, quality int, toxic int")
    far, near = op.learn(docs, labels), op.train(*op.labelled_rows(docs, labels))
    for a, b in zip(far, near):
        assert (a.weights == b.weights).all() and (a.bias, a.scale, a.shift) == (b.bias, b.scale, b.shift)
