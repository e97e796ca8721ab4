import random

import pytest

from cardledger.llm import ngram_jaccard_join as op
from cardledger.llm.texts import fold_words

SCHEMA = "doc_id long, text string, lang string, row string, n_links string"


def sets_of(texts):
    out = []
    for t in texts:
        w = fold_words((t or "").encode())
        out.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    return out


def brute(ids, texts):
    sets = sets_of(texts)
    n = len(texts)
    near = [
        [j for j in range(n) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        for i in range(n)
    ]
    group = list(range(n))
    for _ in range(n):
        new = [min([group[i], *(group[j] for j in near[i])]) for i in range(n)]
        if new == group:
            break
        group = new
    classes = [min(ids[j] for j in range(n) if sets[j] == sets[i]) if sets[i] else ids[i] for i in range(n)]
    return [(ids[i], classes[i], min(ids[j] for j in range(n) if group[j] == group[i]), len(near[i])) for i in range(n)]


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \n", "one", "one", "One!", "one two three four", "one two three four five", "é ü é ü é"]
    for _ in range(12):
        base = prose(rng.randint(30, 200))
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    boiler = prose(12)
    texts += [" ".join(boiler + prose(rng.randint(5, 60))) for _ in range(20)]
    return texts


@pytest.mark.parametrize("seed, cap", [(1, 500), (2, 2)])
def test_against_all_pairs(stored, seed, cap, monkeypatch):
    if cap == 2:  # many buckets split, many components cut into blocks
        monkeypatch.setattr(op, "BLOCK_SETS", 3)
    texts = corpus(seed)
    docs = stored([(i, t, "xx", "r", "n") for i, t in enumerate(texts)], SCHEMA)
    rows = op.near_documents(op.numbered(docs), cap=cap).collect()
    got = sorted((r.doc_id, r.class_id, r.group_id, r.n_links) for r in rows)
    want = brute(list(range(len(texts))), texts)
    if cap == 500:
        assert got == want
    else:  # splitting on may lose a pair in a thousand
        assert sum(a != b for a, b in zip(got, want)) <= 2
    firsts = [r for r in rows if r.first_of_group]
    assert len(firsts) == len({r.group_id for r in rows})


def test_keep_one_keeps_columns_and_firsts(stored):
    text = "a b c d e f g h i j k l m n o p"
    docs = stored([(3, text, "x", "r", "n"), (1, text, "y", None, "n"), (1, text, "y", None, "n"), (2, None, "z", "r", "n"), (None, "q w e", "z", "r", "n")], SCHEMA)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.lang) for r in kept.collect()) == [(False, 1, "y"), (False, 2, "z"), (True, 0, "z")]


def test_clashing_names(stored):
    names = ["_later", "_row", "_doc", "row", "node", "label", "class_id", "group_id", op.ROW, "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    text = "a b c d e f g h i j k l m n o p"
    docs = stored([(i, text if i < 2 else f"{text} {text} {i}", *[f"{c}{i}" for c in names]) for i in range(3)], schema, 1)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r._later, r["a.b"]) for r in kept.collect()) == [(0, "_later0", "a.b0"), (2, "_later2", "a.b2")]


def test_empty_table(stored):
    assert op.join(stored([], SCHEMA)).count() == 0


def test_runs_reach_the_recall():
    runs = op.runs_for(0.8, 0.999)
    assert 1 - (1 - 0.8**op.DEPTH) ** runs >= 0.999 > 1 - (1 - 0.8**op.DEPTH) ** (runs - 1)
