import random

import pytest

from cardledger.llm import line_dedup as op
from cardledger.llm.texts import fold_words

SCHEMA = "doc_id long, text string, n_chars long, line string, row string"


def one_edit(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < op.EDIT_FROM or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(texts):
    seen, out = [], []
    for t in texts:
        if t is None:
            out.append((None, 0, 0))
            continue
        kept = []
        for line in t.split("\n"):
            words = fold_words(line.encode())
            if len(words) < op.MIN_WORDS or not any(one_edit(words, s) for s in seen):
                kept.append(line)
            if len(words) >= op.MIN_WORDS:
                seen.append(words)
        n = t.count("\n") + 1
        out.append(("\n".join(kept), n, n - len(kept)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(9)]
    lines = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 9, 10, 11, 12, 15, 30]))] for _ in range(25)]
    texts = [None, "", "\n\n", "w1", "!!\n!!", "\nW1 w2 W3\n"]
    for _ in range(40):
        doc = []
        for _ in range(rng.randint(1, 8)):
            line = list(rng.choice(lines))
            kind = rng.random()
            at = rng.randrange(len(line))
            if kind < 0.2:
                line[at] = rng.choice(words)
            elif kind < 0.35:
                del line[at]
            elif kind < 0.5:
                line.insert(at, rng.choice(words))
            elif kind < 0.6:  # a moved word: shares a variant, but is two edits away
                line.append(line.pop(at))
            doc.append(" ".join(line).capitalize() + rng.choice([".", "!", ""]))
        texts.append("\n".join(doc))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_comparing_all_lines(stored, seed):
    texts = corpus(seed)
    docs = stored([(i, t, len(t or ""), "l", "r") for i, t in enumerate(texts)], SCHEMA, 4)
    got = {r.doc_id: (r.text, r._n_lines, r._n_removed) for r in op.dedup_lines(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_columns_stay_and_emptied_documents_go(stored):
    text = "a line of words\nanother line of words"
    docs = stored([(1, text, 0, "x", "r"), (2, text, 0, "y", "r"), (2, None, 0, "z", "r"), (3, "", 0, "z", "r"), (None, "own line here", 0, "n", "r")], SCHEMA, 1)
    kept = op.drop_emptied(op.dedup_lines(docs))
    assert kept.columns == docs.columns
    assert sorted((r.line, r.text or "") for r in kept.collect()) == [("n", "own line here"), ("x", text), ("z", ""), ("z", "")]


def test_empty_table(stored):
    assert op.dedup_lines(stored([], SCHEMA)).count() == 0


def test_clashing_names(stored):
    """Columns named like those that the operator makes stay as they are; its counts replace theirs."""
    names = ["_row", "_removed", "_doc", "row", "line", "h1", "key", op.ROW, "_n_lines", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names)
    text = "a line of words here\nown line of words %d"
    docs = stored([(i, text % i, *[f"{c}{i}" for c in names]) for i in range(3)], schema, 1)
    for growing in (False, True):
        out = op.dedup_lines(docs, growing)
        assert sorted(out.columns) == sorted([*docs.columns, "_n_removed"])
        assert sorted((r.doc_id, r._n_lines, r._n_removed) for r in out.collect()) == [(0, 2, 0), (1, 2, 1), (2, 2, 1)]
        for r in out.collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in names if c != "_n_lines")
