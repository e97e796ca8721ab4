import numpy as np
import pytest

from cardledger.llm import license_scans as op

SCHEMA = "doc_id long, text string, license string, start string"
MIT = op.TEMPLATES["MIT"]


def scan(frame, texts, **more):
    rows = op.scan(frame([(i, t, "l", "s") for i, t in enumerate(texts)], SCHEMA), **more).collect()
    return sorted((r.doc_id, r.license, round(r.coverage, 3), r.start, r.end) for r in rows)


@pytest.mark.parametrize("name", sorted(op.TEMPLATES))
def test_finds_every_template_with_its_span(frame, name):
    text = "Être libre. " + op.TEMPLATES[name].upper() + " And more."
    found = [r for r in scan(frame, [text]) if r[1] == name]
    assert len(found) == 1 and found[0][2] == 1.0
    span = text.encode()[found[0][3] : found[0][4]].decode()
    assert span.rstrip('."') == op.TEMPLATES[name].upper().rstrip('."')


def test_edited_copy(frame):
    words = MIT.split()
    edited = words[:20] + ["really", "truly"] + words[20:60] + words[63:100] + ["other"] + words[101:]
    got = scan(frame, ["x y z " * 50 + " ".join(edited) + " tail" * 30])
    (_, name, coverage, _, _), = [r for r in got if r[1] == "MIT"]
    assert 0.95 < coverage < 1
    assert not [r for r in scan(frame, [" ".join(words[: len(words) // 2])]) if r[1] == "MIT"]


def test_several_copies_and_nothing(frame):
    line = "Released under the MIT License."
    got = scan(frame, [None, "", "?", "released", f"{line}\n{line} and {line}", "License MIT the under released"])
    assert [(r[0], r[1]) for r in got] == [(4, "MIT notice")] * 3
    assert len({r[3] for r in got}) == 3
    assert scan(frame, []) == []


def test_alignment_against_longest_common_subsequence():
    rng = np.random.default_rng(3)
    for _ in range(200):
        template = rng.integers(0, 50, 20).astype(np.uint64)
        words = np.delete(template, rng.integers(0, 20, 2))
        words = np.insert(words, rng.integers(0, len(words)), 99).astype(np.uint64)
        table = np.zeros((21, len(words) + 1), int)
        for i, a in enumerate(template):
            for j, b in enumerate(words):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        matched, first, last = op.align(template, words, -8, 8)
        assert matched <= table[-1, -1] and matched >= table[-1, -1] - 1
        assert 0 <= first <= last < len(words)


def test_winnowing_keeps_one_of_every_window():
    hashes = np.random.default_rng(1).integers(0, 9, 300).astype(np.uint64)
    kept = op.winnow(hashes, 4)
    assert (np.diff(np.r_[-1, kept, 300]) <= 4).all()


def test_templates_without_words_are_refused():
    with pytest.raises(ValueError):
        op.Index({"none": "?!"}, 3, 2)
