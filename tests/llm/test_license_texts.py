import numpy as np
import pytest
from test_license_scans import scan

from cardledger.llm import license_scans as op

LONG = [name for name in op.TEMPLATES if not name.endswith(("notice", "header")) and name != "All rights reserved"]


def test_license_texts_are_known():
    covered = {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"}
    assert {f"{name} text" for name in covered} <= set(LONG)
    assert {"BSD-2-Clause", "BSD-3-Clause", "0BSD", "MIT-0", "Unlicense", "Zlib"} <= set(LONG)


def test_each_text_is_reported_as_itself_alone(frame):
    got = scan(frame, [f"Some words before. {op.TEMPLATES[name]} And some after." for name in LONG])
    assert [[r[1] for r in got if r[0] == i and r[1] in LONG] for i in range(len(LONG))] == [[name] for name in LONG]


def test_headers_are_told_apart(frame):
    names = [name for name in op.TEMPLATES if name.endswith("header")]
    got = scan(frame, [op.TEMPLATES[name] for name in names])
    assert [[r[1] for r in got if r[0] == i and r[1] in names] for i in range(len(names))] == [[name] for name in names]


def with_words_put_in(text, every):
    """A foreign word after each `every` words."""
    words, out = text.split(" "), []
    for i, word in enumerate(words):
        out.append(word)
        if (i + 1) % every == 0:
            out.append(f"foreign{i}")
    return " ".join(out)


@pytest.mark.parametrize("name", ["GPL-2.0 text", "Apache-2.0 text", "MPL-2.0 text"])
def test_words_put_in_all_along(frame, name):
    text = with_words_put_in(op.TEMPLATES[name], 20)
    got = [r for r in scan(frame, ["before " * 40 + text + " after" * 40]) if r[1] == name]
    assert len(got) == 1 and got[0][2] == 1.0
    assert (got[0][4] - got[0][3]) > 0.95 * len(text.encode())


def test_words_left_out_all_along(frame):
    words = op.TEMPLATES["Apache-2.0 text"].split(" ")
    text = " ".join(w for i, w in enumerate(words) if i % 20 != 11)
    got = [r for r in scan(frame, [text]) if r[1] == "Apache-2.0 text"]
    assert len(got) == 1 and got[0][2] > 0.94


def test_a_drifting_copy_beside_plain_ones(frame):
    name = "MPL-2.0 text"
    plain = op.TEMPLATES[name]
    got = [r for r in scan(frame, ["\n".join([plain, with_words_put_in(plain, 15), plain])]) if r[1] == name]
    assert [r[2] for r in got] == [1.0] * 3
    assert all(a[4] <= b[3] for a, b in zip(got, got[1:]))


def test_bands_hold_every_drift():
    rng = np.random.default_rng(4)
    for _ in range(200):
        chain = sorted(rng.integers(0, 300, rng.integers(1, 30)).tolist())
        length = int(rng.integers(1, 200))
        bands = op.drifting(chain, length)
        for first in range(chain[0], chain[-1] + 1):
            last = min(first + length // 2, chain[-1])
            assert any(low <= first and last <= high for low, high in bands)
