import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cardledger.llm import packing as op
from cardledger.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, length string, start string"


def check(rows, size):
    """Sequences are filled from 0 without a gap, and none is longer than `size`."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_round_trip(spark, frame):
    rng = random.Random(1)
    texts = [None, "", " ", "a", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext", "é" * 50, "x" * 5000, " " * 300, "\n\n\t  a"]
    texts += [" ".join(rng.choice(["Der", "le", "foo!", "12", "ß", "\n"]) for _ in range(rng.randint(1, 4000))) for _ in range(60)]
    texts += [texts[-1]]
    docs = frame([(i, t, "l", "s") for i, t in enumerate(texts)], SCHEMA)
    rows = op.pack_documents(docs, vocabulary()).collect()
    tokenizer = Tokenizer.from_file(vocabulary().tokenizer_path)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    n = check(rows, op.SIZE)
    total = sum(r.length for r in rows)
    assert n <= 1.1 * total / op.SIZE + 1


def test_long_texts_are_cut_where_tokens_end(monkeypatch):
    enc = op.encoder(vocabulary().ranks_path, vocabulary().pattern)
    text = "The cats' 12 houses,  and é trees \n\n x" * 40
    whole = op.encode(enc, text, vocabulary().tokenizer_path)
    monkeypatch.setattr(op, "BLOCK_CHARS", 7)
    assert (op.encode(enc, text, vocabulary().tokenizer_path) == whole).all()


@pytest.mark.parametrize("seed", range(5))
def test_patterns_place_all_lengths(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 50): rng.randint(1, 400) for _ in range(rng.randint(1, 30))}
    packed = op.patterns(histogram, 50)
    placed = {}
    for pattern, count in packed:
        assert sum(length * n for length, n in pattern) <= 50
        for length, n in pattern:
            placed[length] = placed.get(length, 0) + n * count
    assert placed == histogram
    # Longest first into the emptiest pack: the same number of packs as placing piece by piece.
    packs = []
    for length in sorted((l for l, n in histogram.items() for _ in range(n)), reverse=True):
        room = min((p for p in packs if p + length <= 50), default=None)
        if room is not None:
            packs.remove(room)
        packs.append((room or 0) + length)
    assert sum(n for _, n in packed) == len(packs)


def test_empty_table_and_one_length(frame):
    assert op.pack_documents(frame([], SCHEMA), vocabulary()).count() == 0
    rows = op.pack_documents(frame([(i, "a b", "", "") for i in range(3000)], SCHEMA), vocabulary()).collect()
    assert check(rows, op.SIZE) == -(-3000 // (op.SIZE // rows[0].length))
