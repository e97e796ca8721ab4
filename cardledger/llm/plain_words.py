"""Words between ASCII white space ([^\\x20\\x09-\\x0D]+) of whole groups of texts, as numbers."""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np

GROUP_BYTES = 1 << 20  # texts worked on at a time; a longer text is a group of its own


class PlainWords:
    """`id` per word (equal exactly where the words are), `first[i]:first[i+1]` are those of text i."""

    def __init__(self, texts: list[bytes]):
        self.words = [t.split() for t in texts]  # bytes.split() cuts at 0x20 and 0x09 to 0x0D
        self.first = np.cumsum([0] + [len(w) for w in self.words])
        n = int(self.first[-1])
        self.kinds = list(dict.fromkeys(chain.from_iterable(self.words)))
        number = dict(zip(self.kinds, range(len(self.kinds))))
        self.id = np.fromiter(map(number.__getitem__, chain.from_iterable(self.words)), np.int64, n)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.words)), np.diff(self.first))

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit names per word, the same in every task: halves of a cryptographic digest."""
        digests = b"".join(hashlib.blake2b(w, digest_size=16).digest() for w in self.kinds)
        both = np.frombuffer(digests, np.uint64).reshape(-1, 2)[self.id]
        return both[:, 0], both[:, 1]
