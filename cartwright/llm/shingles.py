"""Sets of hashed 5-word shingles, computed for blocks of texts at once."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

#: words in a shingle
WIDTH = 5
#: word hashes that a worker keeps
KEPT_WORDS = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, with A to Z lower-cased."""
    return text.encode().lower().split()


class Shingler:
    """Word hashes met so far and the shingle sets of blocks of texts."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def word_hashes(self, rows: list[list[bytes]]) -> np.ndarray:
        missing = set(chain.from_iterable(rows))
        if len(self.known) > KEPT_WORDS:
            self.known = {w: h for w in missing if (h := self.known.get(w)) is not None}
        for word in missing - self.known.keys():
            self.known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(self.known.__getitem__, chain.from_iterable(rows)), np.uint64,
                           sum(map(len, rows)))

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all sets one after the other, ascending in each; size of each set).

        A text of fewer than 5 words has its whole sequence as one shingle, a
        text without words has none.
        """
        rows = [words_of(t) for t in texts]
        words = self.word_hashes(rows)
        counts = np.array([len(r) for r in rows], np.int64)
        starts = np.cumsum(counts) - counts
        folded = words.copy()
        for j in range(1, WIDTH):
            upto = max(len(words) - j, 0)
            folded[:upto] = ((folded[:upto] ^ (folded[:upto] >> np.uint64(32))) * _ODD
                             + words[j:])
        place = np.arange(len(words)) - np.repeat(starts, counts)
        hashes = folded[place <= np.repeat(counts, counts) - WIDTH]
        sizes = np.maximum(counts - WIDTH + 1, 0)
        short = np.flatnonzero((counts > 0) & (counts < WIDTH))
        if len(short):
            whole = [xxhash.xxh64_intdigest(b" ".join(rows[i])) for i in short.tolist()]
            hashes = np.insert(hashes, np.cumsum(sizes)[short], np.array(whole, np.uint64))
            sizes[short] = 1
        hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
        hashes ^= hashes >> np.uint64(29)
        ends = np.cumsum(sizes)
        first = np.zeros(len(hashes), bool)
        for start, end in zip((ends - sizes).tolist(), ends.tolist()):
            if end > start:
                hashes[start:end].sort()
                first[start] = True
        keep = first.copy()
        keep[1:] |= hashes[1:] != hashes[:-1]
        upto = np.concatenate(([0], np.cumsum(keep)))
        return hashes[keep], upto[ends] - upto[ends - sizes]
