"""Cutting texts into the pieces that byte-level BPE encodes one by one.

Both token operators need, for every piece of every text, something that
depends on the piece alone. Words repeat, so it is computed once for every
distinct chunk and kept by each Python worker in a bounded table.

A chunk is what lies between two single spaces, with the space before it. The
pattern lets only white space pieces look at the character behind them, so a
space between two characters that are not white space is always a place where
pieces part; other texts are cut as a whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: chunks that a Python worker keeps from block to block (about 200 bytes each);
#: chunks that come once in a block are not kept, and a larger table falls back to
#: what the last block repeats
KEPT_CHUNKS = 400_000


#: spaces that do not stand between two characters other than white space
_SPACE_FIRST, _SPACE_LAST = re.compile(r" \s").search, re.compile(r"[^\S ] ").search
#: characters that are a piece of their own at the end of a word
CLOSERS = frozenset(".,;:!?)")


@lru_cache(maxsize=4)
def compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


class ChunkTable:
    """Values of chunks; ``fill(piece lists)`` gives the value of each list of pieces.

    A chunk at the start of a text has no space before it; its key starts with a
    line break, which no chunk after a space does.
    """

    def __init__(self, pattern: str, fill: Callable[[list[list[str]]], list]):
        self.cut = compiled(pattern).findall
        self.fill = fill
        self.known: dict[str, object] = {}

    def _pieces(self, key: str) -> list[str]:
        if key[:1] == "\n":
            return self.cut(key[1:])
        if key.isalpha():
            return [" " + key]
        if key[-1:] in CLOSERS and key[:-1].isalpha():
            return [" " + key[:-1], key[-1]]
        return self.cut(" " + key)

    @staticmethod
    def _whole(text: str) -> bool:
        """Whether a text has spaces at which pieces need not part."""
        return (text[:1] == " " or text[-1:] == " " or _SPACE_FIRST(text) is not None
                or _SPACE_LAST(text) is not None)

    def values(self, texts: list[str], combine: Callable) -> list:
        """``combine`` of the values of the chunks of each text, in order.

        The texts are split twice, so that only their different chunks are held.
        """
        known = self.known
        seen: Counter[str] = Counter()
        whole = [*map(self._whole, texts)]

        def keys(at: int) -> list[str]:
            text = "\n" + texts[at]
            return [text] if whole[at] else text.split(" ")

        for at in range(len(texts)):
            seen.update(filterfalse(known.__contains__, keys(at)))
        new = list(seen)
        known.update(zip(new, self.fill([*map(self._pieces, new)])))
        get = known.__getitem__
        out = [combine(map(get, keys(at))) for at in range(len(texts))]
        for key, n in seen.items():
            if n == 1:
                del known[key]
        if len(known) > KEPT_CHUNKS:
            last = {key: known[key] for key, n in seen.items() if n > 1}
            self.known = last if len(last) <= KEPT_CHUNKS else {}
        return out


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of runs (start, size), run after run."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def string_bytes(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings and where each begins and ends among them."""
    _, at, data = strings.buffers()
    at = np.frombuffer(at, np.int64)[strings.offset:strings.offset + len(strings) + 1]
    return np.frombuffer(data or b"", np.uint8), at


def _odd(key: str) -> bool:
    """Whether a chunk is empty or has white space at an end (beyond the mark of a first one)."""
    if key[:1] != "\n":
        return not key or len(key.strip()) != len(key)
    return key == "\n" or len(key.rstrip()) != len(key)


def cut_block(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """(the different chunks of a block, the number of each chunk of all texts, chunks of each text).

    A chunk is what lies between two single spaces, with the space before it.
    The first chunk of a text has none; its key starts with a line break, which
    no chunk after a space does. A text in which a space stands beside white
    space or at an end is one chunk, as such a space need not part pieces.
    """
    marked = pa.array(["\n" + t for t in texts], pa.large_string())
    cut = pc.split_pattern(marked, " ")
    coded = cut.flatten().dictionary_encode()
    keys, at = coded.dictionary, coded.indices.to_numpy()
    n_chunks = np.diff(cut.offsets.to_numpy())
    # chunks that begin and end with a visible ASCII character are judged by these
    data, ends = string_bytes(keys)
    visible = np.append((data > 0x20) & (data < 0x7F), False)
    unsure = np.flatnonzero(~(visible[ends[:-1]] & visible[ends[1:] - 1] & (np.diff(ends) > 0)))
    some = keys.take(pa.array(unsure)).to_pylist()
    odd, broken = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    odd[unsure] = [*map(_odd, some)]
    broken[unsure] = [k[:1] == "\n" for k in some]
    row = np.repeat(np.arange(len(texts)), n_chunks)
    # a line break opens the first chunk alone
    broken = broken[at]
    broken[(np.cumsum(n_chunks) - n_chunks)] = False
    whole = np.zeros(len(texts), bool)
    whole[row[odd[at] | broken]] = True
    whole[n_chunks == 1] = False
    n = np.where(whole, 1, n_chunks)
    starts = np.cumsum(n) - n
    order = np.empty(int(n.sum()), np.int64)
    order[places(starts[~whole], n_chunks[~whole])] = at[~whole[row]]
    order[starts[whole]] = len(keys) + np.arange(int(whole.sum()))
    return pa.concat_arrays([keys, marked.filter(pa.array(whole))]), order, n
