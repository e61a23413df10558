"""Pre-tokens of many texts and their ids as arrays, without a Python object per pre-token."""

import numpy as np
import regex

from sonomere.llm.batches import hashes
from sonomere.llm.caches import kept_by_worker

#: The one pattern these arrays follow: contractions, then runs of letters, numbers and other
#: characters with a space before them, then white space.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, OTHER, SPACE = range(4)
_BLANK, _APOSTROPHE = ord(" "), ord("'")


def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for name, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = "".join(regex.findall(pattern, every))
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = name
    return out


def runs(point: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of texts begin, and the class of each one's last character.

    ``point`` are the code points of all texts, ``edges`` where each begins and the last ends.
    Pre-tokens fill a text, so their beginnings say all. A run of one class begins one, with two
    exceptions: the last character of white space before something else is on its own, or, if it
    is a blank, belongs to what follows; and a lone apostrophe takes the letters of a contraction.
    """
    if not len(point):
        return np.empty(0, np.int64), np.empty(0, np.uint8)
    kind = kept_by_worker("classes", _classes)[point]
    opens = np.zeros(len(point) + 1, bool)  # where a text begins
    opens[edges] = True
    change = np.ones(len(point), bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= opens[:-1]
    start = np.flatnonzero(change)
    stop = np.append(start[1:], len(point))
    of = kind[start]
    follows = ~opens[stop]  # something follows in the same text
    white = of == SPACE

    begin = np.zeros(len(point), bool)
    begin[start[white]] = True
    begin[stop[white & follows] - 1] = True
    after_blank = np.zeros(len(start), bool)
    after_blank[1:] = white[:-1] & follows[:-1] & (point[stop[:-1] - 1] == _BLANK)
    begin[start[~white & ~after_blank]] = True

    lone = np.flatnonzero((point[start] == _APOSTROPHE) & (stop - start == 1) & ~after_blank & follows)
    lone = lone[of[np.minimum(lone + 1, len(of) - 1)] == LETTER]
    first = point[start[lone] + 1]
    second = np.where(stop[lone + 1] - start[lone + 1] > 1, point[np.minimum(start[lone] + 2, len(point) - 1)], 0)
    taken = np.isin(first, [ord(c) for c in "stmd"]).astype(np.int64)
    for a, b in ("re", "ve", "ll"):
        taken[(first == ord(a)) & (second == ord(b))] = 2
    lone, taken = lone[taken > 0], taken[taken > 0]
    begin[start[lone + 1]] = False
    rest = start[lone + 1] + taken
    begin[rest[rest < stop[lone + 1]]] = True

    start = np.flatnonzero(begin)
    return start, kind[np.append(start[1:], len(point)) - 1]


class IdTable:
    """Ids by 64-bit hash of a pre-token, at most ``entries``; when full, it starts anew."""

    def __init__(self, entries: int = 1 << 20):
        self.entries = entries
        self._empty()

    def _empty(self) -> None:
        self.key = np.empty(0, np.uint64)
        self.where = np.empty((0, 2), np.int64)  # first id and number of ids
        self.ids = np.empty(0, np.uint32)
        # Rows by the upper bits of their key, or in the next free slot; a quarter is used at most.
        self.bits = max(4 * self.entries - 1, 1).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The row of each key, -1 if unknown."""
        if not len(self.key):
            return np.full(len(key), -1, np.int64)
        slot = self._slot(key)
        row = self.slots[slot].astype(np.int64)
        left = np.flatnonzero((row >= 0) & (self.key[row] != key))
        while len(left):
            slot[left] = slot[left] + 1 & len(self.slots) - 1
            row[left] = self.slots[slot[left]]
            left = left[(row[left] >= 0) & (self.key[row[left]] != key[left])]
        return row

    def add(self, key: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Keys that are not there yet, each once."""
        if len(self.key) + len(key) > self.entries:
            self._empty()
        # More keys at once than entries: the slots grow with them.
        if len(key) > self.entries:
            self.bits = (4 * len(key) - 1).bit_length()
            self.slots = np.full(1 << self.bits, -1, np.int32)
        first = len(self.ids) + np.cumsum(count) - count
        row = (len(self.key) + np.arange(len(key))).astype(np.int32)
        self.ids = np.concatenate([self.ids, ids])
        self.key = np.concatenate([self.key, key])
        self.where = np.concatenate([self.where, np.stack([first, count], 1)])
        slot = self._slot(key)
        while len(row):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = row[free]
            left = self.slots[slot] != row  # taken before, or by another of these
            row, slot = row[left], slot[left] + 1 & len(self.slots) - 1

    def gather(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some rows, and how many each has."""
        first, count = self.where[row].T
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return self.ids[np.repeat(first, count) + inner], count


def encode(texts: list[str], table: IdTable, library) -> list[np.ndarray]:
    """Ids of every text. ``library(list of pre-tokens, whether white space)`` gives the ids of
    new pre-tokens, one after another, and how many each has.
    """
    joined = "".join(texts)
    point = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    start, last = runs(point, edges)
    if not len(start):
        return [np.empty(0, np.uint32) for _ in texts]
    size = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
    byte = np.concatenate([[0], np.cumsum(size)])
    stop = np.append(start[1:], len(point))
    data = np.frombuffer(joined.encode(), np.uint8)
    key = hashes(data, byte[start], byte[stop], lower=False)
    row = table.find(key)
    unknown = np.flatnonzero(row < 0)
    new = unknown[np.unique(key[unknown], return_index=True)[1]]
    if len(new) + len(table.key) > table.entries:
        table._empty()
        unknown = np.arange(len(key))
        new = np.unique(key, return_index=True)[1]
    found = []
    for white in (False, True):
        some = new[(last[new] == SPACE) == white]
        if len(some):
            pieces = [joined[a:b] for a, b in zip(start[some].tolist(), stop[some].tolist())]
            found.append((key[some], *library(pieces, white)))
    if found:
        table.add(*(np.concatenate(x) for x in zip(*found)))
        row[unknown] = table.find(key[unknown])
    ids, count = table.gather(row)
    edge = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, edges)]
    return [ids[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
