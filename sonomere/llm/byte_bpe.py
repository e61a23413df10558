"""Byte-level BPE encoding by a segment tree of pair ranks, and decoding."""

import base64
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.llm.batches import id_and_text, slices
from sonomere.llm.caches import TwoGenerations, kept_by_worker
from sonomere.llm.pretokens import splitter


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token and its rank, one per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Merger:
    """Merges the bytes of one pre-token.

    Leaf ``i`` of the segment tree holds the rank of the pair that starts at byte ``i`` joined
    with ``i`` itself, so the root is the leftmost pair of least rank. A merge changes three
    leaves: the pair itself, the one that began at the swallowed part, and the one before; each
    change walks up to the root and stops where nothing changes any more.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __call__(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        never = (1 << 32) * n
        size = 1 << (n - 1).bit_length()
        tree = [never] * (2 * size)
        parts = [piece[i : i + 1] for i in range(n)]
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank * n + i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf: int, value: int) -> None:
            at = size + leaf
            tree[at] = value
            while at > 1:
                other = tree[at ^ 1]
                least = value if value < other else other
                at >>= 1
                if tree[at] == least:
                    return
                tree[at] = value = least

        def rank_at(i: int) -> int:
            j = after[i]
            rank = ranks.get(parts[i] + parts[j]) if j < n else None
            return never if rank is None else rank * n + i

        while tree[1] != never:
            i = tree[1] % n
            j = after[i]
            parts[i] += parts[j]
            parts[j] = b""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                put(j, never)
            put(i, rank_at(i))
            if before[i] >= 0:
                put(before[i], rank_at(before[i]))
        return [ranks[p] for p in parts if p]


# Bytes of the longest pre-tokens that are merged side by side, and leaves of the trees of one batch.
LONGEST_ROW = 128
BATCH_LEAVES = 1 << 18
_NEVER = 1 << 62
_ID_BITS = np.uint64(32)


class SideBySide:
    """Merges many pre-tokens at once: ``Merger`` with a segment tree in every row of a matrix.

    All rows take a step together. The roots say which pair each merges, three leaves of each row
    change, and the nodes above them are computed anew level by level; rows without a pair left
    drop out. Pairs of ids are looked up in a sorted table of all two parts of all tokens. Pre-tokens
    of more than ``LONGEST_ROW`` bytes are merged one by one.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.one_by_one = ranks, Merger(ranks)
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = {
            (ranks[token[:i]] << 32) | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.pair = np.fromiter(sorted(pairs), np.uint64, len(pairs))
        self.joined = np.fromiter((pairs[p] for p in self.pair.tolist()), np.int64, len(pairs))

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of every piece."""
        out: list[bytes] = [b""] * len(pieces)
        sizes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif 1 < len(piece) <= LONGEST_ROW:
                sizes.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
            elif piece:
                out[i] = np.array(self.one_by_one(piece), "<u4").tobytes()
        for size, which in sizes.items():
            rows = max(1, BATCH_LEAVES // size)
            for lo in range(0, len(which), rows):
                some = which[lo : lo + rows]
                for i, ids in zip(some, self._merged([pieces[i] for i in some], size)):
                    out[i] = ids
        return out

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """What the tree holds for pairs of ids at leaf ``at``; never, if they do not join."""
        if not len(self.pair):
            return np.full(len(left), _NEVER)
        key = (left.astype(np.uint64) << _ID_BITS) | right.astype(np.uint64)
        row = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[row] == key, self.joined[row] * size + at, _NEVER)

    def _merged(self, pieces: list[bytes], size: int) -> list[bytes]:
        n = len(pieces)
        data = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8)
        length = np.fromiter(map(len, pieces), np.int64, n)
        place = np.arange(n * size) % size
        alive = place < np.repeat(length, size)
        part = self.byte[data]
        if (part[alive] < 0).any():
            raise KeyError("a byte that is no token")
        # Neighbours as places in the flat matrix; -1 beyond either end.
        after = np.where(place + 1 < np.repeat(length, size), np.arange(1, n * size + 1), -1)
        before = np.where(place > 0, np.arange(-1, n * size - 1), -1)
        tree = np.full((n, 2 * size), _NEVER)
        pairs = np.flatnonzero(alive & (after >= 0))
        tree[pairs // size, size + place[pairs]] = self._leaves(
            part[pairs], part[pairs + 1], place[pairs], size
        )
        level = size // 2
        while level:
            below = tree[:, 2 * level : 4 * level]
            np.minimum(below[:, ::2], below[:, 1::2], out=tree[:, level : 2 * level])
            level //= 2
        tree = tree.ravel()
        row = np.arange(n)
        while True:
            root = tree[row * (2 * size) + 1]
            live = root != _NEVER
            row, root = row[live], root[live]
            if not len(row):
                break
            rank, leaf = root // size, root % size
            i = row * size + leaf
            j = after[i]
            k, h = after[j], before[i]
            part[i], alive[j] = rank, False
            after[i] = k
            has_k, has_h = k >= 0, h >= 0
            before[k[has_k]] = i[has_k]
            # The leaves of the pair's two halves and of the pair that ends in it.
            changed = np.full((3, len(row)), _NEVER)
            changed[0, has_k] = self._leaves(rank[has_k], part[k[has_k]], leaf[has_k], size)
            changed[2, has_h] = self._leaves(part[h[has_h]], rank[has_h], place[h[has_h]], size)
            node = np.stack([leaf, place[j], np.where(has_h, place[h], leaf)]) + size
            changed[2] = np.where(has_h, changed[2], changed[0])
            base = row * (2 * size)
            tree[base + node] = changed
            while node[0, 0] > 1:
                node >>= 1
                child = base + 2 * node
                tree[base + node] = np.minimum(tree[child], tree[child + 1])
        count = alive.reshape(n, size).sum(axis=1)
        packed = part[alive].astype("<u4").tobytes()
        stop = (4 * np.cumsum(count)).tolist()
        return [packed[a:b] for a, b in zip([0, *stop[:-1]], stop)]


class Encoder:
    """Packed ids of texts; a worker has one per vocabulary and keeps it over its tasks."""

    def __init__(self, vocabulary: str, pattern: str):
        self.ranks = read_ranks(vocabulary)
        self.token = {rank: piece for piece, rank in self.ranks.items()}
        self.split, self.merge = splitter(pattern), SideBySide(self.ranks)
        self.ids = TwoGenerations(lambda piece: self.merge([piece.encode()])[0])

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        pieces = [self.split(text) if text else [] for text in texts]
        missing = list(self.ids.unknown(set(chain.from_iterable(pieces))))
        new = dict(zip(missing, self.merge([piece.encode() for piece in missing])))
        for piece, ids in new.items():
            if len(piece) <= self.ids.longest:
                self.ids.put(piece, ids)
        # Those of this slice that the cache does not hold are in ``new``.
        known, cached = new.get, self.ids.__getitem__
        return [b"".join([known(p) or cached(p) for p in some]) for some in pieces]

    @staticmethod
    def of_worker(vocabulary: str, pattern: str) -> "Encoder":
        return kept_by_worker(f"byte bpe {vocabulary} {pattern}", lambda: Encoder(vocabulary, pattern))


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
    keep_text: bool = False, decoded: bool = False,
) -> DataFrame:
    """``(doc_id, ids)``: token ids as little-endian unsigned 32-bit integers in one binary.

    ``keep_text`` adds ``text``; ``decoded`` adds the bytes that the ids stand for, decoded from
    them in the same task.

    ``vocabulary`` is the path of a rank file on every worker; each match of ``pattern`` is
    encoded separately. Null and empty texts give an empty binary; repeated rows are encoded
    each; an empty table gives an empty one; other columns are ignored. Texts are encoded whole
    where they are read, a slice of rows at a time; a very long text is a slice of its own, and all
    its distinct pre-tokens are merged side by side. A pre-token is merged once per worker while
    cached.
    """
    source = id_and_text(docs, doc_id, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(vocabulary, pattern)
        for batch in batches:
            for part in slices(batch):
                ids = encoder(part.column(1).to_pylist())
                out = part.select(kept).append_column("ids", pa.array(ids, pa.binary()))
                if decoded:
                    texts = [_bytes_of(x, encoder.token) for x in ids]
                    out = out.append_column("decoded", pa.array(texts, pa.binary()))
                yield out

    kind = source.schema["doc_id"].dataType.simpleString()
    kept = ["doc_id", "text"] if keep_text else ["doc_id"]
    more = ", text string" if keep_text else ""
    last = ", decoded binary" if decoded else ""
    return source.mapInArrow(run, f"doc_id {kind}{more}, ids binary{last}")


def _bytes_of(ids: bytes, token: dict[int, bytes]) -> bytes:
    return b"".join(map(token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """The table with ``decoded``, the bytes of its packed ids; an unknown id is an error.

    Bytes, because a slice of a text's ids may end inside a character. Null ids give null.
    """
    kept = encoded.drop("decoded") if "decoded" in encoded.columns else encoded
    at = kept.columns.index(ids)
    names = [*kept.columns, "decoded"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in read_ranks(vocabulary).items()}
        for batch in batches:
            for part in slices(batch, at):
                decoded = [
                    None if x is None else _bytes_of(x, token)
                    for x in part.column(at).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())], names
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, decoded binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every text, encoded and decoded."""
    return encode(docs, vocabulary, pattern, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
