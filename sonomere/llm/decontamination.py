"""Benchmark items inside documents: rare n-gram seeds, then word-level Smith-Waterman alignment."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.llm.batches import flat, hashes, id_and_text, shingles, slices, spans

SEED_WORDS = 3
# A seed is rare if unrelated text has it at no more than this share of its words.
RARE = 1e-6
# Every item has at least this many seeds, its rarest ones.
LEAST_SEEDS = 4
THRESHOLD = 0.5
# Bytes of item text that are broadcast at once; more items are taken in blocks.
BLOCK_BYTES = 16 << 20

MATCH, MISMATCH, GAP = 1, -1, -1
# Cells of one alignment step.
_CELLS = 1 << 21

# Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words(column: pa.Array):
    """``(hash, row, n_rows)`` of the words of a column; A-Z count as a-z."""
    data, offsets = flat(column)
    start, end, row = spans(data, offsets, _SEPARATOR)
    return hashes(data, start, end), row, len(column)


@dataclass(frozen=True)
class Items:
    """Words of a block of items, item after item."""

    ids: list
    word: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(table: pa.Table) -> "Items":
        column = table.column(1).cast(pa.string()).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        word, row, n = words(column)
        start = np.searchsorted(row, np.arange(n + 1))
        return Items(table.column(0).to_pylist(), word, start)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.start))


@dataclass(frozen=True)
class Seeds:
    """Sorted n-gram hashes with the item and the word each stands for."""

    key: np.ndarray
    item: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(items: Items, share: np.ndarray, n: int, rare: float, least: int) -> "Seeds":
        """``share`` is the part of all corpus words that each item word makes up."""
        key, item, first = shingles(items.word, items.row, len(items.ids), n)
        log_share = np.concatenate([[0.0], np.cumsum(np.log(np.maximum(share, 1e-300)))])
        stop = np.minimum(first + n, items.start[item + 1])
        chance = log_share[stop] - log_share[first]
        order = np.lexsort((chance, item))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept = np.flatnonzero((chance <= np.log(rare)) | (place < least))
        kept = kept[np.argsort(key[kept], kind="stable")]
        return Seeds(key[kept], item[kept], first[kept] - items.start[item[kept]])

    def filter(self) -> np.ndarray:
        """A table of 2^20 slots that tells most words of a text from seeds."""
        slots = np.zeros(1 << 20, bool)
        slots[self.key >> np.uint64(44)] = True
        return slots

    def hits(self, key: np.ndarray, slots: np.ndarray):
        """``(position in key, seed)`` of every n-gram that is a seed."""
        maybe = np.flatnonzero(slots[key >> np.uint64(44)])
        low = np.searchsorted(self.key, key[maybe], "left")
        count = np.searchsorted(self.key, key[maybe], "right") - low
        where = np.repeat(maybe, count)
        within = np.arange(len(where)) - np.repeat(np.cumsum(count) - count, count)
        return where, np.repeat(low, count) + within


def align(item: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair of rows: ``(score, words of item, words of window)`` up to
    its end.

    Rows are padded with 0 (items) and 1 (windows), which match nothing. A row of the matrix is
    filled for all pairs at once; gaps along it are a running maximum.
    """
    n, w = window.shape
    slope = np.arange(w + 1, dtype=np.int32) * -GAP
    above = np.zeros((n, w + 1), np.int32)
    best, item_end, window_end = (np.zeros(n, np.int64) for _ in range(3))
    for i in range(item.shape[1]):
        step = np.where(item[:, i : i + 1] == window, MATCH, MISMATCH).astype(np.int32)
        row = np.zeros((n, w + 1), np.int32)
        row[:, 1:] = np.maximum(above[:, :-1] + step, above[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        at = row.argmax(axis=1)
        score = row[np.arange(n), at]
        better = score > best
        best[better], item_end[better], window_end[better] = score[better], i + 1, at[better]
        above = row
    return best, item_end, window_end


def _padded(parts: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(parts), max(map(len, parts), default=0)), fill, np.uint64)
    for i, p in enumerate(parts):
        out[i, : len(p)] = p
    return out


def _aligned(items: list[np.ndarray], windows: list[np.ndarray]):
    """``(score, start, end)`` in words of the window for every pair, in groups of like size."""
    score, start, end = (np.zeros(len(items), np.int64) for _ in range(3))
    order = sorted(range(len(items)), key=lambda i: (len(windows[i]), len(items[i])))
    while order:
        width = len(windows[order[-1]]) + 1
        group = order[-max(1, _CELLS // width) :]
        del order[-len(group) :]
        a, b = [items[i] for i in group], [windows[i] for i in group]
        best, item_end, window_end = align(_padded(a, 0), _padded(b, 1))
        # The start is the end of the best alignment of both reversed from there.
        a = [x[:n][::-1] for x, n in zip(a, item_end)]
        b = [x[:n][::-1] for x, n in zip(b, window_end)]
        _, _, back = align(_padded(a, 0), _padded(b, 1))
        score[group], start[group], end[group] = best, window_end - back, window_end
    return score, start, end


def _windows(row, first, seeds: Seeds, seed, items: Items, row_start, row_stop):
    """Stretches of a text in which an item may lie: ``(row, item, from, to)``.

    A hit puts the item's start at one word of the text; hits of a (text, item) pair whose starts
    are at most half an item apart share a stretch, so an edited copy is aligned once and two
    copies twice.
    """
    item = seeds.item[seed]
    size = np.diff(items.start)[item]
    begin = first - seeds.at[seed]
    order = np.lexsort((begin, item, row))
    row, item, begin, size = row[order], item[order], begin[order], size[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (np.diff(begin) > size[1:] // 2 + 2)
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(row)]]) - 1 if len(at) else at
    slack = size[at] // 2 + 2
    low = np.maximum(begin[at] - slack, row_start[row[at]])
    high = np.minimum(begin[last] + size[at] + slack, row_stop[row[at]])
    return row[at], item[at], low, high


def _word_shares(docs: DataFrame, items: Items) -> np.ndarray:
    """Share of all corpus words that equal each item word. One row of counts per task moves."""
    vocabulary = np.unique(items.word)
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = known.value
        counts = np.zeros(len(names) + 1, np.int64)
        slots = np.zeros(1 << 20, bool)
        slots[names >> np.uint64(44)] = True
        for batch in batches:
            for part in slices(batch, 0):
                h, _, _ = words(part.column(0))
                counts[-1] += len(h)
                h = h[slots[h >> np.uint64(44)]]
                at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                counts[:-1] += np.bincount(at[names[at] == h], minlength=len(names))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["word", "n"]
        )

    counted = docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word")
    table = counted.agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(vocabulary) + 1, np.int64)
    counts[table.column(0).to_numpy()] = table.column(1).to_numpy()
    total = max(1, int(counts[-1]))
    # Half a count for words the corpus does not have.
    return (counts[np.searchsorted(vocabulary, items.word)] + 0.5) / total


def _found(docs: DataFrame, items: Items, seeds: Seeds, n: int, threshold: float, kind: str) -> DataFrame:
    # Arrays alone: workers need not have these classes to read a broadcast.
    parts = (items.ids, items.word, items.start), (seeds.key, seeds.item, seeds.at)
    sent = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seeds = Items(*sent.value[0]), Seeds(*sent.value[1])
        slots, size = seeds.filter(), np.diff(items.start)
        for batch in batches:
            for part in slices(batch):
                word, of, n_rows = words(part.column(1))
                key, row, first = shingles(word, of, n_rows, n)
                where, seed = seeds.hits(key, slots)
                edges = np.searchsorted(of, np.arange(n_rows + 1))
                row, item, low, high = _windows(
                    row[where], first[where], seeds, seed, items, edges[:-1], edges[1:]
                )
                score, start, end = _aligned(
                    [items.word[items.start[i] : items.start[i + 1]] for i in item],
                    [word[a:b] for a, b in zip(low, high)],
                )
                share = score / np.maximum(size[item], 1)
                keep = np.flatnonzero(share >= threshold)
                begin = low[keep] - edges[row[keep]]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row[keep])),
                        pa.array(item[keep], pa.int64()),
                        pa.array(size[item[keep]], pa.int64()),
                        pa.array(share[keep], pa.float64()),
                        pa.array(begin + start[keep], pa.int64()),
                        pa.array(begin + end[keep], pa.int64()),
                    ],
                    ["doc_id", "item", "n_words", "score", "start_word", "end_word"],
                )

    schema = f"doc_id {kind}, item bigint, n_words bigint, score double, start_word bigint, end_word bigint"
    return docs.mapInArrow(run, schema)


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    seed_words: int = SEED_WORDS,
    rare: float = RARE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, n_words, score, start_word, end_word)`` of every item found.

    ``score`` is the best local alignment of the item's words with the text's (a match is worth
    1, a mismatch or a gap costs 1) over the words of the item; the span is where it lies in the
    text. Alignments start from seeds: n-grams of an item that unrelated text would hold at no
    more than a share ``rare`` of its words, judged by the counts of their words over all
    documents, and always the rarest few of an item. A passage that leaked into very many
    documents therefore keeps its seeds.

    One row per (doc_id, item_id), the best place; of places with one score the first. An item of
    fewer words than a seed is found only where it is the whole text; null and empty texts and
    items match nothing; repeated rows count once; an empty table gives an empty one; other columns
    are ignored. A very long text is searched whole and by one task, but only the stretches around
    its seeds are aligned. Items are broadcast in blocks of ``BLOCK_BYTES``, and documents are read
    twice per block: that many scans are the price of a benchmark of any size.
    """
    source = id_and_text(docs, doc_id, text)
    table = benchmark.select(
        F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text")
    ).filter("length(trim(text)) > 0")
    size = table.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES)
    kind = source.schema["doc_id"].dataType.simpleString()
    item_kind = table.schema["item_id"].dataType.simpleString()
    found = docs.sparkSession.createDataFrame(
        [], f"doc_id {kind}, n_words bigint, score double, start_word bigint, end_word bigint,"
        f" item_id {item_kind}"
    )
    for block in range(n_blocks):
        mine = table.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        items = Items.of(mine.toArrow())
        if not len(items.word):
            continue
        share = _word_shares(source, items)
        seeds = Seeds.of(items, share, seed_words, rare, LEAST_SEEDS)
        rows = _found(source, items, seeds, seed_words, threshold, kind)
        names = docs.sparkSession.createDataFrame(
            list(enumerate(items.ids)), f"item bigint, item_id {item_kind}"
        )
        rows = rows.join(names, "item").drop("item")
        found = found.unionByName(rows)
    best = F.max_by(
        F.struct("n_words", "score", "start_word", "end_word"),
        F.struct("score", -F.col("start_word"), -F.col("n_words")),
    )
    best = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return best.select("doc_id", "item_id", "b.n_words", "b.score", "b.start_word", "b.end_word")
