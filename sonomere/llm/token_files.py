"""Token ids in grammar-compressed files (Re-Pair), with random access.

A file table has one row per block of whole documents:

* ``shard``, ``block``: the task that wrote it and its number there; shards follow the order of
  doc_id, blocks the order inside a shard;
* ``start``: ids of the shard before this block; ``n_ids``: ids of the block;
* ``doc_ids``, ``doc_tokens``: its documents and their numbers of ids;
* ``first_rule``: symbols from here on are rules; ``rules``: pairs of symbols (u32);
  ``lengths``: ids that each rule stands for (u32); ``body``: the symbols, u16 or u32 by ``width``.

All integers are little-endian.
"""

import os
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sonomere.llm import token_runs
from sonomere.llm.batches import id_and_text, slices
from sonomere.llm.caches import kept_by_worker

BLOCK_IDS = 1 << 19
# The least uses of a rule.
LEAST_USES = 4

_COLUMNS = (
    "shard int, block int, start bigint, n_ids bigint, doc_ids array<{kind}>, "
    "doc_tokens array<int>, first_rule bigint, rules binary, lengths binary, width int, body binary"
)


class Encoder:
    """Ids of texts by the ``tokenizers`` library, asked once per pre-token in the worker's table."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first_rule = self.tokenizer.get_vocab_size(with_added_tokens=True)
        (self.line_end,) = self._whole("\n")
        self.table = token_runs.IdTable()

    def _whole(self, text: str) -> list[int]:
        # The same ids as of ``encode``, without its offsets into the text.
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        plain = ["" if not t or any(s in t for s in self.special) else t for t in texts]
        found = token_runs.encode(plain, self.table, self._pieces)
        return [
            np.array(self._whole(text), np.uint32) if text and not p else ids
            for text, p, ids in zip(texts, plain, found)
        ]

    def _pieces(self, pieces: list[str], white: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new pre-tokens. All but white space go in as lines of one text: a line end is a
        pre-token of its own with one id, which marks where the next piece's ids begin.
        """
        if not white:
            ids = np.array(self._whole("\n".join(pieces)), np.uint32)
            marks = np.flatnonzero(ids == self.line_end)
            # Else: a character that only one of the two pattern engines knows.
            if len(marks) == len(pieces) - 1:
                edges = np.concatenate([[-1], marks, [len(ids)]])
                return np.delete(ids, marks), np.diff(edges) - 1
        each = [self._whole(p) for p in pieces]
        return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each])


def worker_encoder(vocabulary: str) -> Encoder:
    """The encoder of this worker process: its table serves all tasks that run there."""
    return kept_by_worker(f"encoder {vocabulary}", lambda: Encoder(vocabulary))


def compress(ids: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair in rounds: ``(body, rules, lengths)``.

    A round counts all neighbouring pairs, takes every pair with enough uses, and replaces them
    from left to right without overlap; a pair whose uses overlapped away keeps its symbols. Rounds
    go on until no pair is left that could be used ``LEAST_USES`` times.
    """
    symbols = ids.astype(np.int64)
    rules = [np.empty((0, 2), np.int64)]
    n_rules, size = 0, np.empty(0, np.int64)
    # Where a pair begins that may have enough uses: after a round, one with a new symbol, or one that
    # had enough and was not replaced. Uses of all others can only have become fewer.
    again = np.ones(len(symbols), bool)
    while len(symbols) >= 2 * LEAST_USES:
        places = np.flatnonzero(again[:-1])
        pair = symbols[places] << 32 | symbols[places + 1]
        keys, uses = np.unique(pair, return_counts=True)
        keys = keys[uses >= LEAST_USES]
        if not len(keys):
            break
        which, maybe = _find(pair, keys)
        # Of pairs whose neighbours were taken first, too few uses may be left for a rule.
        some = np.flatnonzero(which >= 0)
        chosen = some[_every_other(places[some])]
        left = np.bincount(which[chosen], minlength=len(keys))
        chosen = chosen[left[which[chosen]] >= LEAST_USES]
        if not len(chosen):
            which, maybe = _find(pair, keys, exact=True)
            chosen = _key_after_key(places, which, len(keys), len(symbols))
            if not len(chosen):
                break
        at, which_at = places[chosen], which[chosen]
        taken = np.flatnonzero(np.bincount(which_at, minlength=len(keys)))
        number = np.zeros(len(keys), np.int64)
        number[taken] = first_rule + n_rules + np.arange(len(taken))
        new = np.stack([keys[taken] >> 32, keys[taken] & 0xFFFFFFFF], 1)
        size = np.concatenate([size, _lengths(new, size, first_rule)])
        rules.append(new)
        n_rules += len(taken)
        symbols[at] = number[which_at]
        again[:] = False
        again[places[maybe]] = again[at] = again[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, again = symbols[keep], again[keep]
    return symbols, np.concatenate(rules), size


def _find(pair: np.ndarray, keys: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Position of every pair in ``keys``, or -1, and where a pair may be one of them. Many pairs are
    looked up in a table of slots: of keys that share one a single one is found, and the others wait
    for the next round.
    """
    if exact or len(pair) < 1 << 15:
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        which = np.where(keys[at] == pair, at, -1)
        return which, which >= 0
    slots = np.full(1 << 18, -1, np.int32)
    slots[_slot(keys)] = np.arange(len(keys), dtype=np.int32)
    which = slots[_slot(pair)]
    maybe = which >= 0
    which[maybe & (keys[which] != pair)] = -1
    return which, maybe


def _slot(pair: np.ndarray) -> np.ndarray:
    return pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)


def _key_after_key(places: np.ndarray, which: np.ndarray, n_keys: int, n: int) -> np.ndarray:
    """Which of the places to replace, if pairs take each other's uses away: key after key takes what
    those before it left, where that is enough.
    """
    free = np.ones(n, bool)
    order = np.argsort(which, kind="stable")  # places of no key come first
    edges = np.searchsorted(which[order], np.arange(n_keys + 1))
    chosen = [np.empty(0, np.int64)]
    for key in range(n_keys):
        mine = order[edges[key] : edges[key + 1]]
        at = places[mine]
        mine = mine[free[at] & free[at + 1]]
        mine = mine[_every_other(places[mine])]
        if len(mine) >= LEAST_USES:
            chosen.append(mine)
            free[places[mine]] = free[places[mine] + 1] = False
    return np.sort(np.concatenate(chosen))


def _every_other(at: np.ndarray) -> np.ndarray:
    """Every other one of each run of consecutive positions, from its first."""
    if not len(at):
        return np.empty(0, bool)
    begins = np.ones(len(at), bool)
    begins[1:] = np.diff(at) > 1
    first = np.maximum.accumulate(np.where(begins, at, 0))
    return (at - first) % 2 == 0


def _lengths(pairs: np.ndarray, size: np.ndarray, first_rule: int) -> np.ndarray:
    if not len(size):
        return np.full(len(pairs), 2, np.int64)
    one = np.where(pairs >= first_rule, size[np.maximum(pairs - first_rule, 0)], 1)
    return one.sum(axis=1)


def _rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids that each rule stands for; a rule holds only rules before it."""
    out = []
    for a, b in rules.tolist():
        out.append(sum(out[x - first_rule] if x >= first_rule else 1 for x in (a, b)))
    return np.array(out, np.int64)


def expand(
    symbols: np.ndarray, rules: np.ndarray, first_rule: int, lengths: np.ndarray | None = None
) -> np.ndarray:
    """Ids that a run of symbols stands for: each rule's pair goes where the rule begins, and all
    rules in these pairs are replaced next.
    """
    if lengths is None:
        lengths = _rule_lengths(rules, first_rule)

    def size(x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), np.int64)
        rule = np.flatnonzero(x >= first_rule)
        out[rule] = lengths[x[rule] - first_rule]
        return out

    each = size(symbols)
    at = np.cumsum(each) - each
    out = np.empty(int(each.sum()), np.int64)
    while True:
        rule = symbols >= first_rule
        out[at[~rule]] = symbols[~rule]
        if not rule.any():
            return out
        left, right = rules[symbols[rule] - first_rule].T
        at = at[rule]
        at = np.concatenate([at, at + size(left)])
        symbols = np.concatenate([left, right])


class Block:
    """One row of a file table, decoded as far as asked."""

    def __init__(self, first_rule: int, rules: bytes, lengths: bytes, width: int, body: bytes):
        self.first_rule = first_rule
        self.rules = np.frombuffer(rules, "<u4").reshape(-1, 2).astype(np.int64)
        self.body = np.frombuffer(body, f"<u{width}").astype(np.int64)
        self.lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
        each = np.ones(len(self.body), np.int64)
        is_rule = self.body >= first_rule
        each[is_rule] = self.lengths[self.body[is_rule] - first_rule]
        self.stops = np.cumsum(each)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block; only the symbols that cover them are expanded."""
        total = int(self.stops[-1]) if len(self.stops) else 0
        stop = total if stop is None else min(stop, total)
        if start >= stop:
            return np.empty(0, "<u4")
        first = int(np.searchsorted(self.stops, start, "right"))
        last = int(np.searchsorted(self.stops, stop, "left"))
        skipped = start - (int(self.stops[first - 1]) if first else 0)
        found = expand(self.body[first : last + 1], self.rules, self.first_rule, self.lengths)
        return found[skipped : skipped + stop - start].astype("<u4")


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    block_ids: int = BLOCK_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode all texts and write them as compressed blocks in ascending order of doc_id.

    Documents are range-partitioned by id, so every task writes one shard of neighbours whatever
    the number of documents, and ids never leave the task that made them. A null doc_id comes
    first; rows with the same id follow by text; null and empty texts have the end id alone; an
    empty table gives an empty file; other columns are ignored. A document is never split, so a
    block holds ``block_ids`` ids or one longer document.
    """
    source = id_and_text(docs, doc_id, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = _COLUMNS.format(kind=kind)
    end = np.array([end_id], np.uint32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids, keys, held = [], [], 0

        def cut() -> pa.RecordBatch:
            nonlocal block, start, held
            counts = [len(x) + 1 for x in ids]
            all_ids = np.concatenate([x for each in ids for x in (each, end)])
            body, rules, lengths = compress(all_ids, encoder.first_rule)
            width = 2 if encoder.first_rule + len(rules) <= 1 << 16 else 4
            row = {
                "shard": shard, "block": block, "start": start, "n_ids": sum(counts),
                "doc_ids": keys[:], "doc_tokens": counts, "first_rule": encoder.first_rule,
                "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(),
                "width": width, "body": body.astype(f"<u{width}").tobytes(),
            }
            block, start, held = block + 1, start + row["n_ids"], 0
            ids.clear()
            keys.clear()
            return pa.RecordBatch.from_pylist([row], arrow_schema)

        for batch in batches:
            arrow_schema = _arrow_schema(batch.schema.field(0).type)
            for part in slices(batch):
                names = part.column(0).to_pylist()
                for key, found in zip(names, encoder(part.column(1).to_pylist())):
                    if keys and held + len(found) + 1 > block_ids:
                        yield cut()
                    ids.append(found)
                    keys.append(key)
                    held += len(found) + 1
        if keys:
            yield cut()

    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.parquet(path)


def _arrow_schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(key)), ("doc_tokens", pa.list_(pa.int32())),
        ("first_rule", pa.int64()), ("rules", pa.binary()), ("lengths", pa.binary()),
        ("width", pa.int32()), ("body", pa.binary()),
    ])


def _with_start(files: DataFrame) -> DataFrame:
    """Blocks with ``start`` counted from the first shard: one row per shard is put in order."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("__n"))
    shards = shards.select("shard", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    # Shards are as few as tasks; blocks stay where they are read.
    return files.join(F.broadcast(shards), "shard").withColumn("start", F.col("start") + F.col("__before"))


def read_token_files(
    files: DataFrame, of: Callable[[np.ndarray], object], name: str, kind: str
) -> DataFrame:
    """``(doc_id, start, n_tokens, <name>)`` of every document in a file table.

    ``start`` counts the ids of all documents before it; ``of`` turns a document's ids into one
    value of SQL type ``kind``, in the task that expands its block.
    """
    key = files.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {key}, start bigint, n_tokens bigint, `{name}` {kind}"
    columns = ["start", "doc_ids", "doc_tokens", "first_rule", "rules", "lengths", "width", "body"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key_type = batch.schema.field("doc_ids").type.value_type
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in columns}
                block = Block(*(row[c] for c in columns[3:]))
                ids, counts = block.ids(), np.array(row["doc_tokens"], np.int64)
                stops = np.cumsum(counts)
                values = [of(ids[b - n : b]) for b, n in zip(stops.tolist(), counts.tolist())]
                out = pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], key_type),
                        pa.array(row["start"] + stops - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(values),
                    ],
                    ["doc_id", "start", "n_tokens", name],
                )
                yield out

    return _with_start(files).select(*columns).mapInArrow(run, schema)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())
