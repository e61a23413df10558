"""Repeated passages: MinHash bands of paragraphs, exact Jaccard similarity, components."""

import itertools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sonomere.llm import pairing
from sonomere.llm.batches import (
    flat, hashes, id_and_text, mix, sequence_hashes, shingles, slices, spans,
)
from sonomere.llm.components import components
from sonomere.llm.near_dups import text_sets
from sonomere.storage import shuffles_released, written

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9995
# Hashes of a band: eleven bands of three have the recall of fifteen of four.
ROWS = 3
# Words of the shortest passage, and of the shortest sentence that stands for itself.
LEAST_WORDS = 20
SENTENCE_WORDS = 8
# Of so many passages of the least size in a row, one at least is a unit.
SPREAD = 15
# Keys of bands go to parts by their first bits, in blocks: these bits and bytes of a key are compared,
# so one in 2**52 pairs meets for nothing; so many keys a task packs and a part holds at once.
PART_BITS = 12
KEY_BYTES = 5
BLOCK_KEYS = 1 << 20
PART_KEYS = 1 << 22
# Places of paragraphs go to as many parts by the first bits of their names, after those of the keys.
PLACE_BITS = 10
PLACES_FROM = 1 << PART_BITS
SETTLED_FROM = PLACES_FROM + (1 << PLACE_BITS)
SETTLED_ROWS = 1 << 12

_LINE_END = np.arange(256) == 0x0A
# The characters that end a sentence.
_SENTENCE_ENDS = [c.encode() for c in ".!?।॥。！？｡؟۔"]
_LAST_BYTE = np.isin(np.arange(256), [mark[-1] for mark in _SENTENCE_ENDS])


def tune(similarity: float, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` hashes each that bring a pair of that similarity together with at least
    the chance ``recall``.
    """
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def _signatures(h: np.ndarray, edges: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of every stretch of ``h``; odd multipliers stand for permutations."""
    out = np.empty((len(edges) - 1, n), np.uint64)
    for i, factor in enumerate(mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)):
        value = h * factor
        value ^= value >> np.uint64(32)
        out[:, i] = np.minimum.reduceat(value * factor, edges[:-1])
    return out


def _band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.shape[1] // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    for j in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, j::rows][:, :bands])
    return key


def _ends_sentence(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For every word, whether its last character ends a sentence."""
    found = np.zeros(len(end), bool)
    likely = np.flatnonzero(_LAST_BYTE[data[end - 1]])
    start, end = start[likely], end[likely]
    for mark in _SENTENCE_ENDS:
        same = end - start >= len(mark)
        for j, byte in enumerate(reversed(mark)):
            same[same] = data[end[same] - 1 - j] == byte
        found[likely[same]] = True
    return found


def _passages_at(word: np.ndarray, row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and name of some passages of ``least`` words, chosen by their words alone.

    Winnowing: the least name of any ``SPREAD`` passages in a row of a text, so texts that share
    ``least + SPREAD - 1`` words in a row share a passage in them, wherever they stand.
    """
    first = np.arange(max(len(word) - least + 1, 0))
    first = first[row[first] == row[first + least - 1]]
    # Lines and sentences are not to share names with these, which may lie inside them.
    name = mix(~sequence_hashes(word, first, first + least))
    start = np.flatnonzero(np.append(True, row[first][1:] != row[first][:-1]))[: len(first)]
    size = np.diff(np.append(start, len(first)))
    group = np.repeat(np.arange(len(start)), size)
    last = (start + np.maximum(size - SPREAD, 0))[group]
    at = np.arange(len(first))
    least_at = at.copy()
    for j in range(1, SPREAD):
        other = np.minimum(at + j, (start + size - 1)[group])
        least_at = np.where(name[other] < name[least_at], other, least_at)
    chosen = np.unique(least_at[at <= last])
    return first[chosen], name[chosen]


@dataclass
class Units:
    """Paragraphs of a slice of texts: whole lines (part 0), inside lines sentences (1, 2, ...), and
    passages of the least size (-1 and less: the word of the line they begin with, from 1).

    Passages are often pasted into the middle of a line; its sentences still agree. A sentence
    with fewer than ``SENTENCE_WORDS`` words is joined with the next one, so the cuts in a passage
    agree again after its first long sentence, whatever stands before it. Passages need no
    sentence ends; they may go on over line ends.
    """

    row: np.ndarray
    line: np.ndarray
    part: np.ndarray
    first: np.ndarray  # words
    stop: np.ndarray
    before: np.ndarray  # words of the text before it
    name: np.ndarray
    word: np.ndarray
    word_start: np.ndarray  # bytes
    word_end: np.ndarray

    @staticmethod
    def of(texts: pa.Array, least: int, passages: bool = False) -> "Units":
        data, offsets = flat(texts)
        start, _, text = spans(data, offsets, _LINE_END)
        # Lines are numbered by the line ends before them in their text.
        ends = np.concatenate([[0], np.cumsum(data == 0x0A)])
        line = ends[start] - ends[offsets[text]]
        a, b, row = spans(data, offsets)
        word = hashes(data, a, b)
        begin = first = np.searchsorted(a, start)
        stop = np.append(first[1:], len(a))
        units = _sentences(first, stop, np.flatnonzero(_ends_sentence(data, a, b)) + 1, least)
        of, part, first, stop = (np.array(x, np.int64) for x in units)
        long = stop - first >= np.where(part == 0, least, SENTENCE_WORDS)
        of, part, first, stop = of[long], part[long], first[long], stop[long]
        more = _short_lines(text, begin, np.append(begin[1:], len(a)), word, least)
        of, part, first, stop = (np.append(x, y) for x, y in zip((of, part, first, stop), more))
        name = sequence_hashes(word, first, stop)
        if passages:
            at, other = _passages_at(word, row, least)
            inside = np.searchsorted(begin, at, "right") - 1
            of, part = np.append(of, inside), np.append(part, begin[inside] - at - 1)
            first, stop = np.append(first, at), np.append(stop, at + least)
            name = np.append(name, other)
        before = first - np.searchsorted(row, text[of])
        return Units(text[of], line[of], part, first, stop, before, name, word, a, b)


def _short_lines(text: np.ndarray, first: np.ndarray, stop: np.ndarray, word: np.ndarray, least: int):
    """``(line, part, first word, stop)`` of paragraphs of lines under ``least`` words in a row.

    One ends with the first line that brings it to ``least`` words and whose hash is divisible by
    four, so the ends in a copy agree again after its first paragraphs.
    """
    out = [], [], [], []
    ends = (sequence_hashes(word, first, stop) % np.uint64(4) == 0).tolist()
    text, a, b = text.tolist(), first.tolist(), stop.tolist()
    begin = None
    for i in range(len(a)):
        if b[i] - a[i] >= least:
            begin = None
            continue
        if begin is None:
            begin = i
        last = i + 1 == len(a) or text[i + 1] != text[i] or b[i + 1] - a[i + 1] >= least
        if last or ends[i] and b[i] - a[begin] >= least:
            if b[i] - a[begin] >= least:
                for x, value in zip(out, (begin, 0, a[begin], b[i])):
                    x.append(value)
            begin = None
    return tuple(np.array(x, np.int64) for x in out)


def _sentences(first: np.ndarray, stop: np.ndarray, cuts: np.ndarray, least: int):
    """``(line, part, first word, stop)`` of all lines and, for lines of several, their sentences.

    A line under ``least`` words without an inner end is a sentence itself.
    """
    out = [], [], [], []
    low = np.searchsorted(cuts, first, "right").tolist()
    high = np.searchsorted(cuts, stop, "left").tolist()
    cuts = cuts.tolist()
    for i, (a, b) in enumerate(zip(first.tolist(), stop.tolist())):
        for x, value in zip(out, (i, 0, a, b)):
            x.append(value)
        begin, part = a, 0
        for cut in [*cuts[low[i] : high[i]], b] if low[i] < high[i] or b - a < least else ():
            if cut - a >= SENTENCE_WORDS and ((a, cut) != (begin, b) or b - begin < least):
                part += 1
                for x, value in zip(out, (i, part, a, cut)):
                    x.append(value)
                a = cut
    return out


def _keys(docs: DataFrame, least: int, k: int, rows: int, bands: int, places: bool = False) -> DataFrame:
    """``(part, block)``: per band of every line and sentence its key and name, packed by the first
    bits of the key. A name is there once per ``BLOCK_KEYS`` keys of a task: copies are one before
    the shuffle. Passages of the least size are there for copies word for word, which agree in
    their name.

    With ``places`` also every paragraph, packed by the first bits of its name (``_packed_places``).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        listed, m, packs = [], 0, 0
        for batch in batches:
            for piece in slices(batch):
                units = Units.of(piece.column(1), least, passages=places)
                names, at = np.unique(units.name[units.part >= 0], return_index=True)
                if len(names):
                    h, edges = _unit_shingles(units, at, k)
                    held.append((names, _band_keys(_signatures(h, edges, rows * bands), rows)))
                    n += len(names) * bands
                if n >= BLOCK_KEYS:
                    yield _packed(held)
                    held, n = [], 0
                if places and len(units.name):
                    listed.append(_listed(piece.column(0), units))
                    m += len(units.name)
                if m >= BLOCK_KEYS:
                    yield _packed_places(listed, packs)
                    listed, m, packs = [], 0, packs + 1
        if held:
            yield _packed(held)
        if listed:
            yield _packed_places(listed, packs)

    return docs.mapInArrow(run, "part int, block binary")


def _listed(doc_id: pa.Array, units: Units) -> pa.RecordBatch:
    """Every paragraph with its place; ``start`` counts the words of the text before it."""
    columns = [
        doc_id.take(pa.array(units.row)),
        pa.array(units.line, pa.int32()),
        pa.array(units.part, pa.int32()),
        pa.array(units.before, pa.int32()),
        pa.array(units.stop - units.first, pa.int32()),
        pa.array(units.name.view(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "line", "part", "start", "n_words", "name"])


def _packed_places(listed: list[pa.RecordBatch], packs: int) -> pa.RecordBatch:
    """Paragraphs as blocks: the first of each name goes to the part of that name, with whether the
    pack has it again. The others of the pack are known to be repeated and go anywhere, so that a
    very frequent paragraph spreads.
    """
    rows = pa.concat_batches(listed)
    name = rows.column("name").to_numpy().view(np.uint64)
    order = np.argsort(name, kind="stable")
    new = np.append(True, name[order][1:] != name[order][:-1])
    start = np.flatnonzero(new)
    first = order[start]
    again = np.diff(np.append(start, len(order))) > 1
    part = (name[first] >> np.uint64(64 - PLACE_BITS)).astype(np.int64)
    by_part = np.lexsort((first, part))
    first, again, part = first[by_part], again[by_part], part[by_part]
    edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    rest = np.sort(order[~new])
    cuts = np.append(np.arange(0, len(rest), SETTLED_ROWS), len(rest))
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) * 31 + packs
    parts, blocks = (part[edges[:-1]] + PLACES_FROM).tolist(), []
    parts += [SETTLED_FROM + (number * 64 + i) % (1 << PART_BITS) for i in range(len(cuts) - 1)]
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for which, known, ends in ((first, again, edges), (rest, np.ones(len(rest), bool), cuts)):
        sorted_rows = rows.take(pa.array(which)).append_column("again", pa.array(known))
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, sorted_rows.schema, options=options) as stream:
                stream.write_batch(sorted_rows.slice(a, b - a))
            blocks.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())], ["part", "block"])


def _packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Names and their keys as one block of bytes per part."""
    names, at = np.unique(np.concatenate([x for x, _ in held]), return_index=True)
    keys = np.concatenate([y for _, y in held])[at]
    order = np.argsort(keys, axis=None)
    key, name = keys.ravel()[order], names[order // keys.shape[1]]
    part = (key >> np.uint64(64 - PART_BITS)).astype(np.int32)
    # Of a key go the bits that the part does not have, less the last ones.
    short = (key << np.uint64(PART_BITS)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    rows = np.concatenate([short, name.astype("<u8").view(np.uint8).reshape(-1, 8)], axis=1)
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    edges = np.append(first, len(part)) * rows.shape[1]
    blocks = pa.Array.from_buffers(
        pa.binary(), len(first), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(rows.tobytes())]
    )
    return pa.RecordBatch.from_arrays([pa.array(part[first]), blocks], ["part", "block"])


def _unpacked(part: int, block: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(block.as_buffer(), np.uint8).reshape(-1, KEY_BYTES + 8)
    key = np.zeros((len(rows), 8), np.uint8)
    key[:, :KEY_BYTES] = rows[:, :KEY_BYTES]
    key = key.view(">u8").ravel().astype(np.uint64) >> np.uint64(PART_BITS)
    key |= np.uint64(part) << np.uint64(64 - PART_BITS)
    return key, np.ascontiguousarray(rows[:, KEY_BYTES:]).view("<u8").ravel()


def _unit_shingles(units: Units, which: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of some units, one after another, and where each begins and ends."""
    size = units.stop[which] - units.first[which]
    number = np.repeat(np.arange(len(which)), size)
    begin = np.cumsum(size) - size
    word = units.word[np.arange(len(number)) - begin[number] + units.first[which][number]]
    h, of, _ = shingles(word, number, len(which), k)
    return h, np.searchsorted(of, np.arange(len(which) + 1))


def _followers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks in order of their part: ``(key, name, first)`` of all but the first of a key.

    Of a part at most ``PART_KEYS`` keys are held beside one of every bucket: the others leave as
    they come, however large a bucket is, and may then come more than once.
    """
    for _, out in _followers_of_parts(batches):
        yield out


def _followers_of_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """``_followers``, each with whether its buckets are whole."""
    last, whole = None, True
    held, n = [], 0
    for batch in batches:
        for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            if part != last or n >= PART_KEYS:
                same = part == last
                if held:
                    first, out = _split(held)
                    yield whole and not same, out
                    held = [first] if same else []
                last, n, whole = part, 0, not same
            held.append(_unpacked(part, block))
            n += len(held[-1][0])
    if held:
        yield whole, _split(held)[1]


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, name, first, m, lead)`` like ``_followers``; ``m`` counts the members, one row of a
    bucket is its ``lead``.

    A whole bucket has its members for a key and the least name for its first, so buckets of several
    bands that hold the same paragraphs have the same rows.
    """
    for whole, batch in _followers_of_parts(batches):
        key, name, first = (x.to_numpy().view(np.uint64) for x in batch.columns)
        if not len(key):
            continue
        lead = np.append(True, key[1:] != key[:-1])
        start = np.flatnonzero(lead)
        size = np.diff(np.append(start, len(key)))
        if whole:
            least = np.repeat(np.minimum(np.minimum.reduceat(name, start), first[start]), size)
            key = np.repeat(mix(np.add.reduceat(mix(name), start) + mix(first[start])), size)
            name, first = np.where(name == least, first, name), least
            order = np.lexsort((name, np.repeat(np.arange(len(start)), size)))
            key, name, first = key[order], name[order], first[order]
        out = [pa.array(x.view(np.int64)) for x in (key, name, first)]
        out += [pa.array(np.repeat(size + 1, size), pa.int64()), pa.array(lead)]
        yield pa.RecordBatch.from_arrays(out, ["key", "name", "first", "m", "lead"])


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks in order of their part: all lines and sentences, and the passages whose name is
    there ``again``. Of every name one row that is no settled one is ``one``.

    Of a part at most ``PART_KEYS`` rows are held beside one of every name.
    """
    last, held, n, known = None, [], 0, np.empty(0, np.int64)
    for batch in batches:
        for part, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = pa.ipc.open_stream(block.as_buffer()).read_next_batch()
            if part >= SETTLED_FROM:
                yield rows.append_column("one", pa.array(np.zeros(len(rows), bool)))
                continue
            if held and (part != last or n >= PART_KEYS):
                rest, known, out = _settle(held, known, part != last)
                yield out
                held = [rest] if part == last else []
                n = 0
            if part != last:
                last, n, known = part, 0, np.empty(0, np.int64)
            held.append(rows)
            n += len(rows)
    if held:
        yield _settle(held, known, True)[2]


def _settle(held: list[pa.RecordBatch], known: np.ndarray, over: bool):
    """Rows to be held on, names that are known to be there again, and rows to be given out."""
    rows = pa.concat_batches(held)
    name = rows.column("name").to_numpy()
    names, first, which, count = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
    again = count > 1
    again[which[rows.column("again").to_numpy(zero_copy_only=False)]] = True
    old = np.isin(names, known)
    one = np.zeros(len(rows), bool)
    one[first[~old]] = True
    repeated = (again | old)[which]
    rows = rows.drop_columns(["again"]).append_column("again", pa.array(repeated)).append_column("one", pa.array(one))
    leave = repeated | (rows.column("part").to_numpy() >= 0) if over else repeated
    rest = rows.filter(pa.array(~leave)).drop_columns(["one"])
    return rest, np.union1d(known, names[again | old]), rows.filter(pa.array(leave))


def _gathered(blocks: DataFrame, doc_id) -> DataFrame:
    """Rows of ``_buckets`` and, without an ``m``, rows of ``_places``."""
    kinds = {
        "key": pa.int64(), "name": pa.int64(), "first": pa.int64(), "m": pa.int64(), "lead": pa.bool_(),
        "doc_id": to_arrow_type(doc_id), "line": pa.int32(), "part": pa.int32(), "start": pa.int32(),
        "n_words": pa.int32(), "again": pa.bool_(), "one": pa.bool_(),
    }

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
        for batch in batches:
            at = int(np.searchsorted(batch.column(0).to_numpy(), PLACES_FROM))
            for places, piece in ((False, batch.slice(0, at)), (True, batch.slice(at))):
                if len(piece):
                    yield places, piece

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, pieces in itertools.groupby(cut(batches), lambda x: x[0]):
            for out in (_places if places else _buckets)(piece for _, piece in pieces):
                columns = dict(zip(out.schema.names, out.columns))
                whole = [columns[k] if k in columns else pa.nulls(len(out), kind) for k, kind in kinds.items()]
                yield pa.RecordBatch.from_arrays(whole, list(kinds))

    schema = "key bigint, name bigint, first bigint, m bigint, lead boolean"
    schema += f", doc_id {doc_id.simpleString()}, line int, part int, start int, n_words int, again boolean, one boolean"
    return written(blocks.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema), "paragraphs")


def _split(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[tuple[np.ndarray, np.ndarray], pa.RecordBatch]:
    """One name of every key, the first that was held, and the others with it."""
    key, name = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(key, kind="stable")
    key, name = key[order], name[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    pivot = name[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
    others = np.flatnonzero(name != pivot)
    others = others[np.lexsort((name[others], key[others]))]
    again = np.zeros(len(others), bool)
    again[1:] = (key[others][1:] == key[others][:-1]) & (name[others][1:] == name[others][:-1])
    others = others[~again]
    out = [pa.array(x[others].view(np.int64)) for x in (key, name, pivot)]
    return (key[first], name[first]), pa.RecordBatch.from_arrays(out, ["key", "name", "first"])


def _texts(docs: DataFrame, places: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(name, text)`` of the wanted paragraphs, each cut out of a document that has it."""
    places = places.filter("one AND part >= 0").select("name", "doc_id", "start", "n_words")
    places = places.join(wanted, "name", "left_semi").groupBy("doc_id")
    places = places.agg(F.collect_list(F.struct("name", "start", "n_words")).alias("places"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 0):
                data, offsets = flat(piece.column(0))
                a, b, row = spans(data, offsets)
                listed = piece.column(1)
                of = np.repeat(np.arange(len(piece)), listed.value_lengths().to_numpy())
                name, start, size = (x.to_numpy() for x in listed.flatten().flatten())
                edges = np.searchsorted(row, np.arange(len(piece) + 1))
                first = edges[of] + start
                # Rows that share a doc_id share its list: each gives what it has.
                there = first + size <= edges[of + 1]
                name, first, stop = name[there], first[there], (first + size)[there]
                same = sequence_hashes(hashes(data, a, b), first, stop).view(np.int64) == name
                name, first, stop = name[same], first[same], stop[same]
                low, high = a[first].tolist(), b[stop - 1].tolist()
                whole = data.tobytes()
                texts = pa.array([whole[x:y] for x, y in zip(low, high)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), texts], ["name", "text"])

    joined = docs.join(places, "doc_id").select("text", "places")
    found = joined.mapInArrow(run, "name bigint, text string")
    return written(found, "paragraph-texts")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets of shingles reach the similarity."""
    joined = pairs
    for end in ("b", "a"):
        joined = joined.join(
            texts.select(F.col("name").alias(end), F.col("text").alias(f"text_{end}")), end
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                encoded = part.column(2).dictionary_encode()
                first = text_sets(encoded.dictionary, k)
                second = text_sets(part.column(3), k)
                keep = []
                for i, s in zip(encoded.indices.to_pylist(), second):
                    f = first[i]
                    common = len(np.intersect1d(f, s, assume_unique=True))
                    keep.append(common >= similarity * (len(f) + len(s) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")
    return written(rows.distinct(), "paragraph-links")


def repeated_paragraphs(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
    words: int = WORDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, line, part, n_words, component, first_doc_id, removed)`` of every paragraph that
    has a near copy.

    Paragraphs are lines of at least ``least_words`` words, runs of shorter lines with as many
    together (``part`` 0, ``n_words`` from the start of the line on) and the sentences inside lines
    (``part`` from 1). Passages of ``least_words`` words (``part`` -n, from the nth word of the
    line on, also over line ends) are chosen so that texts with ``least_words + SPREAD - 1`` equal
    words in a row share one; they are linked if they are equal, need no sentence ends, and overlap
    each other and the sentences: what goes is all that some removed row covers.

    Two are linked if the Jaccard similarity of their distinct word shingles is at least
    ``similarity``; a component is everything reachable over links. Its first place, by (doc_id,
    line, part), stays, with all that overlaps it; the others are ``removed``. Lines and sentences
    are banded by ``rows`` hashes, as often as it takes for a pair at the threshold to meet with
    the chance ``recall``; every meeting is checked on the full sets. Repeated sentences are given
    where they make up a passage of ``least_words`` words in a row, also over line ends, where they
    are not in a line that is removed as a whole.

    Equal paragraphs are one node, named by 64 bits of their hash. Nodes of a bucket are compared
    with its pivot, and with each other where that leaves several components (see ``pairing``).

    Null, empty and short texts have no paragraph. Rows that share a doc_id share their places,
    so a repeated row does not remove itself; a null doc_id has no place and is left out. An empty
    table gives an empty one; other columns are ignored. A very long text is cut up whole by one
    task; its paragraphs go their own ways from there.
    """
    with shuffles_released(docs.sparkSession):
        return _repeated(id_and_text(docs, doc_id, text), similarity, recall, least_words, words, rows)


def _repeated(
    docs: DataFrame, similarity: float, recall: float, least_words: int, words: int, rows: int
) -> DataFrame:
    source = docs.filter("doc_id IS NOT NULL")
    bands = tune(similarity, recall, rows)
    blocks = _keys(source, least_words, words, rows, bands, places=True)
    gathered = _gathered(blocks, source.schema["doc_id"].dataType)
    places = gathered.filter("m IS NULL").drop("key", "first", "m", "lead")
    met = gathered.filter("m IS NOT NULL").groupBy("key", "name", "first", "m", "lead").agg(F.count("*").alias("bands"))
    ids = F.when(F.col("lead"), F.array("name", "first")).otherwise(F.array("name"))
    met = met.select("key", F.explode(ids).alias("id"), F.expr("m * bands").alias("m"))
    buckets = pairing.weighed(written(met, "buckets"))

    texts = _texts(source, places, buckets.select(F.col("id").alias("name")).distinct())
    found = components(_confirmed(pairing.stars(buckets), texts, words, similarity))
    found = written(found, "components")
    members = pairing.unsettled(buckets, found)
    if not members.isEmpty():
        inside = texts.join(members.select(F.col("id").alias("name")), "name", "left_semi")
        inside = written(inside.dropDuplicates(["name"]), "paragraph-texts")
        elements = written(_elements(inside, words), "elements")
        pairs = pairing.across(members, elements, math.floor(1000 * similarity + 1e-9))
        more = _confirmed(pairs, inside, words, similarity)
        known = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
        found = written(components(known.union(more)), "components")
    return _passages(places, found.withColumnRenamed("id", "name"), least_words)


def _passages(places: DataFrame, found: DataFrame, least_words: int) -> DataFrame:
    columns = ["doc_id", "line", "part", "start", "n_words", F.coalesce("component", "name").alias("component")]
    units = places.filter("part >= 0").join(found, "name", "left")
    units = units.filter("again OR component IS NOT NULL").select(columns)
    # Passages are in no bucket: their names are their components.
    passages = places.filter("part < 0").withColumn("component", F.lit(None).cast("bigint")).select(columns)
    place = F.struct("doc_id", "line", "part")
    repeated = written(units.union(passages), "repeated")
    first = repeated.groupBy("component").agg(
        F.min(F.struct("doc_id", "line", "part", "start", "n_words")).alias("first"),
        F.max(place).alias("last"),
    )
    other = F.struct("first.doc_id", "first.line", "first.part")
    first = first.filter(other != F.col("last"))
    # A sentence may be like the line it stands in, a passage like the one that begins in it.
    overlap = (F.col("doc_id") == F.col("first.doc_id")) & F.expr(
        "start < first.start + first.n_words AND first.start < start + n_words"
    )
    placed = repeated.join(first, "component").select(
        "doc_id", "line", "part", "start", "n_words", "component",
        F.col("first.doc_id").alias("first_doc_id"), ((place != other) & ~overlap).alias("removed"),
        (F.col("first.doc_id") == F.col("last.doc_id")).alias("alone"),
    )
    # Windows inside a document share this shuffle. What other documents have too is copied.
    inside = Window.partitionBy("doc_id", "component")
    placed = placed.repartition("doc_id").withColumn("copied", F.max("removed").over(inside))
    placed = placed.filter("copied OR NOT alone").drop("copied", "alone")
    line = Window.partitionBy("doc_id", "line")
    whole = F.max(F.when(F.col("part") == 0, F.col("removed")).otherwise(False)).over(line)
    end = F.max(F.when(F.col("part") == 0, F.expr("start + n_words"))).over(line)
    # Sentences in a row with the same verdict, also over line ends: the words before each less
    # the words of those before it in the list are constant.
    kind = ["doc_id", "removed", F.signum("part")]
    before = Window.partitionBy(*kind).orderBy("start", "part").rowsBetween(Window.unboundedPreceding, -1)
    listed = F.coalesce(F.sum("n_words").over(before), F.lit(0))
    ranked = placed.withColumn("whole", whole & (F.expr("start + n_words") <= end))
    ranked = ranked.withColumn("run", F.col("start") - listed)
    summed = ranked.withColumn("in_run", F.sum("n_words").over(Window.partitionBy(*kind, "run")))
    kept = (F.col("part") == 0) | (~F.col("whole") & ((F.col("part") < 0) | (F.col("in_run") >= least_words)))
    return summed.filter(kept).drop("whole", "run", "in_run", "start")


def _elements(texts: DataFrame, k: int) -> DataFrame:
    """``(id, element)``: the distinct shingles of some paragraphs, each there once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = text_sets(part.column(1), k)
                which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                element = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(which)), pa.array(element)], ["id", "element"]
                )

    return texts.select("name", "text").mapInArrow(run, "id bigint, element bigint")
