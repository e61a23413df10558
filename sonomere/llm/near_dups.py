"""Near-duplicate documents: HyperMinHash registers in bands, estimate, exact check, components."""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomere.llm import pairing
from sonomere.llm.batches import flat, hashes, id_and_text, mix, shingles, slices, spans
from sonomere.llm.components import components
from sonomere.storage import written

# A register keeps the leading zeros of a 48-bit minimum and this many bits after its first one.
_REST = 48
_MANTISSA = 10
# An estimate may lie this many standard deviations under the threshold before a pair is dropped.
_MARGIN = 6.0


@dataclass(frozen=True)
class Shape:
    """``bands`` bands of ``rows`` registers.

    A pair of Jaccard similarity s meets in some band with probability 1 - (1 - s^rows)^bands:
    the default misses about one in a million pairs at 0.85, and brings together four in a million
    at 0.1, so that a passage shared by very many documents makes no pairs of them.
    """

    rows: int = 7
    bands: int = 36
    words: int = 5

    @property
    def registers(self) -> int:
        return self.rows * self.bands


def text_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; A-Z count as a-z."""
    data, offsets = flat(column)
    start, end, row = spans(data, offsets)
    n = len(column)
    h, of, _ = shingles(hashes(data, start, end), row, n, words)
    edges = np.searchsorted(of, np.arange(n + 1))
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        s = np.sort(h[a:b])
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if b - a > 1 else s)
    return out


def registers(sets: list[np.ndarray], k: int) -> np.ndarray:
    """HyperMinHash registers, one row of ``k`` per set; 0 is an empty bucket."""
    size = np.array([len(s) for s in sets], np.int64)
    h = mix(np.concatenate(sets)) if len(sets) else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), size)
    bucket = ((h >> np.uint64(_REST)) * np.uint64(k) >> np.uint64(16)).astype(np.int64)
    least = np.full(len(sets) * k, np.uint64(1) << np.uint64(_REST), np.uint64)
    np.minimum.at(least, row * k + bucket, h & np.uint64((1 << _REST) - 1))
    fraction, exponent = np.frexp(np.maximum(least, 1).astype(np.float64))
    zeros = _REST - exponent
    bits = np.floor((2 * fraction - 1) * (1 << _MANTISSA)).astype(np.int64)
    code = (zeros << _MANTISSA | bits) + 1
    code[least == np.uint64(1) << np.uint64(_REST)] = 0
    return code.astype("<u2").reshape(len(sets), k)


def band_keys(regs: np.ndarray, shape: Shape) -> np.ndarray:
    """One 64-bit key per band. Empty buckets borrow: each tries a fixed random order of donors
    until one holds a value, which keeps the chance of agreement at the similarity even for
    texts with fewer shingles than registers.
    """
    k = shape.registers
    filled = regs.astype(np.uint64)
    empty = filled == 0
    tries = np.arange(k, dtype=np.uint64)
    for attempt in range(1, 64):
        if not empty.any():
            break
        donor = (mix(tries * np.uint64(0x100000001B3) + np.uint64(attempt)) % np.uint64(k)).astype(int)
        take = empty & (regs[:, donor] != 0)
        filled[take] = (regs[:, donor].astype(np.uint64) | np.uint64(attempt) << np.uint64(16))[take]
        empty &= ~take
    if empty.any():  # almost nothing to borrow from: the next filled bucket, counted round
        for i in np.flatnonzero(empty.any(axis=1)):
            held = np.flatnonzero(regs[i])
            if len(held):
                at = np.flatnonzero(empty[i])
                filled[i, at] = regs[i, held[np.searchsorted(held, at) % len(held)]]
    out = np.empty((len(regs), shape.bands), np.uint64)
    for b in range(shape.bands):
        key = np.full(len(regs), b + 1, np.uint64)
        for j in range(b * shape.rows, (b + 1) * shape.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + filled[:, j])
        out[:, b] = key
    return out.view(np.int64)


def chance_agreements(n: float, m: float, k: int) -> float:
    """Expected registers that agree by chance for two disjoint sets of ``n`` and ``m`` members."""
    zeros = np.arange(_REST)[:, None]
    cells = np.arange(1 << _MANTISSA)[None, :] / (1 << _MANTISSA)
    low = 2.0 ** -(zeros + 1) * (1 + cells)
    high = low + 2.0 ** -(zeros + 1) / (1 << _MANTISSA)

    def least_in_cell(size: float) -> np.ndarray:
        # A set sends size / k members to a bucket on average, Poisson distributed.
        return np.exp(-size / k * low) - np.exp(-size / k * high)

    return float(k * (least_in_cell(n) * least_in_cell(m)).sum())


def _log2_steps(n: np.ndarray) -> np.ndarray:
    return np.round(np.log2(np.maximum(n, 1)) * 2) / 2


class Estimator:
    """Jaccard similarity from two register rows, less the agreements due to chance."""

    def __init__(self, k: int):
        self.k, self.known = k, {}

    def _chance(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        cells = list(zip(_log2_steps(n).tolist(), _log2_steps(m).tolist()))
        for c in set(cells) - self.known.keys():
            self.known[c] = chance_agreements(2.0 ** c[0], 2.0 ** c[1], self.k)
        return np.array([self.known[c] for c in cells])

    def __call__(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray):
        """``(estimate, registers it rests on)``."""
        used = ((a != 0) | (b != 0)).sum(axis=1)
        same = ((a == b) & (a != 0)).sum(axis=1)
        # Chance only plays between registers that do not agree because of a common member.
        chance = self._chance(n, m) * (1 - same / np.maximum(used, 1))
        return np.clip((same - chance) / np.maximum(used, 1), 0, 1), used


def _schema(kind: str, *more: str) -> str:
    return ", ".join([f"doc_id {kind}", "n_shingles bigint", *more])


def _sketches(docs: DataFrame, shape: Shape) -> DataFrame:
    """``(doc_id, n_shingles, key_a, key_b, registers)`` per row; the keys name the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = text_sets(part.column(1), shape.words)
                keys = np.zeros((2, len(sets)), np.uint64)
                for i, s in enumerate(sets):
                    keys[0, i] = mix(s).sum(dtype=np.uint64)
                    keys[1, i] = mix(~s).sum(dtype=np.uint64)
                regs = registers(sets, shape.registers)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys[0].view(np.int64)),
                        pa.array(keys[1].view(np.int64)),
                        pa.array([r.tobytes() for r in regs], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "key_a", "key_b", "registers"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, _schema(kind, "key_a bigint", "key_b bigint", "registers binary")
    )


def _band_rows(sketches: DataFrame, shape: Shape) -> DataFrame:
    """``(key, doc_id)``, one row per band."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                regs = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u2")
                keys = band_keys(regs.reshape(-1, shape.registers), shape)
                which = np.repeat(np.arange(part.num_rows), shape.bands)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), part.column(0).take(pa.array(which))],
                    ["key", "doc_id"],
                )

    kind = sketches.schema["doc_id"].dataType.simpleString()
    return sketches.select("doc_id", "registers").mapInArrow(run, f"key bigint, doc_id {kind}")


def _possible(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _promising(pairs: DataFrame, candidates: DataFrame, shape: Shape, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose estimate is not clearly below the threshold."""
    side = candidates.select("doc_id", "n_shingles", "registers")
    joined = pairs
    for end in ("a", "b"):
        joined = joined.join(
            side.select(
                F.col("doc_id").alias(end), F.col("n_shingles").alias(f"n_{end}"),
                F.col("registers").alias(f"registers_{end}"),
            ),
            end,
        )
    joined = joined.filter(_possible(F.col("n_a"), F.col("n_b"), percent))
    threshold = percent / 100

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = Estimator(shape.registers)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                a, b = (
                    np.frombuffer(b"".join(part.column(f"registers_{e}").to_pylist()), "<u2")
                    .reshape(-1, shape.registers)
                    for e in ("a", "b")
                )
                n, m = (part.column(f"n_{e}").to_numpy(zero_copy_only=False) for e in ("a", "b"))
                found, used = estimate(a, b, n, m)
                spread = np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
                keep = pa.array(found >= threshold - _MARGIN * spread)
                yield part.select(["a", "b"]).filter(keep)

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _confirmed(pairs: DataFrame, candidates: DataFrame, shape: Shape, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""
    side = candidates.select("doc_id", "text")
    joined = pairs
    for end in ("b", "a"):
        joined = joined.join(
            side.select(F.col("doc_id").alias(end), F.col("text").alias(f"text_{end}")), end
        )
    joined = joined.select("a", "b", "text_a", "text_b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                encoded = part.column(2).dictionary_encode()
                first = text_sets(encoded.dictionary, shape.words)
                second = text_sets(part.column(3), shape.words)
                keep = []
                for i, s in zip(encoded.indices.to_pylist(), second):
                    f = first[i]
                    common = len(np.intersect1d(f, s, assume_unique=True))
                    keep.append(100 * common >= percent * (len(f) + len(s) - common))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    shape: Shape = Shape(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Two documents are linked if 100 * |intersection| >= ``percent`` * |union| of their distinct
    shingles; a component is everything reachable over links and is named by its least doc_id.

    * Texts with the same set form a class; only its least doc_id goes on.
    * Registers of classes are banded; members of a bucket are first compared with its pivot.
      Where that leaves members in different components, those that can still be linked are
      compared with each other (see ``pairing``), so copies of one text never make all pairs.
    * A pair is dropped by its estimate only if that lies far below the threshold, and accepted
      only on the full sets.

    Texts with one to four words are one shingle; null, empty and white texts have none and stay
    alone. Rows that share a doc_id are one node of the graph with all their texts. A null doc_id
    cannot be linked: ``component_id`` is null and the row is kept. An empty table gives an empty
    one; other columns are ignored. A very long text is one sketch of fixed size; its whole set is
    built by one task, and again where it is compared.
    """
    source = id_and_text(docs, doc_id, text)
    sketches = written(_sketches(source, shape), "sketches")
    real = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    names = ["key_a", "key_b", "n_shingles"]
    classes = written(real.groupBy(*names).agg(F.min("doc_id").alias("rep")), "classes")
    classed = real.select("doc_id", *names).join(classes, names)

    one_each = real.join(
        classes.select(*names, F.col("rep").alias("doc_id")), [*names, "doc_id"], "left_semi"
    )
    rows = _band_rows(one_each, shape).withColumnRenamed("doc_id", "id").distinct()
    buckets = pairing.with_pivot(rows)

    wanted = buckets.select(F.col("id").alias("doc_id")).distinct()
    candidates = _candidates(source.join(wanted, "doc_id", "left_semi"), shape)
    links = _links(pairing.stars(buckets), candidates, shape, percent)

    # Rows with one doc_id and different texts tie their classes together.
    torn = classed.groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y"))
    torn = classed.join(torn.filter("x <> y").select("doc_id"), "doc_id", "left_semi")
    links = links.union(torn.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))

    found = written(components(links), "components")
    members = pairing.unsettled(buckets, found)
    if not members.isEmpty():
        inside = members.select(F.col("id").alias("doc_id"))
        elements = _elements(candidates.join(inside, "doc_id", "left_semi"), shape)
        more = _links(pairing.across(members, elements, 10 * percent), candidates, shape, percent)
        known = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
        found = components(known.union(more))

    placed = sketches.select("doc_id", *names).join(classes, names, "left")
    placed = placed.withColumn("rep", F.coalesce("rep", "doc_id"))
    placed = placed.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _candidates(docs: DataFrame, shape: Shape) -> DataFrame:
    """Texts that share a bucket with another one, written with their registers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = text_sets(part.column(1), shape.words)
                regs = registers(sets, shape.registers)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([r.tobytes() for r in regs], pa.binary()), part.column(1),
                    ],
                    ["doc_id", "n_shingles", "registers", "text"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.mapInArrow(run, _schema(kind, "registers binary", "text string")), "candidates")


def _links(pairs: DataFrame, candidates: DataFrame, shape: Shape, percent: int) -> DataFrame:
    promising = written(_promising(pairs, candidates, shape, percent), "pairs")
    return written(_confirmed(promising, candidates, shape, percent), "links")


def _elements(candidates: DataFrame, shape: Shape) -> DataFrame:
    """``(id, element)``: the distinct shingles of some documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = text_sets(part.column(1), shape.words)
                which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
                element = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(which)), pa.array(element)], ["id", "element"]
                )

    kind = candidates.schema["doc_id"].dataType.simpleString()
    rows = candidates.select("doc_id", "text").mapInArrow(run, f"id {kind}, element bigint")
    return rows.distinct()
