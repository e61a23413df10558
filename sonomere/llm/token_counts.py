"""Token counts by a two-tier lookup of pre-token lengths, without shuffling pre-tokens."""

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from sonomere.llm.batches import id_and_text, slices
from sonomere.llm.caches import TwoGenerations

FREQUENT = 4096
_SPACE = "▁"  # how the model writes a space
_SEGMENT = re.compile(r"\n| +[^ \n]*|[^ \n]+")
# Entries of a running summary before it is cut back.
_SUMMARY = 1 << 16


def segments(text: str) -> list[str]:
    """Pre-tokens: spaces with the word after them, words, and single line ends.

    No piece of the model crosses their borders, so their token counts add up to the text's.
    """
    return _SEGMENT.findall(" " + text.replace(_SPACE, " ")) if text else []


class PieceCounter:
    """Tokens of one pre-token by the model itself."""

    def __init__(self, model: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            if "\n" in piece or _SPACE in piece.lstrip(_SPACE):
                raise ValueError(f"Piece {piece!r} crosses the border of a pre-token")
        self.base = len(self.processor.encode("\n"))

    def __call__(self, segment: str) -> int:
        # The model puts a space before every text; a pre-token that has one gives its own away.
        if segment.startswith(" "):
            rest = segment[1:]
            return len(self.processor.encode(rest)) if rest else self._alone(segment)
        return self._alone(segment)

    def _alone(self, segment: str) -> int:
        return len(self.processor.encode("\n" + segment)) - self.base


class Lengths(dict):
    """First tier: the frequent pre-tokens, never evicted. A miss asks the worker's cache."""

    def __init__(self, frequent: dict[str, int], count: PieceCounter):
        super().__init__(frequent)
        self.cache = TwoGenerations(count)

    def __missing__(self, segment: str) -> int:
        return self.cache[segment]


def _cut(counts: Counter, k: int) -> Counter:
    """The summary with at most ``k`` entries: the next largest count is taken from all."""
    if len(counts) <= k:
        return counts
    ordered = counts.most_common(k + 1)
    least = ordered[-1][1]
    return Counter({piece: n - least for piece, n in ordered if n > least})


def frequent_pretokens(docs: DataFrame, k: int = FREQUENT, text: str = "text") -> list[str]:
    """At most ``k`` pre-tokens that hold every one with more than a ``1/k`` share of all.

    Every task reduces its texts to one summary of ``k`` counts; summaries are merged in two
    levels. What moves is one row per task, never a pre-token per occurrence.
    """
    schema = "pieces array<string>, counts array<bigint>"

    def emit(counts: Counter) -> pa.RecordBatch:
        kept = _cut(counts, k)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([list(kept)], pa.list_(pa.string())),
                pa.array([list(kept.values())], pa.list_(pa.int64())),
            ],
            ["pieces", "counts"],
        )

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for value in part.column(0).to_pylist():
                    counts.update(s for s in segments(value or "") if len(s) <= 32)
                if len(counts) > _SUMMARY:
                    counts = _cut(counts, _SUMMARY // 2)
        yield emit(counts)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for pieces, ns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(dict(zip(pieces, ns)))
                counts = _cut(counts, k)
        yield emit(counts)

    texts = docs.select(text)
    level = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    tables = texts.mapInArrow(summarise, schema).repartition(level).mapInArrow(merge, schema)
    rows = tables.coalesce(1).mapInArrow(merge, schema).collect()
    return rows[0].pieces if rows else []


def count_tokens(
    docs: DataFrame,
    model: str,
    k: int = FREQUENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row, as the model at path ``model`` encodes it.

    Null and empty texts have no bytes and no tokens; repeated rows are counted each; an empty
    table gives an empty one; other columns are ignored. The first tier holds ``k`` pre-tokens
    found over all documents, of those of up to 32 characters, and is broadcast; misses, longer ones
    among them, are encoded once per worker while cached. A very long text is counted whole, pre-token
    by pre-token, where it is read.
    """
    source = id_and_text(docs, doc_id, text)
    count = PieceCounter(model)
    table = {piece: count(piece) for piece in frequent_pretokens(source, k)}
    frequent = docs.sparkSession.sparkContext.broadcast(table)

    def lengths(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lengths(frequent.value, PieceCounter(model))
        of = known.__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for part in slices(batch):
                for value in part.column(1).to_pylist():
                    value = value or ""
                    n_bytes.append(len(value.encode()))
                    n_tokens.append(sum(map(of, segments(value))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(lengths, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
