"""Language of every word in a text by a conditional random field, and so of the text."""

from collections.abc import Iterable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonomere.llm import crf
from sonomere.llm.batches import flat, hashes, id_and_text, mix, slices, spans

UNDETERMINED = "und"
# Bounds of the training sample: texts per language, and characters of a text that may be in it.
TEXTS_PER_LANGUAGE = 250
LONGEST_TRAINING_TEXT = 100_000
# Words of one language in a row, and of a whole sequence, in code-switched training sequences.
STRETCH = (4, 60)
SEQUENCE = crf.BLOCK

# The lexicon: words at most, the least uses of one over all texts learnt from, and the share of its
# uses that must be in one language.
LEXICON_WORDS = 1 << 16
LEXICON_USES = 3
LEXICON_SHARE = 0.8

_BITS = 18
# Features of a slice take about a hundred times its bytes.
_SLICE = 1 << 19
_AFFIXES = (1, 2, 3, 4)

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - _BITS)).astype(np.int32)


# A lexicon is ``(hashes of words in order, number of the language of each, names of languages)``.
Lexicon = tuple[np.ndarray, np.ndarray, list[str]]
NO_LEXICON: Lexicon = (np.empty(0, np.uint64), np.empty(0, np.int64), [])


def lexicon(labelled: DataFrame, entries: int = LEXICON_WORDS) -> Lexicon:
    """Words that belong to one language, from ``(lang, text)`` of all texts that may be learnt from.

    Words are counted per language over the whole table, partially in every task; the ``entries``
    most frequent of those with ``LEXICON_USES`` uses, ``LEXICON_SHARE`` of them in one language,
    come to the driver. A-Z count as a-z; null texts and languages count nothing; of words with equal
    counts those with the least hash are taken.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column(1))
                start, end, row = spans(data, offsets)
                codes = part.column(0).dictionary_encode()
                lang = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                word = hashes(data, start, end)
                order = np.lexsort((word, lang[row]))
                word, of = word[order], lang[row][order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (of[1:] != of[:-1])
                first = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(word[first].view(np.int64)), codes.dictionary.take(pa.array(of[first])),
                        pa.array(np.diff(np.append(first, len(word)))),
                    ],
                    ["word", "lang", "n"],
                )

    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = known.mapInArrow(run, "word bigint, lang string, n bigint")
    counts = counts.groupBy("word", "lang").agg(F.sum("n").alias("n")).groupBy("word")
    counts = counts.agg(F.sum("n").alias("n"), F.max(F.struct("n", "lang")).alias("top"))
    own = counts.filter(
        (F.col("n") >= LEXICON_USES) & (F.col("top.n") >= F.lit(LEXICON_SHARE) * F.col("n"))
    )
    table = own.orderBy(F.desc("n"), "word").limit(entries).select("word", "top.lang").toArrow()
    words = table.column(0).to_numpy().astype(np.int64).view(np.uint64)
    names = sorted(set(table.column(1).to_pylist()))
    number = {name: i for i, name in enumerate(names)}
    code = np.array([number[x] for x in table.column(1).to_pylist()], np.int64)
    order = np.argsort(words)
    return words[order], code[order], names


def features(
    column: pa.Array, known: Lexicon = NO_LEXICON
) -> tuple[crf.Features, np.ndarray, np.ndarray]:
    """``(features, row, has a letter)`` of all words: the word itself, the language it has in the
    lexicon, what it begins and ends with, and its byte trigrams. A-Z count as a-z.
    """
    data, offsets = flat(column)
    start, end, row = spans(data, offsets)
    low = _LOWER[data].astype(np.uint64)
    size = end - start
    word = hashes(data, start, end)
    owner = np.zeros(len(word), np.uint64)
    if len(known[0]):
        at = np.minimum(np.searchsorted(known[0], word), len(known[0]) - 1)
        owner = np.where(known[0][at] == word, known[1][at] + 1, 0).astype(np.uint64)
    fixed = [_slot(word), _slot(owner + np.uint64(1 << 50))]
    for n in _AFFIXES:
        for side, first in ((1, start), (2, np.maximum(end - n, start))):
            key = np.full(len(start), side * 8 + n, np.uint64)
            for j in range(n):
                inside = j < size
                byte = low[np.where(inside, first + j, 0)]
                key = key * np.uint64(257) + np.where(inside, byte + np.uint64(1), np.uint64(0))
            fixed.append(_slot(key))
    # The trigram around every byte, with the word's borders as a byte of their own.
    position = np.repeat(np.arange(len(start)), size)
    at = np.arange(len(position)) - np.repeat(np.cumsum(size) - size, size)
    byte = np.repeat(start, size) + at
    before = np.where(at > 0, low[np.maximum(byte - 1, 0)] + np.uint64(1), np.uint64(0))
    last = at == size[position] - 1
    after = np.where(last, np.uint64(0), low[np.minimum(byte + 1, max(len(low) - 1, 0))] + np.uint64(1))
    gram = _slot((before * np.uint64(257) + low[byte]) * np.uint64(257) + after + np.uint64(1 << 40))

    n_fixed = len(fixed)
    to = np.cumsum(size + n_fixed) - (size + n_fixed)
    index = np.empty(len(position) + n_fixed * len(start), np.int32)
    for i, values in enumerate(fixed):
        index[to + i] = values
    index[np.repeat(to + n_fixed, size) + at] = gram
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    return (
        crf.Features(index, np.append(to, len(index))),
        row,
        letters[end] > letters[start],
    )


def training_sample(
    docs: DataFrame, per_language: int, longest: int = LONGEST_TRAINING_TEXT
) -> DataFrame:
    """``(lang, text)``: for every language the texts with the least hash of their id."""
    usable = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL AND length(text) <= " + str(longest))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("n", F.row_number().over(order))
    chosen = chosen.filter(F.col("n") <= per_language).select("doc_id").distinct()
    # At most per_language ids for each language.
    return usable.join(F.broadcast(chosen), "doc_id").select("lang", "text")


def fit(sample: pa.Table, seed: int = 7, known: Lexicon = NO_LEXICON) -> crf.Model | None:
    """Train on sequences that switch between the texts of a sample."""
    sample = sample.sort_by([("lang", "ascending"), ("text", "ascending")])
    labels = sorted(set(sample.column("lang").to_pylist()))
    if not labels:
        return None
    parts, rows, n_rows = [], [], 0
    for batch in sample.to_batches():
        for part in slices(batch, sample.column_names.index("text"), _SLICE // 2):
            found, row, _ = features(part.column("text"), known)
            parts.append(found)
            rows.append(row + n_rows)
            n_rows += part.num_rows
    found, row = crf.Features.joined(parts), np.concatenate(rows)
    number = {name: i for i, name in enumerate(labels)}
    label = np.array([number[x] for x in sample.column("lang").to_pylist()])[row]
    rng = np.random.default_rng(seed)
    # Stretches of one text, in an order that mixes the languages.
    cuts = np.unique(
        np.concatenate(
            [
                np.flatnonzero(np.diff(row, prepend=-1)),
                np.cumsum(rng.integers(*STRETCH, size=len(row) // STRETCH[0] + 1)),
            ]
        )
    )
    cuts = np.append(cuts[cuts < len(row)], len(row))
    order = rng.permutation(len(cuts) - 1)
    size = np.diff(cuts)[order]
    at = np.repeat(cuts[:-1][order], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    edges = np.append(np.arange(0, len(at), SEQUENCE), len(at))
    model = crf.train(found, label[at], edges, labels, 1 << _BITS, seed=seed, position=at)
    return replace(model, extra=known)


def learn(
    docs: DataFrame, usable: Column, per_language: int = TEXTS_PER_LANGUAGE, lang: str = "lang",
    doc_id: str = "doc_id", text: str = "text",
) -> crf.Model | None:
    """A model from the ``usable`` rows of labelled documents; None without any label.

    The sample is bounded by ``per_language`` texts of each language; its hash order does not
    depend on how the table is stored. The lexicon counts the words of all usable rows.
    """
    source = docs.filter(usable).select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    sent = docs.sparkSession.sparkContext.broadcast(lexicon(source))
    sample = training_sample(source, per_language).select("lang", "text")
    return crf.fit_in_a_task(sample, lambda table: fit(table, known=sent.value))


def _labelled(model: crf.Model | None, texts: pa.Array):
    """``(share of each language, whether there is a letter, words)`` of some texts."""
    n = len(texts)
    found, row, letter = features(texts, model.extra or NO_LEXICON if model else NO_LEXICON)
    mass = np.zeros((n, len(model.labels) if model else 1))
    if model:
        edges = np.searchsorted(row, np.arange(n + 1))
        chance = crf.posteriors(found.emissions(model.weights), edges, model.transition)
        for k in range(mass.shape[1]):
            mass[:, k] = np.bincount(row[letter], chance[letter, k], n)
    # Bytes beyond ASCII may be signs; only then the characters themselves are asked.
    known = np.bincount(row[letter], minlength=n) > 0
    for i in np.flatnonzero(known & ~_has_ascii_letter(texts)):
        known[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    share = mass / np.maximum(mass.sum(axis=1), 1e-300)[:, None]
    return share, known, np.bincount(row, minlength=n)


def identify(
    docs: DataFrame, model: crf.Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, lang_pred, score, n_words, shares)`` of every row.

    Every word gets the probability of each language by forward-backward over the whole text;
    ``shares`` are the means over its words with a letter, ``lang_pred`` is the largest (the first
    by name of equal ones) and ``score`` its share. A text that is null or has no letter is
    ``und`` with score 0 and null shares, as is every text without a model. Repeated rows are
    labelled each; an empty table gives an empty one; other columns are ignored. A very long text is
    one sequence, labelled whole by one task in blocks.
    """
    source = id_and_text(docs, doc_id, text)
    sent = crf.Model.sent(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = crf.Model.of(sent.value)
        for batch in batches:
            for part in slices(batch, size=_SLICE):
                share, known, n_words = _labelled(model, part.column(1))
                known = known & (model is not None)
                best = share.argmax(axis=1)
                score = np.where(known, np.clip(share[np.arange(len(best)), best], 0, 1), 0.0)
                names = [model.labels[b] if k else UNDETERMINED for b, k in zip(best, known)]
                shares = [s.tolist() if k else None for s, k in zip(share, known)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(names, pa.string()), pa.array(score),
                        pa.array(n_words, pa.int64()), pa.array(shares, pa.list_(pa.float64())),
                    ],
                    ["doc_id", "lang_pred", "score", "n_words", "shares"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, n_words bigint, shares array<double>"
    )


def with_main_language(
    docs: DataFrame, model: crf.Model | None, least_share: float, text: str = "text"
) -> DataFrame:
    """The rows whose text has one language in at least ``least_share`` of its words, unchanged.

    Null texts and texts without a letter go. Without a model, every text with a letter stays.
    """
    at = docs.columns.index(text)
    sent = crf.Model.sent(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = crf.Model.of(sent.value)
        for batch in batches:
            for part in slices(batch, at, _SLICE):
                share, known, _ = _labelled(model, part.column(at))
                keep = known & ((share.max(axis=1) >= least_share) | (model is None))
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def _has_ascii_letter(texts: pa.Array) -> np.ndarray:
    data, offsets = flat(texts)
    ascii_letter = np.concatenate([[0], np.cumsum(_LETTER[data] & (data < 128))])
    return ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
