"""Quality rules: exact counts per text, and a conditional random field that labels its lines.

Labels change inside a text: a good one may have a menu or a licence in it, a bad one may have a
sentence. Only the quality of whole texts is known, so the labels of lines are learnt with the model.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.llm import crf
from sonomere.llm.batches import flat, hashes, id_and_text, mix, shingles, slices, spans

BOILERPLATE, CONTENT = 0, 1
LABELS = ["boilerplate", "content"]
# Bounds of the training sample: texts of each quality, and characters of a text in it.
TEXTS_PER_QUALITY = 1000
LONGEST_TRAINING_TEXT = 100_000
# Share of the words of a text that must stand in content lines.
LEAST_CONTENT = 0.5
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
# Training: rounds at most, the share of labels that may still move, the least share of content in a
# good text and the most in a bad one, the share of symbols, and of words said twice, in a line that
# is boilerplate to begin with, and lines put into a text at most.
ROUNDS, EPOCHS = 6, 12
STABLE = 0.002
GOOD_CONTENT, BAD_CONTENT = 0.75, 0.25
SYMBOLS, STUTTER = 0.05, 0.3
STRETCH = 3
REPEAT_WORDS = 8

_BITS = 13
_LINE_END = np.arange(256) == 0x0A
# The characters counted as symbols.
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])
_PLAIN_END = np.isin(np.arange(256), [ord(c) for c in ".!?\"'"])
_KINDS = {
    "upper": np.array([65 <= b <= 90 for b in range(256)]),
    "digit": np.array([48 <= b <= 57 for b in range(256)]),
    "symbol": _SYMBOL,
    "point": np.array([33 <= b < 128 and not chr(b).isalnum() for b in range(256)]),
    "letter": np.array([b >= 128 or chr(b).isalpha() for b in range(256)]),
}


class Lines:
    """Lines with a word of a slice of texts, and their words."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = flat(texts)
        self.n_rows = len(texts)
        start, end, row = spans(self.data, self.offsets, _LINE_END)
        self.word_start, self.word_end, self.word_row = spans(self.data, self.offsets)
        of = np.searchsorted(start, self.word_start, "right") - 1
        count = np.bincount(of, minlength=len(start))
        kept = count > 0
        self.start, self.end, self.row, self.n_words = start[kept], end[kept], row[kept], count[kept]
        self.first_word = np.searchsorted(self.word_start, self.start)
        self.edges = np.searchsorted(self.row, np.arange(self.n_rows + 1))
        self.hash = hashes(self.data, self.start, self.end, lower=False)
        self.repeated = _later_copies(mix(self.hash + mix(self.row.astype(np.uint64))))
        self.word_hash = hashes(self.data, self.word_start, self.word_end)
        # Words of each line that are the word before.
        same = np.zeros(len(self.word_hash) + 1, np.int64)
        same[2:] = np.cumsum(self.word_hash[1:] == self.word_hash[:-1])
        self.stutters = same[self.first_word + self.n_words] - same[np.minimum(self.first_word + 1, len(same) - 1)]

    def count(self, kind: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(kind[self.data])])
        return sums[end] - sums[start]

    def looks_like_boilerplate(self) -> np.ndarray:
        """Lines of links, symbols or repeated words, and lines that the text has before."""
        symbols = self.count(_SYMBOL, self.start, self.end)
        letters = self.count(_KINDS["letter"], self.start, self.end)
        size = self.end - self.start
        stutter = self.stutters > STUTTER * self.n_words
        return self.repeated | stutter | (symbols > SYMBOLS * size) | (2 * letters < size)

    def features(self) -> crf.Features:
        """What each line looks like: sizes and shares in steps, its first and last word."""
        start, end, words = self.start, self.end, self.n_words
        size = end - start
        share = {k: self.count(v, start, end) / size for k, v in _KINDS.items()}
        capital = self.count(_KINDS["upper"], start, end) / np.maximum(
            self.count(_KINDS["letter"], start, end), 1
        )
        step = lambda x: np.minimum((x * 20).astype(np.int64), 20)
        values = [
            np.minimum(np.log2(words).astype(np.int64), 12),
            np.minimum(size // words, 30),
            step(share["symbol"]),
            step(share["point"]),
            step(share["digit"]),
            step(capital),
            step(share["letter"]),
            _PLAIN_END[self.data[end - 1]].astype(np.int64),
            self.repeated.astype(np.int64),
            np.minimum(np.arange(len(start)) - self.edges[self.row], 3),
            self.word_hash[self.first_word],
            self.word_hash[self.first_word + words - 1],
            step(self.stutters / words),
        ]
        slot = [
            mix(np.asarray(v).astype(np.uint64) * np.uint64(64) + np.uint64(i)) >> np.uint64(64 - _BITS)
            for i, v in enumerate(values)
        ]
        index = np.stack(slot, axis=1).astype(np.int32).ravel()
        return crf.Features(index, np.arange(len(start) + 1) * len(slot))


def _later_copies(key: np.ndarray) -> np.ndarray:
    """Whether the same key stands earlier."""
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = key[order[1:]] == key[order[:-1]]
    return later


def base_counts(lines: Lines) -> dict[str, np.ndarray]:
    """The exact counts of every text."""
    row, n = lines.word_row, lines.n_rows
    per_row = lambda kind: lines.count(kind, lines.offsets[:-1], lines.offsets[1:])
    # Characters of words: bytes that do not continue one, outside separators.
    heads = (np.arange(256) & 0xC0) != 0x80
    chars = lines.count(heads, lines.word_start, lines.word_end)
    exact = hashes(lines.data, lines.word_start, lines.word_end, lower=False)
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": np.bincount(row, chars, n).astype(np.int64),
        "n_symbols": per_row(_SYMBOL),
        "n_dup_lines": np.bincount(lines.row[lines.repeated], minlength=n),
        "n_repeat_words": _words_in_repeats(exact, row, n),
    }


def _words_in_repeats(word: np.ndarray, row: np.ndarray, n_rows: int, k: int = REPEAT_WORDS):
    """Words of each row that lie in a run of ``k`` words which the row has twice or more."""
    key, of, first = shingles(word, row, n_rows, k)
    full = np.bincount(row, minlength=n_rows)[of] >= k
    key, of, first = mix(key[full] + mix(of[full].astype(np.uint64))), of[full], first[full]
    # Most windows are alone in a slot of a table, and so alone; only the others are sorted.
    bits = max(10, int(len(key)).bit_length() + 2)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    crowded = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    _, inverse, count = np.unique(key[crowded], return_inverse=True, return_counts=True)
    begin = first[crowded[count[inverse] > 1]]
    change = np.zeros(len(word) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + k, -1)
    inside = np.cumsum(change[:-1]) > 0
    return np.bincount(row[inside], minlength=n_rows)


def training_sample(docs: DataFrame, labels: DataFrame, per_quality: int) -> DataFrame:
    """``(quality, text)``: of each quality the texts with the least hash of their id."""
    known = labels.select("doc_id", "quality").filter("quality IN (0, 1) AND doc_id IS NOT NULL").distinct()
    chosen = None
    for quality in (0, 1):
        some = known.filter(F.col("quality") == quality)
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_quality)
        chosen = some if chosen is None else chosen.union(some)
    usable = docs.filter(F.length("text") <= LONGEST_TRAINING_TEXT)
    # At most per_quality ids of each quality.
    return usable.join(F.broadcast(chosen), "doc_id").select("quality", "text")


def fit(sample: pa.Table, seed: int = 7, rounds: int = ROUNDS) -> crf.Model | None:
    """A line model from texts of known quality, by constrained expectation and maximisation.

    No line has a label. They begin with what the line alone tells (``_evidence``); then a model is
    learnt from the labels, and labels anew from its posteriors, until they stay. The quality of a
    text says nothing of any one of its lines. It bounds the share of the words in content lines:
    at least ``GOOD_CONTENT`` of a good text, at most ``BAD_CONTENT`` of a bad one. Where the bound
    is broken, the lines nearest to the other label change. Texts that occur more than once count
    once. Without texts of both kinds there is nothing to learn.
    """
    sample = sample.sort_by([("quality", "ascending"), ("text", "ascending")])
    if len(set(sample.column("quality").to_pylist())) < 2:
        return None
    sample = sample.group_by("text", use_threads=False).aggregate([("quality", "min")])
    sample = sample.rename_columns(["text", "quality"])
    found, rows, n_words, hints, n_rows = [], [], [], [], 0
    for batch in sample.to_batches():
        for part in slices(batch, 0):
            lines = Lines(part.column(0))
            found.append(lines.features())
            rows.append(lines.row + n_rows)
            n_words.append(lines.n_words)
            hints.append(lines.looks_like_boilerplate())
            n_rows += part.num_rows
    row, n_words, hint = (np.concatenate(x) for x in (rows, n_words, hints))
    features = crf.Features.joined(found)
    edges = np.searchsorted(row, np.arange(n_rows + 1))
    good = sample.column("quality").to_numpy() == 1
    label = _bounded(np.where(hint, 0.1, 0.9), n_words, edges, good)
    model, rng = None, np.random.default_rng(seed)
    for _ in range(rounds):
        at, cut = _switched(label, edges, rng)
        model = crf.train(
            features, label[at], cut, LABELS, 1 << _BITS, epochs=EPOCHS, seed=seed, position=at
        )
        chance = crf.posteriors(features.emissions(model.weights), edges, model.transition)
        again = _bounded(chance[:, CONTENT], n_words, edges, good)
        moved = np.count_nonzero(again != label)
        label = again
        if moved <= STABLE * len(label):
            break
    return model


def _switched(label: np.ndarray, edges: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of lines ``(line, edges)``: every text with a stretch put into it of lines that are
    labelled otherwise than most of its own, from anywhere in the sample. Few texts of a sample
    change their label; a menu stands in any.
    """
    pools = [np.flatnonzero(label == k) for k in (BOILERPLATE, CONTENT)]
    at, size = [], []
    for i in range(len(edges) - 1):
        own = np.arange(edges[i], edges[i + 1])
        other = pools[int(2 * label[own].sum() < len(own))]
        if len(own) and len(other):
            first, n = rng.integers(len(other)), rng.integers(1, STRETCH + 1)
            place = rng.integers(len(own) + 1)
            own = np.concatenate([own[:place], other[first : first + n], own[place:]])
        at.append(own)
        size.append(len(own))
    return np.concatenate(at), np.concatenate([[0], np.cumsum(size)])


def _bounded(content: np.ndarray, n_words: np.ndarray, edges: np.ndarray, good: np.ndarray):
    """Labels from the chance of content, under the bound that each text's quality sets."""
    label = (content >= 0.5).astype(np.int64)
    for i in range(len(edges) - 1):
        at = np.arange(edges[i], edges[i + 1])
        total, have = n_words[at].sum(), n_words[at[label[at] == CONTENT]].sum()
        if good[i] and have < GOOD_CONTENT * total:
            turned = at[label[at] == BOILERPLATE]
            turned = turned[np.argsort(-content[turned], kind="stable")]
            need = GOOD_CONTENT * total - have
        elif not good[i] and have > BAD_CONTENT * total:
            turned = at[label[at] == CONTENT]
            turned = turned[np.argsort(content[turned], kind="stable")]
            need = have - BAD_CONTENT * total
        else:
            continue
        n = int(np.searchsorted(np.cumsum(n_words[turned]), need)) + 1
        label[turned[:n]] ^= 1
    return label


def learn(
    docs: DataFrame, labels: DataFrame, per_quality: int = TEXTS_PER_QUALITY,
    doc_id: str = "doc_id", text: str = "text",
) -> crf.Model | None:
    """Learn from a bounded sample of the labelled documents, ``per_quality`` of each kind."""
    return crf.fit_in_a_task(training_sample(id_and_text(docs, doc_id, text), labels, per_quality), fit)


def judge(
    docs: DataFrame,
    model: crf.Model | None,
    least_content: float = LEAST_CONTENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts and verdict of every row, and the spans of its boilerplate.

    ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    content_share, boilerplate, kept)``: ``boilerplate`` has the ``(start, end)`` characters of
    the lines that the most probable labelling of the whole text calls so, ``content_share`` is
    the part of its words in the other lines. A text is kept if it passes the base rules and has
    at least ``least_content`` of its words in content lines.

    Null, empty and white texts have no words: they fail the base rules, with content share 0.
    Without a model every line is content. Repeated rows are judged each; an empty table gives an
    empty one; other columns are ignored. A very long text is judged whole by one task; of labellings
    of equal chance the one with boilerplate earlier counts.
    """
    source = id_and_text(docs, doc_id, text)
    sent = crf.Model.sent(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = crf.Model.of(sent.value)
        for batch in batches:
            for part in slices(batch):
                lines = Lines(part.column(1))
                counts = base_counts(lines)
                if model is None:
                    label = np.full(len(lines.row), CONTENT, np.int8)
                else:
                    emission = lines.features().emissions(model.weights)
                    label = crf.viterbi(emission, lines.edges, model.transition)
                content = np.bincount(lines.row, lines.n_words * (label == CONTENT), lines.n_rows)
                n_words = counts["n_words"]
                share = content / np.maximum(n_words, 1)
                failed = (n_words < LEAST_WORDS) | (
                    100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * n_words
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *(pa.array(x, pa.int64()) for x in counts.values()),
                        pa.array(failed), pa.array(share), _character_spans(lines, label),
                        pa.array(~failed & (share >= least_content)),
                    ],
                    ["doc_id", *counts, "base_failed", "content_share", "boilerplate", "kept"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
        " n_repeat_words bigint, base_failed boolean, content_share double,"
        " boilerplate array<struct<start:bigint,end:bigint>>, kept boolean",
    )


def _character_spans(lines: Lines, label: np.ndarray) -> pa.Array:
    """Boilerplate lines of every row as character positions in its text."""
    bad = np.flatnonzero(label == BOILERPLATE)
    heads = np.concatenate([[0], np.cumsum((lines.data & 0xC0) != 0x80)])
    base = heads[lines.offsets[lines.row[bad]]]
    places = pa.StructArray.from_arrays(
        [pa.array(heads[lines.start[bad]] - base), pa.array(heads[lines.end[bad]] - base)],
        ["start", "end"],
    )
    edges = np.searchsorted(lines.row[bad], np.arange(lines.n_rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), places)
