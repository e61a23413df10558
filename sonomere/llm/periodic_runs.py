"""Periodic runs of words: an online dynamic program over the diagonals that can hold one."""

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomere.llm.batches import id_and_text, mix, slices

# A run has at least so many words, and at least so many periods.
LEAST_LENGTH = 12
LEAST_PERIODS = 2
# Every run holds so many equal words in a row on its diagonal: max(12 - q, q) is least at q = 6.
_LEAST_MATCH = 6
_STEP = 0x9E3779B97F4A7C15
_NO_DIAGONALS = (np.empty(0, np.int64), np.empty(0, np.int64))


def _signatures(value: np.ndarray, size: int) -> np.ndarray:
    """64-bit signature of every ``size`` words in a row, by doubling: a stretch is the sum of two
    that overlap nowhere, the earlier one shifted.
    """
    out, have = np.zeros(len(value) - size + 1, np.uint64), 0
    part, length = value, 1
    while length <= size:
        if size & length:
            scale = np.uint64(pow(_STEP, have, 1 << 64))
            # Words from the end of the stretch forwards have ever higher powers.
            at = size - have - length
            out += scale * part[at : at + len(out)]
            have += length
        part = part[length:] + np.uint64(pow(_STEP, length, 1 << 64)) * part[: len(part) - length]
        length *= 2
        if not len(part):
            break
    return mix(out)


def _repeated(sign: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the signatures that occur twice or more, with the number of their group; positions
    ascend inside a group.
    """
    order = np.argsort(sign, kind="stable")
    ordered = sign[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(sign), bool)
    twice[1:] = same
    twice[:-1] |= same
    group = np.zeros(len(sign), np.int64)
    group[1:] = np.cumsum(~same)
    return order[twice], group[twice], twice


def sparse_diagonals(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position, lag)`` of the earlier occurrences worth following, by position, then lag.

    A run of period q in [low, 2 low) has at least ``low`` equal words in a row on diagonal q, and
    so a whole block of ``low / 2`` of them that begins at a multiple of its size. Only blocks that
    occur again at such a lag open a diagonal: at most four per word and level, whatever the text,
    while every occurrence of every word would be their square.
    """
    n = len(word)
    value = mix(word.astype(np.uint64) + np.uint64(1))
    found = []
    low, high, block = 1, 8, 3
    if n < LEAST_LENGTH or not len(_repeated(_signatures(value, _LEAST_MATCH))[0]):
        return _NO_DIAGONALS
    end = np.arange(block - 1, n)  # last words of the blocks that may occur twice
    while LEAST_PERIODS * low <= n and len(end):
        order, group, _ = _repeated(_signatures(value, block)[end - (block - 1)])
        at = end[order]
        key = group * (n + 1) + at
        mine = np.flatnonzero((at + 1) % block == 0)
        base, here = group[mine] * (n + 1), at[mine]
        first = np.searchsorted(key, base + np.maximum(here - high + 1, 0))
        stop = np.searchsorted(key, base + np.maximum(here - low, -1), "right")
        many = np.maximum(stop - first, 0)
        inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        here = np.repeat(here, many)
        found.append((here, here - at[np.repeat(first, many) + inner]))
        end = np.sort(at)
        low, high = high, 2 * high
        block = low // 2
        end = end[end >= block - 1]
    if not found:
        return _NO_DIAGONALS
    position, lag = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((lag, position))
    return position[order], lag[order]


def runs_of(word: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a text of word numbers, by start, then period.

    Goes through the words once. ``active`` has the lags on which the words now match those before,
    with the length of the match; an earlier occurrence opens one, each further word lengthens it,
    and the first that differs ends it and emits a run if it is long enough.
    """
    position, lags = (x.tolist() for x in sparse_diagonals(word))
    if not position:
        return []
    word, n = word.tolist(), len(word)
    active: dict[int, int] = {}
    period_of: dict[tuple[int, int], int] = {}
    i, k, total = -1, 0, len(position)
    while k < total or active:
        i = i + 1 if active else position[k]
        ended = []
        for lag, matched in active.items():
            if i < n and word[i] == word[i - lag]:
                active[lag] = matched + 1
            else:
                ended.append(lag)
        for lag in ended:
            matched = active.pop(lag)
            if matched + lag >= max(LEAST_LENGTH, LEAST_PERIODS * lag):
                # A stretch that repeats at several lags has the smallest of them as its period.
                stretch = (i - matched - lag, i)
                period_of[stretch] = min(lag, period_of.get(stretch, lag))
        while k < total and position[k] == i:
            lag = lags[k]
            k += 1
            # Inside a run of period d, a multiple of d that its words already span begins and
            # ends where the run does, so it has no run of its own.
            if lag in active or any(
                lag % d == 0 and matched + d >= lag for d, matched in active.items()
            ):
                continue
            j = i
            while j >= lag and word[j] == word[j - lag]:
                j -= 1
            active[lag] = i - j
    return sorted((start, stop - start, q) for (start, stop), q in period_of.items())


def _numbers(words: list[bytes]) -> np.ndarray:
    number: dict[bytes, int] = {}
    following = count()
    return np.fromiter(
        (number[w] if w in number else number.setdefault(w, next(following)) for w in words),
        np.int64, len(words),
    )


def find_periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row.

    ``runs`` has ``(start, length, period)`` of every stretch of words, numbered from 0, that
    repeats with its smallest period at least twice and over 12 words or more, and that no word
    next to it continues; by start, then period. ``collapsed`` is the text with words joined by one
    space and without the words that any run repeats: of each run its first period stays.

    Words are separated by ASCII white space. Null text has no words, no runs and null
    ``collapsed``; empty and white text likewise, with empty ``collapsed``. Runs that share words,
    or of several periods, are all given. Repeated rows are each searched; an empty table gives an
    empty one; other columns are ignored. No shuffle. A very long text is searched whole: its words
    are held by one task, about ten times the bytes of the text.
    """
    source = id_and_text(docs, doc_id, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                n_words, n_runs, runs, collapsed = [], [0], [], []
                for value in part.column(1).cast(pa.large_binary()):
                    value = value.as_py()
                    words = (value or b"").split()  # fixed: bytes 0x20, 0x09 to 0x0D
                    found = runs_of(_numbers(words)) if len(words) >= LEAST_LENGTH else []
                    n_words.append(len(words))
                    runs += found
                    n_runs.append(len(runs))
                    if found:
                        gone = np.zeros(len(words) + 1, np.int64)
                        for start, length, period in found:
                            gone[start + period] += 1
                            gone[start + length] -= 1
                        stays = np.cumsum(gone[:-1]) == 0
                        words = [words[i] for i in np.flatnonzero(stays).tolist()]
                    collapsed.append(None if value is None else b" ".join(words))
                fields = np.array(runs, np.int64).reshape(-1, 3)
                spans = pa.StructArray.from_arrays(
                    [pa.array(fields[:, i]) for i in range(3)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n_words, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(n_runs, pa.int32()), spans),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint,"
        " runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string",
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth, by the checksum of their id, repeats a stretch of its words to
    its end; for them words are joined by one space. A null id or text, or one without words, is
    left as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")
    # Fixed value: every tenth checksum.
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)
    )
    chosen = chosen.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rest = F.col("n") - F.col("a")
    period = (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int")
    chosen = chosen.withColumn("p", period)
    cycle = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.flatten(F.array_repeat(cycle, F.ceil(rest / F.col("p")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), rest))
    return chosen.select("doc_id", F.coalesce(F.array_join(planted, " "), "text").alias("text"))


def longest(runs: Column) -> Column:
    """The run of greatest length, of those the first, of those the one with the least period, as
    ``(less, start, period)`` with the length negated; null without a run.
    """
    return F.array_min(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"]))
    )


def listed(runs: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    line = lambda r: F.concat(
        F.concat_ws(",", *(r[x].cast("string") for x in ("start", "length", "period"))), F.lit("\n")
    )
    return F.array_join(F.transform(runs, line), "")
