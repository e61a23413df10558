"""Benchmark items in documents: exact, edited and reordered copies, and clean text."""

import random

import numpy as np
import pytest

from sonomere.llm import decontamination
from tests.llm.conftest import ODD, prose, table

ITEMS = [(i, prose(1000 + i, n)) for i, n in enumerate([40, 25, 60, 12, 8, 3, 1])]


def smith_waterman(a, b):
    best = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1, j + 1] = max(
                0, best[i, j] + (1 if a[i] == b[j] else -1), best[i, j + 1] - 1, best[i + 1, j] - 1
            )
    return best.max()


def test_alignment():
    rng = np.random.default_rng(2)
    items = [rng.integers(5, 9, rng.integers(1, 12)).astype(np.uint64) for _ in range(40)]
    windows = [rng.integers(5, 9, rng.integers(0, 20)).astype(np.uint64) for _ in range(40)]
    score, start, end = decontamination._aligned(items, windows)
    for a, b, s, x, y in zip(items, windows, score, start, end):
        assert s == smith_waterman(a.tolist(), b.tolist())
        assert 0 <= x <= y <= len(b) and smith_waterman(a.tolist(), b[x:y].tolist()) == s


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [*ITEMS, (90, None), (91, ""), (92, " .,! "), (0, ITEMS[0][1]), (None, prose(77, 30))]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, item string")


def edited(text, step, kind):
    new = {"replace": lambda w: ["other"], "drop": lambda w: [], "insert": lambda w: [w, "more"]}[kind]
    return " ".join(x for i, w in enumerate(text.split(" "), 1) for x in ([w] if i % step else new(w)))


def planted():
    rng = random.Random(3)
    rows, wanted = [], set()
    for n, (item, text) in enumerate(ITEMS[:-1]):  # an item of one word is in no longer text
        rows.append((n, prose(n, 100) + " " + text.upper() + "\n" + prose(n + 50, 100), "en"))
        wanted.add((n, item))
    for n, (kind, step) in enumerate([("replace", 6), ("drop", 5), ("insert", 4)]):
        for item, text in ITEMS[:3]:
            i = 100 + 10 * n + item
            rows.append((i, prose(i, rng.randint(0, 300)) + " " + edited(text, step, kind) + " " + prose(i + 7, 9), "en"))
            wanted.add((i, item))
    rows += [(200 + i, prose(2000 + i, 200), "en") for i in range(30)]
    rows.append((300, prose(3000, 5000) + " " + ITEMS[2][1] + " " + prose(3001, 3000) + " " + edited(ITEMS[2][1], 9, "drop"), "en"))
    return rows, wanted | {(300, 2)}


@pytest.mark.parametrize("block", [16 << 20, 100])
def test_planted_items(spark, benchmark, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows, wanted = planted()
    docs = table(spark, rows).repartition(3)
    found = decontamination.find_items(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    assert len(found) == len(wanted)
    whole = {r.doc_id: r for r in found}
    text = whole[0]
    assert text.score == 1.0 and text.end_word - text.start_word == text.n_words
    assert whole[300].score == 1.0


def test_hot_leak_keeps_its_seeds(spark, benchmark):
    rows = [(i, prose(i, 20) + " " + ITEMS[0][1], "en") for i in range(300)]
    found = decontamination.find_items(table(spark, rows), benchmark)
    assert found.filter("item_id = 0").count() == 300


def test_odd_documents(odd, none, benchmark):
    assert decontamination.find_items(odd, benchmark).count() == 0
    assert decontamination.find_items(none, benchmark).count() == 0
    empty = decontamination.find_items(odd, benchmark.filter("false"))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "item_id", "n_words", "score", "start_word", "end_word"]
    twice = decontamination.find_items(odd, odd.selectExpr("doc_id AS item_id", "text")).collect()
    assert {(r.doc_id, r.item_id) for r in twice if r.doc_id in (6, 7)} == {(6, 6), (6, 7), (7, 6), (7, 7)}
    assert len(twice) == len({(r.doc_id, r.item_id) for r in twice})
    assert len(ODD) == odd.count()
