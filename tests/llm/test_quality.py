"""Quality rules: exact counts against plain Python, verdicts on documents not learnt from."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sonomere.llm import quality
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside),
    )


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t#é漢|", max_size=80)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_counts(texts):
    counts = quality.base_counts(quality.Lines(pa.array(texts, pa.string())))
    assert [tuple(int(v[i]) for v in counts.values()) for i in range(len(texts))] == [*map(plain, texts)]


def test_documents(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learnt = labels.filter("doc_id % 2 = 0")
    model = quality.learn(documents, learnt)
    found = quality.judge(documents, model).join(documents.select("doc_id", "text"), "doc_id")
    rows = {r.doc_id: r for r in found.collect()}
    for r in rows.values():
        n_words, *_, repeated = counts = plain(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (n_words < 20 or 100 * repeated > 30 * n_words)
        assert not (r.base_failed and r.kept)
        assert all(r.text[s.start : s.end] in r.text.split("\n") for s in r.boilerplate)
    other = [x for x in labels.filter("doc_id % 2 = 1").collect() if not rows[x.doc_id].base_failed]
    right = sum(rows[x.doc_id].kept == (x.quality == 1) for x in other)
    assert right >= 0.97 * len(other) and {x.quality for x in other} == {0, 1}


def test_odd_documents(spark, odd, none):
    for r in quality.judge(odd, None).collect():
        wanted = [plain(t) for i, t, *_ in ODD if i == r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in wanted
        assert r.kept == (not r.base_failed)
    assert quality.judge(none, None).count() == 0
    labels = spark.createDataFrame([(5, 1), (6, 1), (None, 0)], "doc_id bigint, quality int")
    assert quality.learn(odd, labels) is None


@pytest.mark.parametrize("text, label", [("A plain line of words.", 1), ("a | b | c", 0)])
def test_lines_are_told_apart(spark, text, label):
    rows = [(1, "It was a plain day for all of us.\nSo they went on.")] * 9 + [(0, "x | y | z\nHome | Menu")] * 9
    sample = pa.table({"quality": [q for q, _ in rows], "text": [t for _, t in rows]})
    model = quality.fit(sample)
    lines = quality.Lines(pa.array([text]))
    assert quality.crf.viterbi(lines.features().emissions(model.weights), lines.edges, model.transition) == label


@pytest.fixture(scope="module")
def labelled():
    """Texts of either quality, by whether they are learnt from."""
    pool = {}
    documents = pq.read_table(f"{LARGER}/documents.parquet").to_pylist()
    text = {d["doc_id"]: d["text"] for d in documents}
    for row in pq.read_table(f"{LARGER}/labels.parquet").to_pylist():
        pool.setdefault((row["doc_id"] % 2, row["quality"]), []).append(text[row["doc_id"]] or "")
    return pool


def labels_of(model, texts):
    lines = quality.Lines(pa.array(texts))
    emission = lines.features().emissions(model.weights)
    return quality.crf.viterbi(emission, lines.edges, model.transition)


def test_boilerplate_inside_good_texts(labelled):
    """Lines of menus and signs put into texts not learnt from are found, and their neighbours stay."""
    sample = [(q, t) for q in (0, 1) for t in labelled[0, q]]
    model = quality.fit(pa.table({"quality": [q for q, _ in sample], "text": [t for _, t in sample]}))
    rng = random.Random(4)
    junk = [x for t in labelled[1, 0] for x in t.split("\n") if sum(x.count(c) for c in "#*$%&|<>") > len(x) / 20]
    texts, planted = [], []
    for text in labelled[1, 1]:
        lines = [(x, False) for x in text.split("\n") if x.split()]
        if len(lines) < 5 or plain(text)[0] < 20:
            continue
        for _ in range(rng.randint(1, 3)):
            lines.insert(rng.randrange(len(lines) + 1), (rng.choice(junk)[:200], True))
        texts.append("\n".join(x for x, _ in lines))
        planted += [p for _, p in lines]
    found = labels_of(model, texts)
    assert len(found) == len(planted) and sum(planted) > 100
    called = [f == quality.BOILERPLATE for f in found]
    assert sum(c for c, p in zip(called, planted) if p) >= 0.9 * sum(planted)
    assert sum(c for c, p in zip(called, planted) if not p) <= 0.03 * planted.count(False)


@given(
    st.lists(st.tuples(st.booleans(), st.lists(st.tuples(st.floats(0, 1), st.integers(1, 30)), max_size=8)), min_size=1, max_size=6)
)
@settings(max_examples=100, deadline=None)
def test_quality_bounds_the_share(texts):
    chance = np.array([c for _, lines in texts for c, _ in lines])
    words = np.array([w for _, lines in texts for _, w in lines], np.int64)
    edges = np.cumsum([0] + [len(lines) for _, lines in texts])
    label = quality._bounded(chance, words, edges, np.array([g for g, _ in texts]))
    for (good, _), lo, hi in zip(texts, edges, edges[1:]):
        have, total = words[lo:hi][label[lo:hi] == 1].sum(), words[lo:hi].sum()
        assert not total or (have >= quality.GOOD_CONTENT * total if good else have <= quality.BAD_CONTENT * total)
        # No line passes one that is nearer to the other label.
        kept = chance[lo:hi][label[lo:hi] == 1]
        gone = chance[lo:hi][label[lo:hi] == 0]
        assert not len(kept) or not len(gone) or kept.min() >= gone.max()
