"""Periodic runs against all periods of all stretches."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sonomere.llm import periodic_runs
from sonomere.llm.queries import periodic_digests
from tests.llm.conftest import ODD, table


def plain_runs(words):
    """Every period of every text position, with all stretches that no word extends."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(12, 2 * q):
                found.setdefault((start, i), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def numbered(words):
    return periodic_runs._numbers([str(w).encode() for w in words])


@given(st.lists(st.integers(0, 2), max_size=90))
@settings(max_examples=400, deadline=None)
def test_few_words(words):
    assert periodic_runs.runs_of(numbered(words)) == plain_runs(words)


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9)), max_size=9))
@settings(max_examples=300, deadline=None)
def test_nested_repeats(parts):
    words = [w for part, times in parts for w in part * times]
    words += words
    assert periodic_runs.runs_of(numbered(words)) == plain_runs(words)


@pytest.mark.parametrize("period", [*range(1, 26), 31, 32, 33, 63, 64, 65, 100, 255, 257])
def test_every_period(period):
    rng = random.Random(period)
    for length in (max(12, 2 * period) - 1, max(12, 2 * period), 3 * period + 14):
        unit = [f"u{i}" for i in range(period)]
        run = [unit[i % period] for i in range(length)]
        words = [f"a{i}" for i in range(rng.randrange(40))] + run + ["z", *unit]
        assert periodic_runs.runs_of(numbered(words)) == plain_runs(words)


def test_one_word_forever():
    """A text of one word has one diagonal, not one for each pair of its words."""
    words = np.zeros(30_000, np.int64)
    assert periodic_runs.runs_of(words) == [(0, 30_000, 1)]
    position, _ = periodic_runs.sparse_diagonals(words)
    assert len(position) < 100 * len(words)
    two = np.array(([0, 1] * 3000 + [2]) * 3)
    assert periodic_runs.runs_of(two) == plain_runs(two.tolist())


def plain_rows(rows):
    out = []
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(words)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        top = min(((-size, s, q) for s, size, q in runs), default=None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((
            doc_id, len(runs), *((None,) * 4 if top is None else (top[1], -top[0], top[2], -top[0] * 1000 // top[2])),
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    return out


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_query_against_plain(spark):
    rng = random.Random(3)
    rows = [r for r in ODD if len(r[1] or "") < 50_000]
    for i in range(100, 300):
        words = [rng.choice(["the", "a", "b", "line", "é", "漢"]) for _ in range(rng.randrange(60))]
        rows.append((i, rng.choice([" ", "\n", "\t \r"]).join(words * rng.randrange(1, 4)), "en"))
    rows.append((301, "word " * 3000, "en"))
    found = periodic_digests(table(spark, rows)).select(COLUMNS).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_rows(rows), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows if i)


def test_odd_tables(odd, none):
    found = periodic_runs.find_periodic_runs(odd).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].collapsed is None and by_id[1].n_words == 0 and by_id[1].runs == []
    assert by_id[3].collapsed == "" and by_id[6].collapsed == "one two"
    assert periodic_digests(none).count() == 0
    assert periodic_digests(odd).count() == len(ODD)
