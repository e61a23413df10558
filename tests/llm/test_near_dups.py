"""Near-duplicate documents against all pairs of full sets."""

import itertools
import random

import numpy as np
import pytest

from sonomere.llm import near_dups
from tests.llm.conftest import ODD, prose, table, words_of


def expected(rows, percent):
    def shingles(text):
        w = words_of(text)
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    out = []
    for i, s in sets:
        component = None if i is None else find(i) if s else i
        out.append((i, len(s), component, i is None or component == i))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def edited(text, n, rng):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "edit" + str(rng.randrange(10**6))
    return " ".join(w)


@pytest.mark.parametrize("percent", [80, 85])
def test_against_all_pairs(spark, percent):
    rng = random.Random(percent)
    rows, i = [], 0
    for family in range(12):
        base = prose(family, rng.choice([6, 30, 120, 400]))
        for _ in range(rng.randint(1, 12)):
            rows.append((i, edited(base, rng.choice([0, 0, 1, 2, 4, 8]), rng), "en"))
            i += 1
    # A chain whose ends are not linked with each other, and a bucket whose least id is a stranger.
    w = prose(99, 200).split(" ")
    rows += [(1000 + s, " ".join(w[4 * s : 4 * s + 120]), "en") for s in range(12)]
    rng.shuffle(rows)
    docs = table(spark, rows).repartition(5)
    found = near_dups.near_duplicates(docs, percent=percent).collect()
    assert ordered(map(tuple, found)) == ordered(expected(rows, percent))


def test_odd_documents(odd, none):
    found = near_dups.near_duplicates(odd).collect()
    assert ordered(map(tuple, found)) == ordered(expected(ODD, 85))
    assert near_dups.near_duplicates(none).count() == 0


def test_estimate_and_bands():
    rng = np.random.default_rng(1)
    shape = near_dups.Shape()
    estimate = near_dups.Estimator(shape.registers)
    near = met = far = far_met = 0
    for n in (40, 300, 5000):
        for s in (0.1, 0.85):
            for _ in range(30):
                both = int(round(2 * n * s / (1 + s)))
                pool = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
                a, b = pool[:n], np.concatenate([pool[:both], pool[n:]])
                regs = near_dups.registers([np.sort(a), np.sort(b)], shape.registers)
                keys = near_dups.band_keys(regs, shape)
                hit = bool((keys[0] == keys[1]).any())
                found, used = estimate(regs[:1], regs[1:], np.array([n]), np.array([n]))
                assert abs(found[0] - s) < 6 * np.sqrt(s * (1 - s) / used[0]) + 0.02
                if s > 0.5:
                    near, met = near + 1, met + hit
                else:
                    far, far_met = far + 1, far_met + hit
    assert met == near and far_met <= 2


def test_chance_agreements_are_few():
    assert 0 < near_dups.chance_agreements(1e6, 1e6, 252) < 1
