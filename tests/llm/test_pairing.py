"""Pairs of sets that can be similar: none is lost, and copies of copies make few."""

import itertools
import random

import pytest

from sonomere.llm import pairing


def frames(spark, sets, component):
    members = spark.createDataFrame([(i, component(i)) for i in sets], "id bigint, component bigint")
    rows = [(i, e) for i, s in sets.items() for e in s]
    return members, spark.createDataFrame(rows, "id bigint, element bigint")


@pytest.mark.parametrize("per_mille", [800, 850, 500])
def test_no_similar_pair_is_lost(spark, per_mille):
    rng = random.Random(per_mille)
    sets = {}
    for i in range(150):
        base = range(1000 * (i % 5), 1000 * (i % 5) + 10 + 7 * (i % 4))
        kept = {e for e in base if rng.random() < 0.93}
        sets[i] = kept | {rng.randrange(10**6, 10**6 + 40) for _ in range(rng.randint(0, 3))} or {i}
    members, elements = frames(spark, sets, lambda i: i % 7)
    found = {(r.a, r.b) for r in pairing.across(members, elements, per_mille).collect()}
    wanted = {
        (a, b) for a, b in itertools.combinations(sets, 2)
        if a % 7 != b % 7 and 1000 * len(sets[a] & sets[b]) >= per_mille * len(sets[a] | sets[b])
    }
    assert wanted and wanted <= found
    assert all(a % 7 != b % 7 for a, b in found)


def test_far_copies_of_one_set_make_few_pairs(spark):
    rng = random.Random(1)
    sets = {i: set(range(150)) - {*rng.sample(range(150), 14)} | {1000 * (i + 1) + j for j in range(14)} for i in range(200)}
    members, elements = frames(spark, sets, lambda i: i)
    assert pairing.across(members, elements, 850).count() < 200


def test_the_original_is_the_pivot(spark):
    # Ten buckets; the original is in all, every copy in three.
    rng = random.Random(2)
    rows = [(k, 500) for k in range(10)] + [(k, i) for i in range(60) for k in rng.sample(range(10), 3)]
    rows += [(99, 7)]
    found = pairing.with_pivot(spark.createDataFrame(rows, "key bigint, id bigint")).collect()
    assert {r.pivot for r in found} == {500} and 99 not in {r.key for r in found}
    assert pairing.stars(spark.createDataFrame(found)).count() == 60
