"""Merkle manifests against a plain tree."""

import hashlib
import random
import zlib

import pytest

from sonomere.llm import merkle
from sonomere.llm.queries import audited_documents
from tests.llm.conftest import ODD, table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        pair = level[i // 2 * 2 : i // 2 * 2 + 2]
        out.append((i % 2, [x for k, x in enumerate(pair) if k != i % 2]))
        i //= 2
    return out


def plain_rows(rows):
    docs = []
    for i, t, lang in rows:
        n = None if t is None else len(t)
        changed = n
        if i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None:
            changed = n + 1
        docs.append((lang, i, plain_leaf((i, "s", lang, n, t)), plain_leaf((i, "s", lang, changed, t))))
    none_first = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    names = sorted({d[0] for d in docs}, key=none_first)
    groups = {k: sorted((d for d in docs if d[0] == k), key=lambda d: (none_first(d[1]), d[2:])) for k in names}
    trees = {k: plain_tree([d[2] for d in g]) for k, g in groups.items()}
    top = plain_tree([trees[k][-1][0] for k in names])
    root = top[-1][0]
    out = []
    for at, k in enumerate(names):
        for i, (_, doc_id, leaf, claimed) in enumerate(groups[k]):
            path = plain_path(trees[k], i) + plain_path(top, at)
            node = claimed
            for right, others in path:
                node = sha("".join([*others, node] if right else [node, *others]))
            proof = sha("".join(x for _, others in path for x in others))
            out.append((doc_id, leaf, proof, trees[k][-1][0], root, node, node == root))
    return out


COLUMNS = "doc_id leaf proof_sha256 subroot root folded_root verified".split()


def same(found, rows):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found.select(COLUMNS).collect()), key=key) == sorted(plain_rows(rows), key=key)


def test_odd_tables(odd, none, spark):
    same(audited_documents(odd), ODD)
    assert audited_documents(none).count() == 0
    same(audited_documents(table(spark, [(7, "alone", "en")])), [(7, "alone", "en")])
    same(audited_documents(table(spark, [(None, None, None)])), [(None, None, None)])


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_small_superblocks(spark, monkeypatch, levels):
    """Tiers of superblocks, full and partial, in trees of every size and in the tree of trees."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = random.Random(levels)
    rows, i = [], 0
    for lang in [None, "", "é", "z", "aa", "漢", "b", "c", "d", "e"]:
        for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 16, 17, 21])):
            rows.append((i, rng.choice([None, "", f"text {i}", "same"]), lang))
            i += rng.choice([0, 1, 1, 7])
    rng.shuffle(rows)
    same(audited_documents(table(spark, rows)), rows)


@pytest.mark.parametrize("n", [4095, 4096, 4097, 8193])
def test_over_superblock_ends(spark, n):
    rows = [(i, "x", "en" if i % 50 else "de") for i in range(n)]
    same(audited_documents(table(spark, rows)), rows)


def test_paths_fold_to_the_root_and_no_other_leaf_does(odd):
    found = merkle.merkle_manifest(odd, ["doc_id", "text"], "lang", "doc_id").collect()
    for r in found:
        assert r.verified and merkle.fold(r.leaf.encode(), r.path).decode() == r.root
        assert merkle.fold(sha("other").encode(), r.path).decode() != r.root


def test_no_task_holds_a_tree(spark):
    """Leaves are grouped by superblock, and no window or group has a whole tree."""
    rows = [(i, "x", "en") for i in range(100)]
    found = audited_documents(table(spark, rows))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
