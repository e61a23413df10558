"""Merkle manifests of tables: subtrees exchanged between superblocks of leaves.

Leaves are numbered inside their group and cut into superblocks of ``SPAN`` in a row. A superblock
is an aligned subtree: it reduces to one node without any other's help. Those nodes are numbered by
their superblock and cut into superblocks again, and so on up to the root of the group; the roots
of the groups are leaves of one more tree. On the way back down, the nodes of every superblock and
the path from its own node to the root meet in one cogroup.
"""

import hashlib
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomere.operators.frames import number_frames
from sonomere.storage import written

# Levels of the tree inside a superblock, and its leaves: all that one task holds of a table.
LEVELS = 12
SPAN = 1 << LEVELS

# A step of a path: what stands beside a node on its level, and on which side.
_ALONE, _LEFT, _RIGHT = b"0", b"1", b"2"
_DIGEST = 64


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


# What happens inside a superblock


def _height(n: int, block: int) -> int:
    """Levels of a superblock of ``n`` nodes. Any but the first has others before it, so it is
    reduced over all levels, even if its last nodes have no partner; the first one, if not full, is
    the whole tree.
    """
    return LEVELS if block else (n - 1).bit_length()


def _tree(nodes: list[bytes], block: int) -> list[list[bytes]]:
    """The nodes on every level, the given ones first and the superblock's own node last."""
    levels = [nodes]
    for _ in range(_height(len(nodes), block)):
        below = levels[-1]
        levels.append([_hash(b"".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def _path(levels: list[list[bytes]], i: int) -> bytes:
    """The steps from node ``i`` up to the superblock's own node."""
    steps = []
    for level in levels[:-1]:
        if i & 1:
            steps += _LEFT, level[i - 1]
        elif i + 1 < len(level):
            steps += _RIGHT, level[i + 1]
        else:
            steps.append(_ALONE)
        i >>= 1
    return b"".join(steps)


def steps_of(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """``(side, sibling)`` of every step; the sibling of a lone node is empty."""
    at = 0
    while at < len(path):
        side = path[at : at + 1]
        size = 0 if side == _ALONE else _DIGEST
        yield side, path[at + 1 : at + 1 + size]
        at += 1 + size


def fold(node: bytes, path: bytes) -> bytes:
    """The root that a node and its path lead to."""
    for side, sibling in steps_of(path):
        node = _hash(sibling + node if side == _LEFT else node + sibling)
    return node


def proof_digest(path: bytes) -> bytes:
    return _hash(b"".join(sibling for _, sibling in steps_of(path)))


# Superblocks as groups


def _own_nodes(nodes: DataFrame) -> DataFrame:
    """``(tree, pos, node)`` one tier up: the node of every superblock of ``(tree, pos, node)``."""

    def reduce(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        tree, block = key
        top = _tree(rows.sort_values("pos")["node"].tolist(), block)[-1][0]
        return pd.DataFrame({"tree": [tree], "pos": [block], "node": [top]})

    blocks = nodes.select("tree", "pos", "node", _block())
    return blocks.groupBy("tree", "block").applyInPandas(
        reduce, "tree string, pos bigint, node binary"
    )


def _block() -> Column:
    return F.shiftright("pos", LEVELS).alias("block")


def _tiers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of all trees tier by tier, and ``(tree, node)`` with the root of each. Every tier
    is written; only the largest position in it comes to the driver.
    """
    tiers = [nodes]
    while True:
        above = written(_own_nodes(tiers[-1]), "subtrees")
        if not above.agg(F.max("pos")).first()[0]:
            return tiers, above.select("tree", "node")
        tiers.append(above)


def _paths_down(tiers: list[DataFrame], paths: DataFrame) -> DataFrame:
    """``(tree, pos, path, subroot, root)`` of the superblocks of the lowest tier, from
    ``(tree, pos, path, subroot, root)`` of the roots of the trees.
    """

    def extend(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        block = int(nodes["block"].iat[0])
        levels = _tree(nodes["node"].tolist(), block)
        path, subroot, root = outer[["path", "subroot", "root"]].iloc[0]
        return pd.DataFrame({
            "tree": nodes["tree"], "pos": nodes["pos"],
            "path": [_path(levels, i) + path for i in range(len(nodes))],
            "subroot": subroot, "root": root,
        })

    for tier in reversed(tiers[1:]):
        inner = tier.select("tree", "pos", "node", _block()).groupBy("tree", "block")
        outer = paths.withColumnRenamed("pos", "block").groupBy("tree", "block")
        paths = written(
            inner.cogroup(outer).applyInPandas(
                extend, "tree string, pos bigint, path binary, subroot binary, root binary"
            ),
            "paths",
        )
    return paths


def _numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``pos`` inside a tree, by ranges of all rows, so that a tree of any size is split."""
    return number_frames(rows, [tree], order, frame="pos")


def leaf_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 over the columns of a row, each as its byte count, a colon and its text, or a dash
    if it is null. Hexadecimal.
    """
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def merkle_manifest(
    table: DataFrame,
    columns: Sequence[str],
    tree: str,
    key: str,
    claimed: Sequence[Column] | None = None,
) -> DataFrame:
    """``(key, leaf, path, proof_sha256, subroot, root, folded_root, verified)`` of every row.

    A row's leaf is the hash of ``columns``. The leaves of every value of ``tree`` make a tree, by
    ascending ``key``; pairs of neighbours, or the last one alone, become the hash of their
    concatenation until one is left, the subroot. Subroots, by ascending ``tree`` with null first,
    make a tree in the same way, whose top is the root of the table. ``path`` holds the side and
    digest of all siblings from the leaf to the root (``steps_of``), ``proof_sha256`` is the hash
    of these digests. ``folded_root`` is what the leaf of the ``claimed`` columns, as somebody else
    has them, leads to on that path; ``verified`` says whether it is the root.

    Null keys come first. Rows with the same tree and key are ordered by their leaves, and equal
    rows have one position each. Null columns, keys and trees have digests like all others; an
    empty table gives an empty one; other columns are ignored. Texts are hashed in the JVM, row by
    row, and only digests are shuffled, so a very long text is one row in one task. No task holds
    more than a superblock of 4,096 leaves, however large a tree is.
    """
    kind = table.schema[key].dataType.simpleString()
    leaf = leaf_hash([F.col(c) for c in columns])
    other = leaf_hash(claimed) if claimed is not None else leaf
    # Null sorts before every value; the order of strings is that of their bytes.
    name = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("1"), F.col(tree).cast("string")))
    # Digests travel as 32 bytes; written first, since range bounds are sampled from them.
    leaves = written(
        table.select(
            name.alias("tree"), F.col(key).alias("key"), F.unhex(leaf).alias("leaf"),
            F.unhex(other).alias("claimed"),
        ),
        "leaves",
    )
    leaves = written(_numbered(leaves, "tree", ["key", "leaf", "claimed"]), "numbered-leaves")
    as_node = F.lower(F.hex("leaf")).cast("binary").alias("node")
    tiers, subroots = _tiers(leaves.select("tree", "pos", as_node))
    paths = _paths_down(tiers, _root_paths(subroots))

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        block = int(nodes["block"].iat[0])
        given = [x.hex().encode() for x in nodes["leaf"]]
        levels = _tree(given, block)
        path, subroot, root = outer[["path", "subroot", "root"]].iloc[0]
        all_paths = [_path(levels, i) + path for i in range(len(given))]
        folded = [fold(x.hex().encode(), p) for x, p in zip(nodes["claimed"], all_paths)]
        return pd.DataFrame({
            "key": nodes["key"].to_numpy(), "leaf": [x.decode() for x in given],
            "path": all_paths, "proof_sha256": [proof_digest(p).decode() for p in all_paths],
            "subroot": subroot.decode(), "root": root.decode(),
            "folded_root": [x.decode() for x in folded], "verified": [x == root for x in folded],
        })

    # Keys go through pandas as text: it would turn integers next to a null into doubles.
    inner = leaves.select("tree", "pos", F.col("key").cast("string").alias("key"), "leaf", "claimed", _block())
    outer = paths.withColumnRenamed("pos", "block")
    found = inner.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(
        finish,
        "key string, leaf string, path binary, proof_sha256 string, subroot string, root string,"
        " folded_root string, verified boolean",
    )
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)


def _root_paths(subroots: DataFrame) -> DataFrame:
    """``(tree, pos, path, subroot, root)`` of every subroot in the tree of all subroots."""
    named = subroots.select(F.lit("").alias("all"), F.col("tree").alias("name"), "node")
    named = written(_numbered(named, "all", ["name"]), "subroots")
    tiers, top = _tiers(named.select(F.col("all").alias("tree"), "pos", "node"))
    start = top.select(
        "tree", F.lit(0).cast("bigint").alias("pos"), F.lit(b"").alias("path"),
        F.col("node").alias("subroot"), F.col("node").alias("root"),
    )
    # The lowest tier as one more: its nodes are the subroots.
    down = _paths_down([None, *tiers], start)
    return named.join(down.select("pos", "path", "root"), "pos").select(
        F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path",
        F.col("node").alias("subroot"), "root",
    )
