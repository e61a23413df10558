"""Connected components of links between rows, without collecting any of them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.storage import written


def _with_least(edges: DataFrame) -> DataFrame:
    """Every edge with ``m``, the least of its ``u`` and all neighbours of ``u``.

    Minima are aggregated map-side and joined back, so a node with very many edges is no group
    of rows in any task.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = _with_least(edges)
    lower = down.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(down.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``links(a, b)``: the smallest id reachable from it.

    Alternates large-star and small-star steps until every edge points at its component's least
    id; each step is written to the shared folder, so a lost executor repeats one step. Ids can
    be of any ordered type; links with a null end and from an id to itself say nothing; an empty
    table has no component.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written(edges.filter("a <> b").distinct(), "links")
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)).distinct(), "links")
        row = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")
        ).first()
        if (row.n, row.s) == state:
            break
        state = (row.n, row.s)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
