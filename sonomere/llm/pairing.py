"""Which members of a bucket to compare, without comparing all with all.

A bucket is all rows ``(key, id)`` of one key. Its members are first compared with one pivot; the
links found make components, and members of one component need no comparison any more.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonomere.storage import written


def with_pivot(rows: DataFrame) -> DataFrame:
    """``(key, id, pivot)`` of all buckets with two members or more; ``rows`` are distinct.

    The pivot is the member that meets the most others in all its buckets, the largest id of
    equal ones: the text that copies were made from resembles each of them more than they
    resemble each other, so it meets them more often.
    """
    shared = rows.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    return weighed(written(rows.join(shared, "key"), "buckets"))


def weighed(rows: DataFrame) -> DataFrame:
    """``with_pivot`` of buckets whose sizes are known: ``(key, id, m)``."""
    weight = rows.groupBy("id").agg(F.sum("m").alias("weight"))
    rows = rows.drop("m").join(weight, "id")
    pivot = rows.groupBy("key").agg(F.max(F.struct("weight", "id")).alias("p"))
    return written(rows.join(pivot, "key").select("key", "id", F.col("p.id").alias("pivot")), "buckets")


def stars(buckets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of every pivot and its bucket's other members."""
    others = buckets.filter("id <> pivot")
    return others.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()


def unsettled(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """``(id, component)`` of the members of buckets that lie, without the pivot, in different
    components of ``found(id, component)``. The pivot has met them all.
    """
    placed = buckets.filter("id <> pivot").select("key", "id").join(found, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    placed = placed.join(mixed.filter("x <> y").select("key"), "key", "left_semi")
    return written(placed.select("id", "component").distinct(), "unsettled")


def _at_least(share: int, whole: int, n: Column) -> Column:
    """The least integer not below ``share / whole * n``, in integers."""
    return ((n * share + (whole - 1)) / whole).cast("bigint")


def across(members: DataFrame, elements: DataFrame, per_mille: int) -> DataFrame:
    """Pairs ``(a, b)`` of members in different components that can have that similarity.

    ``elements(id, element)`` has the sets of all members, ordered here by how rare an element is
    among them. Sets of n and m members, n >= m, that reach the similarity t have at least
    t / (1 + t) * (n + m) elements in common, so the first common one is among the first few of
    each: the smaller set is found by its first m - 2t / (1 + t) * m + 1 elements, the larger one
    by its first n - t * n + 1, and what is left after that element, and after the elements that
    no other set has, must suffice. All of this is exact. Copies that are too far from their
    original differ from each other in rare elements, which come first, so they rarely meet.
    """
    counts = elements.groupBy("element").agg(F.count("*").alias("df"))
    by_rarity = Window.partitionBy("id").orderBy("df", "element")
    whole = Window.partitionBy("id")
    ranked = elements.join(counts, "element").select(
        "id", "element", F.row_number().over(by_rarity).cast("bigint").alias("rank"),
        F.count("*").over(whole).alias("n"), F.count_if(F.col("df") > 1).over(whole).alias("shared"),
    )
    longest = F.col("n") - _at_least(per_mille, 1000, F.col("n")) + 1
    ranked = ranked.filter(F.col("rank") <= longest).join(members, "id")
    ranked = written(ranked, "prefixes")
    shorter = F.col("n") - _at_least(2 * per_mille, 1000 + per_mille, F.col("n")) + 1
    smaller, larger = ranked.filter(F.col("rank") <= shorter).alias("s"), ranked.alias("l")

    common = _at_least(per_mille, 1000 + per_mille, F.col("s.n") + F.col("l.n"))
    left = 1 + F.least(F.col("s.n") - F.col("s.rank"), F.col("l.n") - F.col("l.rank"))
    possible = (
        (F.col("s.component") != F.col("l.component"))
        & (F.struct("s.n", "s.id") < F.struct("l.n", "l.id"))
        & (left >= common)
        & (F.least("s.shared", "l.shared") >= common)
    )
    pairs = smaller.join(larger, (F.col("s.element") == F.col("l.element")) & possible)
    return pairs.select(
        F.least("s.id", "l.id").alias("a"), F.greatest("s.id", "l.id").alias("b")
    ).distinct()
