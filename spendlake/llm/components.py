"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from spendlake.session import stored

# Rows of a small edge table that one task takes.
_TASK_ROWS = 100_000


def near_labels(edges: DataFrame, rounds: int = 2) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): the least node within so many steps.

    Equal roots mean one component; one component may have several roots.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("root")).withColumnRenamed("a", "node")
    labels = stored(labels, "labels")
    for _ in range(rounds - 1):
        seen = both.join(labels, F.col("b") == F.col("node")).select("a", "root")
        own = labels.withColumnRenamed("node", "a")
        best = seen.unionByName(own).groupBy("a").agg(F.min("root").alias("root"))
        labels = stored(best.withColumnRenamed("a", "node"), "labels")
    return labels


def component_roots(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, root) of the nodes of ``labels`` and ``edges``; the root is the smallest node of the component.

    ``labels`` are ``near_labels`` of some of the edges. All edges are first drawn between labels,
    where most fall together.
    """
    ends = edges.select("a", "b")
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(f"{end}_node"), F.col("root").alias(f"{end}_root"))
        ends = ends.join(of, F.col(end) == F.col(f"{end}_node"), "left").withColumn(end, F.coalesce(f"{end}_root", end))
    roots = components(ends.select("a", "b"))
    of = roots.select(F.col("node").alias("label"), F.col("root").alias("label_root"))
    known = labels.join(of, F.col("root") == F.col("label"), "left")
    named = known.select("node", F.coalesce("label_root", "root").alias("root"))
    return named.unionByName(roots.join(labels, "node", "left_anti"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), by repeated large and small stars.

    Each round is written to the shared folder, so a lost executor costs one round at most. The
    smallest neighbours are a table of their own: with both sides of that join shuffled for it,
    AQE splits the node that a large part of all edges meet in.
    """
    now, seen = _stored(_ordered(edges.select("a", "b")))
    while True:
        tasks = 1 + seen["n"] // _TASK_ROWS
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stored(_hang(both, F.col("b") > F.col("a"), tasks).coalesce(tasks), "edges")
        now, after = _stored(_hang(large, F.lit(True), tasks, keep_own=True).coalesce(tasks))
        if after == seen:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = after


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _hang(pairs: DataFrame, which: Column, tasks: int, keep_own: bool = False) -> DataFrame:
    """Hangs neighbours ``b`` of each ``a`` below the least of them (or of ``a``, where ``a`` is less)."""
    least = stored(pairs.groupBy("a").agg(F.min("b").alias("least")).coalesce(tasks), "least")
    hung = pairs.filter(which).join(least, "a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    if keep_own:
        hung = hung.unionByName(least.select("a", F.col("least").alias("b")))
    return _ordered(hung)


def _stored(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, stored, with their number and a sum of their hashes, taken while they were written."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("total")
    kept = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), total), "edges")
    return kept, seen.get
