"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.llm.tables import gathered, written


def _distinct_links(links):
    """Each link once, the smaller end first, without links of a vertex to itself."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def components(links, about=None):
    """(id, root) for every id in ``links`` (a, b); the root is the smallest id of the component.

    Each pass maps a vertex to the smallest of itself and its neighbours, follows that once more,
    and contracts the links to the vertices that are left; every vertex with a smaller neighbour
    goes, so links run out in a logarithmic number of passes. Everything between passes is a
    written table, in as many tasks as its rows ask for; no pass collects anything but the number of
    links left. ``about`` is the number of links, if something is known of it.
    """
    left = _distinct_links(links)
    left = written(left if about is None else gathered(left, about), "links")
    n = left.count()
    ids = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    labels, most = ids.withColumn("root", F.col("id")), 2 * n
    while n:
        ends = left.union(left.select("b", "a"))
        nearest = ends.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("to"))
        nearest = nearest.select("v", F.least("v", "to").alias("to"))
        further = nearest.select(F.col("v").alias("to"), F.col("to").alias("next"))
        parents = nearest.join(further, "to").select("v", F.col("next").alias("to"))
        parents = written(gathered(parents, 2 * n), "parents")
        moved = labels.join(parents, F.col("root") == F.col("v"), "left")
        labels = written(gathered(moved.select("id", F.coalesce("to", "root").alias("root")), most), "labels")
        for end in ("a", "b"):
            left = left.join(parents, F.col(end) == F.col("v")).drop(end, "v").withColumnRenamed("to", end)
        left = written(gathered(_distinct_links(left), n), "links")
        n = left.count()
    return labels
