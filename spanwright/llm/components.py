"""Connected components of a table of links, by alternating stars.

Each round makes two passes, both equi-joins on a node: the large star links
the larger neighbours of every node to its smallest one, the small star links
the smaller ones and the node itself.  The number of links never grows, the
rounds grow with the logarithm of the nodes, and no component is ever gathered
in one task: minima are aggregated before the shuffle, and the joins leave a
hub's rows to be split by adaptive execution.  Each round's links are a table
whose rows are counted, so small rounds run in few tasks, and the table of the
round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwright.llm.common import Tables, cut, tasks_for


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(links: DataFrame, tables: Tables | None = None) -> DataFrame:
    """``links`` (a, b) -> (node, root): each linked node that isn't the smallest
    of its component, with that smallest node.

    Nulls, loops and repeated links are ignored; without links the result is
    empty.  The result is one of ``tables`` if they are given, else it is
    checkpointed.
    """
    if tables is None:
        with Tables(links.sparkSession) as own:
            return cut(connected_components(links, own))
    edges = tables.keep(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        n = tasks_for(2 * mark[0])
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(n)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .coalesce(n)
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, edges = edges, tables.keep(small.union(least.select("a", F.col("m").alias("b"))).coalesce(n).distinct().coalesce(n))
        tables.drop(before)
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    return tables.keep_as(edges, edges.select(F.col("a").alias("node"), F.col("b").alias("root")))
