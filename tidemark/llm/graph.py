"""Connected components of an undirected graph, without any node's neighbours in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import in_few_tasks, settle


def components(edges: DataFrame) -> DataFrame:
    """Frame (node, root) for the nodes of `edges` (u, v: long): root is the component's smallest node.

    Alternates two steps until every node is smaller than its neighbours or has one neighbour, a smaller
    one, which takes a logarithmic number of rounds: tie every larger neighbour to the smallest neighbour,
    then every smaller one. Each is a grouped minimum, combined before its shuffle, and a join that Spark
    can split at a hot node; every step is a written table, made by few tasks if the edges are few.
    """
    low, high = F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")
    edges = settle(edges.filter(F.col("u") != F.col("v")).select(high, low))
    least = F.min("v")
    untied = (least < F.col("u")) & (least < F.max("v"))
    while True:
        ends = 2 * edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.least(least, F.col("u")).alias("m"), untied.alias("untied"))
        nearest = settle(in_few_tasks(nearest, ends))
        if not nearest.filter("untied").head(1):
            return nearest.select(F.col("u").alias("node"), F.col("m").alias("root"))
        larger = both.join(nearest.drop("untied"), "u").filter(F.col("v") > F.col("u"))
        large = settle(in_few_tasks(larger.select(F.col("v").alias("u"), F.col("m").alias("v")), 2 * ends))
        nearest = settle(in_few_tasks(large.groupBy("u").agg(F.min("v").alias("m")), ends))
        smaller = large.join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        roots = nearest.select("u", F.col("m").alias("v"))
        edges = settle(in_few_tasks(smaller.unionByName(roots).filter("u != v").distinct(), ends))
