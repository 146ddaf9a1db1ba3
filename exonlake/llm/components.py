"""Connected classes from links, by contraction: every round each class takes the smallest class it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import written


def merge_labels(labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """labels (doc_id, label) after joining the classes that links (a, b) connect; a class keeps its smallest label.

    Lineage is cut by a written table each round, so that a lost executor does not replay the rounds.
    """
    a = labels.select(F.col("doc_id").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("doc_id").alias("b"), F.col("label").alias("lb"))
    edges = written(links.join(a, "a").join(b, "b").where("la <> lb").select(F.col("la").alias("u"), F.col("lb").alias("v")).distinct(), f"{name}-edges")
    maps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("p"))
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        parent = written(parent.join(up, "p", "left").select("u", F.coalesce("pp", "p").alias("p")), f"{name}-parents")
        maps.append(parent)
        pu, pv = parent.select("u", F.col("p").alias("pu")), parent.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = written(edges.join(pu, "u").join(pv, "v").where("pu <> pv").select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), f"{name}-edges")
    for parent in maps:
        labels = labels.join(parent.withColumnRenamed("u", "label"), "label", "left").select("doc_id", F.coalesce("p", "label").alias("label"))
    return written(labels, f"{name}-labels")
