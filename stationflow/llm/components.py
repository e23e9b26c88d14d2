"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_broadcasts, staged


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest reachable id) of every vertex of the links ``a``, ``b``.

    Every vertex points to its smallest neighbour if that is smaller, pointers are shortened until they reach a root,
    and the links between different roots make the next, smaller graph. Each step writes a small table; nothing that grows
    with the graph passes the driver.
    """
    with small_broadcasts(links.sparkSession):
        return _connected(links)


def _connected(links: DataFrame) -> DataFrame:
    edges = staged(links.filter("a <> b").select("a", "b").distinct(), "links")
    found = staged(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id")), "vertices")
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = staged(
            both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("root")),
            "roots",
        )
        while True:
            next_one = roots.select(F.col("id").alias("r"), F.col("root").alias("next"))
            roots = staged(
                roots.join(next_one, F.col("root") == F.col("r")).select(
                    "id", F.col("next").alias("root"), (F.col("root") != F.col("next")).alias("moved")
                ),
                "roots",
            )
            if not roots.filter("moved").limit(1).count():
                break
        root = roots.select(F.col("id").alias("r"), "root")
        found = staged(
            found.join(root, F.col("component") == F.col("r"), "left").select(
                "id", F.coalesce("root", "component").alias("component")
            ),
            "components",
        )
        a, b = root.toDF("ra", "root_a"), root.toDF("rb", "root_b")
        edges = staged(
            edges.join(a, F.col("a") == F.col("ra"))
            .join(b, F.col("b") == F.col("rb"))
            .filter("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .distinct(),
            "links",
        )
    return found
