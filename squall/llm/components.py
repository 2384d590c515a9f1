"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.storage import materialise


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `links (a, b)`: the smallest node of its component.

    Stars grow in turns: every node's larger neighbours, then its smaller ones, are linked to the
    smallest node it knows, until nothing changes. The number of turns grows with the logarithm of a
    component's size. Smallest neighbours are found by an aggregate, never by gathering neighbours, and
    hot nodes meet their links in joins that Spark can split. Every turn is written to the shared folder.
    """
    star = links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).filter("u <> v").distinct()
    star, before = materialise(star, "links"), None
    while True:
        # Larger neighbours of u, linked to the smallest of u and its neighbours.
        both = star.select("u", "v").union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        grown = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        grown = materialise(grown.filter("u <> v").distinct(), "links")
        # Smaller neighbours of u, and u, linked to the smallest of them.
        least = grown.groupBy("u").agg(F.min("v").alias("m"))
        shrunk = grown.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = materialise(
            shrunk.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "links"
        )
        now = star.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        if now == before or now[0] == 0:
            break
        before = now
    roots = star.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    tops = roots.select(F.col("root").alias("node"), "root").distinct()
    return roots.union(tops)
