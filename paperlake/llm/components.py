"""Connected components of a graph given as links, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest one: those above it, or those below and itself."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    if large:
        low = F.least("u", "low")
        hung = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), low.alias("b"))
    else:
        hung = both.join(least, "u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        hung = hung.unionByName(least.select(F.col("u").alias("a"), F.col("low").alias("b")))
    return hung.where("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) of all nodes with a link; the component is its smallest node.

    `links` has two columns of nodes. Every round halves the depth at least of long chains; the links of a round are
    written to shared storage, which cuts the lineage. Sums over the links tell when nothing changes any more.
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    links, before = materialize(links, "links"), None
    for _ in range(most_rounds):
        links = materialize(_star(_star(links, large=True), large=False), "links")
        now = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.hash("a", "b").cast("long")).alias("s")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
