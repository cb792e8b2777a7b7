"""Connected components of links between many vertices."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import stored

MOST_ROUNDS = 200


def components(links: DataFrame) -> DataFrame:
    """vertex, label for every end of ``links(a, b)``; equal labels mean connected.

    Each round every vertex moves to the first of itself and its neighbours, in an order
    drawn anew, and links move with their ends. So a vertex stays linked with what it was
    linked with, and a fixed share of the vertices vanishes in each round, for chains as
    for stars. Only tables of links and moves are written, none comes to the driver.
    """
    left = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    ends = left.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    labels = stored(ends.select("vertex", F.col("vertex").alias("label")), "labels")
    for turn in range(MOST_ROUNDS):
        if left.isEmpty():
            return labels
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("rank"), F.col(c).alias("to"))
        both = left.select("a", "b").union(left.select("b", "a"))
        moves = stored(both.groupBy("a").agg(F.min(rank("b")).alias("best")).select(
            F.col("a").alias("vertex"), F.least("best", rank("a"))["to"].alias("to")), "moves")
        first, second = moves.toDF("a", "new_a"), moves.toDF("b", "new_b")
        left = stored(left.join(first, "a").join(second, "b").where("new_a <> new_b").select(
            F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).distinct(), "links")
        labels = stored(labels.join(moves.toDF("label", "to"), "label", "left").select(
            "vertex", F.coalesce("to", "label").alias("label")), "labels")
    raise RuntimeError("the links did not come together")
