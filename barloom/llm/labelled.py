"""Bounded samples of labelled documents, the same for any layout of the tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % by, F.lit(-1)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column,
                    most: int) -> DataFrame:
    """At most ``most`` documents with a label: doc_id, text, label.

    Those with the smallest hashes of their ids are taken, so the sample does not depend
    on order or place. Repeated labels of a document count as their majority (a tie is 1);
    null ids and null labels are left out. ``usable`` is a condition on ``doc_id``.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable)
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")  # bounded by ``most``
