"""From raw documents to packed sequences: the stages and the whole run.

Each stage takes (spark, docs, sf_dir) and returns what the next one gets; all but the
last return the columns of ``documents``. Nulls, empty texts, repeated rows, empty tables
and further columns are treated as each operator's docstring says; rows with equal ids and
texts count as one document where documents are compared.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import disclosure, line_windows, near_copies, packing, quality_model
from barloom.llm.labelled import remainder
from barloom.llm.queries import WORD_TOKENIZER, packed_columns, table, tokenizer_file
from barloom.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; the others stay as they are."""
    usable = remainder(F.col("doc_id"), 3) != 1
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), usable)
    return quality_model.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of three lines or more that stand in an earlier place go from the texts."""
    return line_windows.clean_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (80 % of the shingles or more) the document with the smallest id stays."""
    return near_copies.keep_first(docs, percent=80)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and words that reveal it, are replaced in the texts."""
    return disclosure.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of power-of-two length that the texts' ids are cut into, with the ids themselves.

    ``ids`` holds unsigned little-endian 32-bit numbers; ``packing.write_buckets`` writes the rows by length.
    """
    return packed_columns(packing.pack(docs, tokenizer_file(WORD_TOKENIZER), end_id=1), "ids")


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near), ("personal", personal),
          ("packing", pack)]

# The stages' models, hashes and tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
