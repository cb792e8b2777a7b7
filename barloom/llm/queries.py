"""The registered queries of this subpackage, over whole tables."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    disclosure, line_windows, merkle, multi_index, near_copies, packing, periodic, pieces, quality_model, rules,
    spelling, token_files, toxicity,
)
from barloom.llm.labelled import remainder
from barloom.session import scratch_root

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def packed_columns(cut: DataFrame, *further: str) -> DataFrame:
    """What is reported of packed pieces: a checksum stands for the ids, unless they are asked for."""
    return cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                      "doc_tokens", "sequence_id", "offset", *further)


@query
def op1_disclosure(spark, sf):
    """Personal data of every document and the words that reveal it."""
    def n(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return disclosure.find_spans(table(spark, sf, "documents")).select(
        "doc_id", *[n(k) for k in disclosure.KINDS],
        F.sha2(disclosure.listed(F.col("base")), 256).alias("base_sha256"),
        disclosure.listed(F.concat("base", "added")).alias("spans"),
        (F.size("base") + F.size("added")).cast("long").alias("n_spans"), F.size("added").cast("long").alias("n_added"))


@query
def op2_merkle(spark, sf):
    """Fingerprints of every document and its edited text, and how near they are."""
    own, edited, following = (F.col(c) for c in ("tree", "edited_tree", "next.tree"))
    return merkle.edited_fingerprints(table(spark, sf, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        own["root"].alias("fingerprint"), edited["root"].alias("edited_fingerprint"),
        merkle.likeness(own, edited).alias("near_edited"),
        merkle.likeness(own, following).alias("near_next"),
        F.size(merkle.changed(edited, own)).cast("long").alias("n_changed_paragraphs"))


@query
def op3_toxicity(spark, sf):
    """Toxicity of every document and how many of its sentences offend."""
    docs, held_out = table(spark, sf, "documents"), remainder(F.col("doc_id"), 4) == 2
    model = toxicity.train(docs, table(spark, sf, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"))


@query
def op4_token_files(spark, sf):
    """Documents read back from Arrow files of equal-length sequences."""
    folder = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    written = token_files.write_token_files(
        table(spark, sf, "documents"), folder, tokenizer_file(WORD_TOKENIZER), end_id=2)
    return token_files.read_documents(written)


@query
def op5_rule_ledger(spark, sf):
    """Every document's measurements, failure bits and verdict under the current policy."""
    failures = F.col("failures")
    return rules.ledger(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.kept(failures, "base")).alias("base_failed"),
        rules.kept(failures, rules.CURRENT).alias("kept"), "n_lines", "n_upper", "failures")


@query
def op6_near_copies(spark, sf):
    """Every document's group of near copies and whether it is the one that stays."""
    return near_copies.near_copies(table(spark, sf, "documents"), percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query
def op7_quality(spark, sf):
    """Quality of every document."""
    docs, held_out = table(spark, sf, "documents"), remainder(F.col("doc_id"), 3) == 1
    model = quality_model.train(docs, table(spark, sf, "labels"), ~held_out)
    return quality_model.add_score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= quality_model.KEEP_FROM).cast("int").alias("predicted"))


@query
def op8_line_windows(spark, sf):
    """Every document without the lines of passages that stand elsewhere already."""
    done = line_windows.drop_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return done.select("doc_id", "text", "n_removed")


@query
def op9_pieces(spark, sf):
    """Ids of every document and whether they give its text back."""
    return pieces.round_trip(table(spark, sf, "documents"), tokenizer_file(PIECE_MODEL))


@query
def op10_packing(spark, sf):
    """Pieces of power-of-two length, each a sequence of its own."""
    return packed_columns(packing.pack(
        table(spark, sf, "documents"), tokenizer_file(WORD_TOKENIZER), end_id=1))


@query
def op11_spelling(spark, sf):
    """Every word of the vocabulary, what it is a variant of, and where the variants lead."""
    return spelling.variants(table(spark, sf, "documents"), one_in=97)


@query
def op12_multi_index(spark, sf):
    """The ten nearest vectors of every hundredth id."""
    return multi_index.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op13_periodic(spark, sf):
    """The stretches of every document, some made periodic, that repeat with a fixed period."""
    return periodic.find_runs(table(spark, sf, "documents"), made_periodic=True)
