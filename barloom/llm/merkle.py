"""Merkle trees over the paragraphs and sections of texts.

A paragraph is a line; its digest is the SHA-256 of its text. A section ends behind an
empty paragraph or one whose digest begins with 0 to 3 (a quarter of them), so that an
edit moves no section's bounds but its own; its digest is the SHA-256 of its paragraphs'
digests. The root is the SHA-256 of the sections' digests. Equal roots mean equal texts;
where roots differ, only sections without a counterpart are looked into, and there the
paragraphs without one are the edits.

Below a paragraph, its sentences in pieces of at most 120 characters have 64-bit marks.
The likeness of two trees is the Dice coefficient of their sets of marks (1 if the roots
are equal), so texts of one paragraph can be compared as well.

A null text is an empty one: one empty paragraph. Only DataFrame functions are used.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.native import once

EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
# Behind a digest that begins with 0 to 3, and behind that of an empty paragraph.
SECTION_END = f"(?<=[0-3][0-9a-f]{{63}}|{EMPTY}) "
PIECE = r"[^.!?\n]{1,120}[.!?\n]*|[.!?\n]+"
# Documents whose next document must be at hand are handled together, so many at a time.
BLOCK = 4096


def tree(text: Column) -> Column:
    """struct<root, sections: array<string>, marks: array<string>> of a text.

    A section is its paragraphs' digests, joined by spaces.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    digests = F.concat_ws(" ", F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256)))
    marks = F.array_distinct(F.transform(
        F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.substring(F.md5(p), 1, 16)))
    return once(F.struct(F.split(digests, SECTION_END, -1).alias("sections"), marks.alias("marks")),
                lambda t: F.struct(root_of(t["sections"]).alias("root"), t["sections"], t["marks"]))


def root_of(sections: Column) -> Column:
    return F.sha2(F.concat_ws(" ", F.transform(sections, lambda s: F.sha2(s, 256))), 256)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two trees: the share of marks that both have."""
    common = F.size(F.array_intersect(a["marks"], b["marks"]))
    both = F.size(a["marks"]) + F.size(b["marks"])
    return F.when(a["root"] == b["root"], F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(
        2.0 * common / both)


def paragraphs(t: Column) -> Column:
    """The digests of all paragraphs of a tree, in order."""
    return F.split(F.concat_ws(" ", t["sections"]), " ")


def changed(a: Column, b: Column) -> Column:
    """The paragraph digests of tree ``a`` that tree ``b`` doesn't have.

    Equal roots are passed over at once, sections that both have are passed over whole.
    """
    def of(x: Column, y: Column) -> Column:
        return F.flatten(F.transform(F.array_except(x["sections"], y["sections"]), lambda s: F.split(s, " ")))

    return F.when(a["root"] == b["root"], F.array().cast("array<string>")).otherwise(
        F.array_except(F.array_except(of(a, b), of(b, a)), F.flatten(F.transform(
            F.array_intersect(a["sections"], b["sections"]), lambda s: F.split(s, " ")))))


def locate_edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Where documents of ``new`` differ from ``old``: doc_id and paragraph (from 0).

    Both have ``doc_id`` and ``tree``. Documents without a counterpart are left out; null ids are
    counterparts of null ids. Of rows with an equal id every version of ``new`` is compared with
    every one of ``old``, and a place is given if it differs from any.
    """
    both = new.select("doc_id", F.col("tree").alias("new")).join(
        old.select(F.col("doc_id").alias("_id"), F.col("tree").alias("old")),
        F.col("doc_id").eqNullSafe(F.col("_id"))).where("new.root <> old.root")
    lost = both.select(F.col("doc_id").alias("_id"), F.col("new.root").alias("_root"),
                       F.explode(changed(F.col("new"), F.col("old"))).alias("_digest"))
    every = both.select("doc_id", F.col("new.root").alias("root"),
                        F.posexplode(paragraphs(F.col("new"))).alias("paragraph", "digest"))
    same = (F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("root") == F.col("_root"))
            & (F.col("digest") == F.col("_digest")))
    return every.join(lost, same, "left_semi").select("doc_id", "paragraph").distinct()


def _blocks(docs: DataFrame, size: int) -> list[int]:
    """The smallest key of every block: one number for ``size`` documents on the driver."""
    blocks = max(1, -(-docs.count() // size))
    dealt = docs.select("key").repartitionByRange(blocks, "key")
    firsts = dealt.groupBy(F.spark_partition_id()).agg(F.min("key")).collect()
    return sorted(r[1] for r in firsts)


def with_next(docs: DataFrame, add: dict[str, Column], size: int = BLOCK) -> DataFrame:
    """``docs(doc_id, text)`` with the columns ``add``, and all but the id of the next one in ``next``.

    Next in ascending id (null first), after the last the first. Documents are dealt out by
    blocks of neighbouring ids; the first of each block goes to the block before it as well,
    so that no block needs to see another. Rows with equal ids are ordered by their texts.
    """
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"))
    firsts = _blocks(keyed, size)
    known = F.split(F.lit(",".join(map(str, firsts))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(firsts).bit_length()))])
    # Binary search: how many firsts are not above the key.
    found = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        F.get(known, n + step - 1) <= F.col("key"), n + step).otherwise(n))
    block = F.greatest(found - 1, F.lit(0))
    before = F.when(F.col("block") == 0, F.lit(max(0, len(firsts) - 1))).otherwise(F.col("block") - 1)
    own = F.struct(F.col("block").alias("block"), F.lit(False).alias("ghost"))
    ghost = F.struct(before.alias("block"), F.lit(True).alias("ghost"))
    is_first = F.get(known, F.col("block")) == F.col("key")
    dealt = (keyed.withColumn("block", block)
             .select("doc_id", "text", "key", F.explode(
                 F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))).alias("at"))
             .select("doc_id", "text", "key", "at.*").repartition("block").withColumns(add))
    order = Window.partitionBy("block").orderBy("ghost", "key", "text")
    return (dealt.withColumn("next", F.lead(F.struct("text", *add)).over(order))
            .where(~F.col("ghost")).drop("key", "block", "ghost"))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the tree of every document."""
    return docs.select("doc_id", tree(F.col(text)).alias("tree"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Trees of every document, of its next one, and of its text with the next one's start for its second half.

    doc_id, n_chars, tree, next (text, tree), edited, edited_tree.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    beside = with_next(plain, {"tree": tree(F.col("text"))})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    return (beside.select("doc_id", n.cast("long").alias("n_chars"), "tree", "next", edited.alias("edited"))
            .withColumn("edited_tree", tree(F.col("edited"))))
