"""Removes passages of three or more lines that stand elsewhere already.

Every three consecutive lines that hold a word are a window (windows overlap; blank
lines between are passed over). The first place of a window, by document id and line,
stays; at every later place the window's lines, with the blank ones between, are covered,
and the union of the covered lines goes. So the first copy of every line remains, in
whole or part of its passage.

Windows are compared by 128 bits of hash over whole lines. A null text stays null, texts
of fewer than three lines with a word stay as they are. Null ids come first. Rows with
equal ids and texts are one document (what one keeps, all keep); rows with equal ids and
other texts are documents of their own, ordered by a hash of the text.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.native import once
from barloom.llm.words import free_name
from barloom.session import stored

HAS_WORD = r"[^\x20\x09-\x0D]"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, first, last (line numbers from 0) and the window's hashes a, b."""
    numbered = F.transform(lines_of(F.col("text")), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    spoken = F.filter(numbered, lambda x: x["line"].rlike(HAS_WORD))

    def of(lines: Column) -> Column:
        def window(i: Column) -> Column:
            own = [lines[i + k] for k in range(3)]
            text = [x["line"] for x in own]
            return F.struct(own[0]["at"].alias("first"), own[2]["at"].alias("last"),
                            F.xxhash64(*text).alias("a"), F.xxhash64(F.lit(1), *text[::-1]).alias("b"))

        return F.when(F.size(lines) >= 3, F.transform(F.sequence(F.lit(0), F.size(lines) - 3), window))

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
        F.explode(once(spoken, of)).alias("w")).select("doc_id", "text_key", "w.*")


def later_places(found: DataFrame) -> DataFrame:
    """doc_id, text_key and the spans (first, last) of windows that stand earlier too."""
    place = F.struct("doc_id", "text_key", "first")
    repeated = (found.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(place).alias("kept"))
                .where(F.col("n") > 1))
    later = found.join(repeated, ["a", "b"]).where(~F.col("kept").eqNullSafe(place))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def drop_repeats(docs: DataFrame, removed: str = "n_removed") -> DataFrame:
    """``docs`` with repeated lines taken out of ``text`` and their number in a new column."""
    if removed.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {removed} already")
    spans = later_places(stored(windows(docs), "line-windows")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"),
        F.array_distinct(F.flatten(F.transform(
            "spans", lambda s: F.sequence(s["first"], s["last"])))).alias("covered"))
    covered = F.col("found.covered")
    text = F.when(covered.isNull(), F.col("docs.text").cast("string")).otherwise(once(
        lines_of(F.col("docs.text")), lambda lines: F.concat_ws("\n", F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered), lambda i: lines[i]))))
    joined = docs.alias("docs").join(
        spans.alias("found"),
        F.col("docs.doc_id").cast("long").eqNullSafe(F.col("found._id"))
        & (F.xxhash64("docs.text") == F.col("found._key")), "left")
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"docs.`{c}`") for c in docs.columns],
                         F.coalesce(F.size(covered), F.lit(0)).cast("long").alias(removed))


def clean_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines; ``n_chars``, if there, counts the new text."""
    name = free_name(docs, "n_removed")
    done = drop_repeats(docs, name)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(
            F.col(name) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
            .otherwise(F.col("n_chars")))
    return done.drop(name)
