"""Small tables for the operators of text preparation."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    """documents from (doc_id, text); ``n_chars`` as in the real tables."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, lines: int = 6, words: int = 12) -> str:
    r = random.Random(seed)
    made = [" ".join("".join(r.choice(["ka", "lo", "mi", "tu", "é", "Sh"]) for _ in range(r.randint(1, 4)))
                     for _ in range(words)) + "." for _ in range(lines)]
    return "\n".join(made)


def odd_rows():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a very long text."""
    base = prose(1)
    return [(3, None), (None, base), (None, None), (5, ""), (6, " \t\n \r\n"), (7, base), (7, base),
            (8, base + "\n" + prose(2)), (8, prose(3)), (9, "a" * 70_000), (10, "x y\n" * 3_000),
            (-4, "@" * 500 + "1" * 5_000 + "+" * 300), (12, prose(4, 40) + "\n\n" + prose(4, 40))]


def clashing(docs):
    """``docs`` with further columns named like ones the operators use inside."""
    for name in ("words", "lines", "block", "class", "label", "spans", "n", "key", "found", "docs", "score",
                 "_id", "_key", "text_key", "bucket"):
        docs = docs.withColumn(name, F.lit(name))
    return docs
