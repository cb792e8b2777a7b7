"""Quality rules as a ledger: one row per document with measurements and failure bits.

Every rule is evaluated once and leaves a bit; a policy is a version's set of bits, so
verdicts, changes of policy and ablations are bitwise work on the stored ledger and
never touch the texts again.

A word is a run of characters other than space and \\t \\n \\v \\f \\r. A null text is
measured as an empty one: all counts 0, it fails ``few_words``. Rows with equal ids have
a row each; null ids stay.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.native import once

WHITE = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8

# Rule name -> failure condition on the measurements. The place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("many_symbols", "5 * n_symbols > n_words"),
    ("duplicate_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
    ("odd_word_length", "n_words >= 20 and (word_chars < 2 * n_words or word_chars > 40 * n_words)"),
    ("shouting", "n_words >= 20 and 3 * n_upper > word_chars"),
]
BASE = ("few_words", "repeated_words")
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "many_symbols"),
    "v2": (*BASE, "many_symbols", "duplicate_lines", "odd_word_length", "shouting"),
}
CURRENT = "v2"


def mask_of(rules: tuple[str, ...]) -> int:
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(bits[r] for r in rules)


def _repeated(hashed: Column, distinct: Column) -> Column:
    """Words covered by windows that occur twice or more, from the windows' hashes.

    Equal hashes are brought together by sorting; a window covers its words up to the next
    such window's start. Sorting and counting is skipped where all hashes differ.
    """
    placed = F.array_sort(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def of(s: Column) -> Column:
        def alone(x: Column, k: Column) -> Column:
            same = lambda j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.when(same(k - 1) | same(k + 1), x["i"])

        starts = F.array_sort(F.array_compact(F.transform(s, alone)))
        return once(starts, lambda at: F.aggregate(
            F.transform(at, lambda x, k: F.least(
                F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0), lambda n, x: n + x))

    return F.when(F.size(distinct) < F.size(hashed), once(placed, of)).otherwise(F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at, all counts as long."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    cut = docs.select(
        "doc_id", text.alias("text"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD)).alias("lines"))
    hashed = F.transform("words", lambda w: F.xxhash64(w))
    windows = cut.withColumn("windows", F.when(
        F.size("words") < WINDOW, F.array().cast("array<bigint>")).otherwise(once(
            hashed, lambda h: F.transform(
                F.sequence(F.lit(0), F.size(h) - WINDOW),
                lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)])))))
    joined = windows.select(
        "*", F.concat_ws("", "words").alias("joined"), F.array_distinct("windows").alias("distinct"))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.char_length("joined"),
        "n_symbols": F.char_length("joined") - F.char_length(F.regexp_replace("joined", SYMBOLS, "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeated(F.col("windows"), F.col("distinct")),
        "n_upper": F.char_length("joined") - F.char_length(F.regexp_replace("joined", r"\p{Lu}", "")),
    }
    return joined.select("doc_id", *[c.cast("long").alias(n) for n, c in counts.items()])


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``failures``, with bit i set where rule i fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return measured(docs).withColumn("failures", failures.cast("long"))


def kept(failures: Column, policy: str) -> Column:
    return failures.bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents failing it, failing it alone, and kept without it.

    The ledger is summed up by failure pattern first, at most two to the power of the rules.
    """
    mask = mask_of(POLICIES[policy])
    patterns = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("failed")).agg(
        F.count("*").alias("n"))
    out = []
    for name in POLICIES[policy]:
        bit = mask_of((name,))
        failed, n = F.col("failed"), F.col("n")
        total = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
        out += [total(failed.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}_failed"),
                total(failed == bit).alias(f"{name}_alone"),
                total(failed.bitwiseAND(F.lit(mask & ~bit)) == 0).alias(f"{name}_kept")]
    one = patterns.agg(*out)
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), *[
        F.col(f"{r}_{k}").alias(k) for k in ("failed", "alone", "kept")]) for r in POLICIES[policy]])
    return one.select(F.explode(rows).alias("r")).select(
        F.lit(policy).alias("policy"), "r.rule", F.col("r.failed").alias("n_failed"),
        F.col("r.alone").alias("n_failed_alone"), F.col("r.kept").alias("n_kept_without"))
