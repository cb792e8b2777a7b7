"""Chronological splits and expanding-window folds, per series."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import config
from barloom.operators.series import BLOCK_ROWS, POS, join_per_series, series_lengths

PARTS = ("train", "validation", "test")
MOST_FOLDS = 63  # bits of a long that are no sign


def check_ratios(ratios: tuple[float, float, float]) -> None:
    if min(ratios) <= 0:
        raise ValueError(f"every part must be positive, got {ratios}")
    if abs(sum(ratios) - 1.0) > 0.01:
        raise ValueError(f"split ratios must sum to 1, got {sum(ratios)}")


def train_end(n: Column, ratios: tuple[float, float, float]) -> Column:
    """Last training position of a series of n rows."""
    return F.floor(n * F.lit(ratios[0]))


def validation_end(n: Column, ratios: tuple[float, float, float]) -> Column:
    return F.floor(n * F.lit(ratios[0] + ratios[1]))


def add_split(
    df: DataFrame,
    ratios: tuple[float, float, float] = config.SPLIT_RATIOS,
    block_rows: int = BLOCK_ROWS,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``: the first 60 % of each series train, the next 20 %
    validation, the rest test. ``lengths`` saves counting a table whose series
    lengths are known (see ``series_lengths``)."""
    check_ratios(ratios)
    n = F.col("_n")
    split = (
        F.when(F.col(POS) <= train_end(n, ratios), PARTS[0])
        .when(F.col(POS) <= validation_end(n, ratios), PARTS[1])
        .otherwise(PARTS[2])
    )
    lengths = series_lengths(df) if lengths is None else lengths
    return join_per_series(df, lengths, block_rows).withColumn("split", split).drop("_n")


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per symbol and part, and the part's share of the symbol's rows."""
    counts = df.groupBy("Symbol").pivot("split", list(PARTS)).count().fillna(0, list(PARTS))
    total = sum((F.col(p) for p in PARTS), F.lit(0))
    cells = [F.struct(F.lit(p).alias("split"), F.col(p).alias("rows"),
                      (F.col(p) / total).alias("share")) for p in PARTS]
    return counts.select("Symbol", F.inline(F.array(*cells)))


def fold_bounds(n: Column, fold: int, n_folds: int = config.N_FOLDS) -> tuple[Column, Column]:
    """Last training and last test position of an expanding-window fold."""
    test_rows = F.floor(n / (n_folds + 1))
    last_train = n - test_rows * (n_folds - fold)
    return last_train, last_train + test_rows


def with_folds(
    df: DataFrame, n_folds: int = config.N_FOLDS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All rows with ``_train_folds`` and ``_test_folds``: bit i tells whether the row
    is in that part of fold i. One join, however many folds there are."""
    if not 1 <= n_folds <= MOST_FOLDS:
        raise ValueError(f"there can be 1 to {MOST_FOLDS} folds, got {n_folds}")
    train, test = F.lit(0).cast("long"), F.lit(0).cast("long")
    for i in range(n_folds):
        last_train, last_test = fold_bounds(F.col("_n"), i, n_folds)
        bit, pos = F.lit(1 << i).cast("long"), F.col(POS)
        train = train.bitwiseOR(F.when(pos <= last_train, bit).otherwise(0))
        test = test.bitwiseOR(F.when((pos > last_train) & (pos <= last_test), bit).otherwise(0))
    joined = join_per_series(df, series_lengths(df), block_rows)
    return joined.withColumns({"_train_folds": train, "_test_folds": test}).drop("_n")


def fold_part(df: DataFrame, fold: int, role: str) -> DataFrame:
    """The ``train`` or ``test`` rows of a fold, out of a table ``with_folds``."""
    return df.where(F.col(f"_{role}_folds").bitwiseAND(F.lit(1 << fold)) != 0).drop(
        "_train_folds", "_test_folds")


def add_fold(
    df: DataFrame, fold: int, n_folds: int = config.N_FOLDS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows of one fold with ``role`` train or test; later rows are left out."""
    marked = with_folds(df, n_folds, block_rows)
    bit = F.lit(1 << fold)
    role = F.when(F.col("_train_folds").bitwiseAND(bit) != 0, "train").when(
        F.col("_test_folds").bitwiseAND(bit) != 0, "test")
    return marked.withColumn("role", role).where(F.col("role").isNotNull()).drop(
        "_train_folds", "_test_folds")


def fold_counts(df: DataFrame, n_folds: int = config.N_FOLDS) -> DataFrame:
    """Rows per symbol, fold and role, with the first and last position of each."""
    lengths = df.groupBy("Symbol").agg(F.max(POS).alias("n"))
    cells = []
    for i in range(n_folds):
        last_train, last_test = fold_bounds(F.col("n"), i, n_folds)
        first, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
        for role, low, high in (("train", zero, last_train), ("test", last_train, last_test)):
            cells.append(F.struct(
                F.lit(i).alias("fold"), F.lit(role).alias("role"),
                (high - low).alias("rows"), (low + first).alias("first_row"), high.alias("last_row"),
            ))
    return lengths.select("Symbol", F.inline(F.array(*cells)))


def features_and_target(df: DataFrame, target: str = "Close") -> tuple[list[str], str]:
    """Feature columns and the target column of a table."""
    if target not in df.columns:
        raise ValueError(f"no target column {target}")
    skip = {target, "split", "role"}
    return [c for c in df.columns if c not in skip and not c.startswith("_")], target
