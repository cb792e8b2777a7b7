"""Regression metrics and prediction tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.numeric import count_where, safe_div

METRICS = ("mae", "mse", "rmse", "r2", "mape")


def comparison(df: DataFrame, actual: str = "Close", predicted: str = "prediction") -> DataFrame:
    """Actual, predicted and errors per row, beside the columns already there."""
    y, p = F.col(actual), F.col(predicted)
    return df.withColumns({
        "actual": y, "predicted": p, "error": y - p, "abs_error": F.abs(y - p),
        "pct_error": F.abs(safe_div(y - p, y)) * 100,
    })


def metrics(
    df: DataFrame,
    by: Sequence[str] = ("split",),
    actual: str = "Close",
    predicted: str = "prediction",
) -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE per group, in one aggregation.

    Rows whose actual value is 0 have no percentage error; they are left out of
    MAPE and counted in ``zero_actuals``.
    """
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    known = df.where(y.isNotNull() & F.col(predicted).isNotNull())
    r2: Column = 1 - safe_div(F.sum(e * e), F.var_pop(y) * F.count(y))
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        r2.alias("r2"),
        (F.avg(F.abs(safe_div(e, y))) * 100).alias("mape"),
        count_where(y == 0).alias("zero_actuals"),
    )


def performance_summary(df: DataFrame, **kwargs) -> DataFrame:
    """The metrics reported per part: mae, rmse, r2, mape."""
    return metrics(df, by=("split",), **kwargs).select("split", "mae", "rmse", "r2", "mape")


def top_features(importances: DataFrame, k: int) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)
