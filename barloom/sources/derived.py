"""Bar tables derived from event streams and order lines.

``bars_from_events`` turns timestamped values into one bar per type and hour,
``bars_from_order_lines`` order lines into one bar per supplier and ship day.
Both number their bars with a window per symbol: a symbol has at most one bar
per hour or day of the calendar, however many source rows there are, and those
are reduced by an aggregation with map-side partials first.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.schema import BARS

BAR_COLUMNS = [f.name for f in BARS]


def _hour(ts: Column) -> Column:
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def _finish(bars: DataFrame) -> DataFrame:
    serial = F.row_number().over(Window.partitionBy("Symbol").orderBy("Date"))
    return bars.withColumns({
        "SNo": serial.cast("long"),
        "Name": F.col("Symbol"),
        "Marketcap": F.col("Close") * 1e6,
    }).select(*BAR_COLUMNS)


def bars_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    at = F.struct("ts", "event_id")
    return _finish(
        events.groupBy(F.col("event_type").alias("Symbol"), _hour(F.col("ts")).alias("Date")).agg(
            F.max("value").alias("High"),
            F.min("value").alias("Low"),
            F.min_by("value", at).alias("Open"),
            F.max_by("value", at).alias("Close"),
            F.sum("user_id").cast("double").alias("Volume"),
        )
    )


def bars_from_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("Symbol"),
        F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("Date"),
        # Four digits by plain arithmetic, which every engine does alike.
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 10000.0 + 0.5) / 10000.0)
        .alias("price"),
        F.col("l_quantity").alias("quantity"),
        "l_orderkey", "l_linenumber",
    )
    at = F.struct("l_orderkey", "l_linenumber", "price")
    return _finish(
        lines.groupBy("Symbol", "Date").agg(
            F.max("price").alias("High"),
            F.min("price").alias("Low"),
            F.min_by("price", at).alias("Open"),
            F.max_by("price", at).alias("Close"),
            F.sum("quantity").alias("Volume"),
        )
    )


def damaged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly bars as they might arrive: text dates, gaps, wrong signs,
    swapped prices, outliers, repeated and exchanged rows."""
    i = F.col("SNo")

    def every(n: int) -> Column:
        return i % n == 0

    spike = F.when(every(71), 1e6).otherwise(1.0)
    swapped = every(83)
    late = F.when(i > 300, F.expr("INTERVAL 40 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    text = F.date_format(F.col("Date") + late, "yyyy-MM-dd HH:mm:ss")
    return (
        bars_from_events(spark, sf_dir)
        .withColumn("copies", F.explode(F.when(every(89), F.array(F.lit(1), F.lit(2)))
                                        .otherwise(F.array(F.lit(1)))))
        .select(
            F.when(every(67), i + 1).when((i % 67 == 1) & (i > 1), i - 1).otherwise(i).alias("SNo"),
            "Name", "Symbol",
            F.when(every(103), F.lit("bad")).otherwise(text).alias("Date"),
            (F.when(swapped, F.col("Low")).otherwise(F.col("High")) * spike).alias("High"),
            (F.when(swapped, F.col("High")).otherwise(F.col("Low")) * spike).alias("Low"),
            F.when(~every(79), F.col("Open") * spike).alias("Open"),
            (F.when(every(97), -F.col("Close")).otherwise(F.col("Close")) * spike).alias("Close"),
            F.when(~every(101), F.col("Volume")).alias("Volume"),
            "Marketcap",
        )
    )
