"""Market-style inputs derived from the order tables.

A symbol is a supplier nation, its exchange the region; every order line is a trade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tenth(price: Column) -> Column:
    return (price * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(18,3)")


def daily_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """Daily prices per nation key; a day's trades follow each other by order, line, part, supplier and price.

    One aggregation, and one shuffle of what it leaves of every task. The order has no fixed width, so a
    task sorts its own lines by nation and day; the other way, aggregating order numbers by hash and joining
    the lines of the first and last order, exchanges all lines. A nation with a third of all lines costs no
    more than another either way.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("Date"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    nations = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    days = lines.join(nations, "l_suppkey").groupBy("s_nationkey", "Date").agg(
        F.sum("quantity").alias("Volume"), F.max("price").alias("High"), F.min("price").alias("Low"),
        F.max_by("price", order).alias("Close"), F.min_by("price", order).alias("Open"))
    return days.select(
        "s_nationkey", "Volume", *(_tenth(F.col(name)).alias(name) for name in ("High", "Low", "Close", "Open")), "Date")


def symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Symbol attributes per nation key."""
    region = table(spark, folder, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("ExchangeName"))
    return table(spark, folder, "nation").join(region, "n_regionkey").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("Symbol"), "ExchangeName",
        F.lit("USD").alias("Currency"), F.lit("Common Stock").alias("Type"),
        F.lit("America/New_York").alias("ExchangeTimeZone"))


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars; names join after the aggregation, when few rows are left."""
    return daily_by_nation(spark, folder).join(symbols(spark, folder), "s_nationkey").select(
        "Symbol", "ExchangeName", "Currency", "Type", "ExchangeTimeZone",
        "Volume", "High", "Low", "Close", "Open", "Date")


def lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Symbol reference; one region is left out, so its symbols are unknown."""
    region = table(spark, folder, "region").filter(F.col("r_name") != "MIDDLE EAST")
    return table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("Sort"), F.col("r_name").alias("Industry"),
        F.col("n_name").alias("Symbol"),
        F.concat(F.lit("https://example.org/"), F.col("n_name"), F.lit(".svg")).alias("Logo"))


def industry_star(spark: SparkSession, folder: str) -> DataFrame:
    """Bars with the attributes of known symbols; the others stay under blank members."""
    return bars(spark, folder).join(lookup(spark, folder), "Symbol", "left")


def _text_map(**entries: Column) -> Column:
    pairs = [part for key, value in entries.items() for part in (F.lit(key), value.cast("string"))]
    return F.create_map(*pairs)


def responses(spark: SparkSession, folder: str) -> DataFrame:
    return responses_of(bars(spark, folder))


def responses_of(daily_bars: DataFrame) -> DataFrame:
    """One vendor response per symbol and month, so a document holds at most 31 days.

    The usual faults are part of it: Asian Decembers failed, European Marches came without
    metadata, African Junes are empty, American Januaries arrived twice.
    """
    value = _text_map(datetime=F.col("Date"), open=F.col("Open"), high=F.col("High"),
                      low=F.col("Low"), close=F.col("Close"), volume=F.col("Volume"))
    months = (daily_bars
              .withColumn("Month", F.trunc("Date", "month"))
              .groupBy("Symbol", "ExchangeName", "Currency", "Type", "ExchangeTimeZone", "Month")
              .agg(F.collect_list(value).alias("values")))
    month, exchange = F.month("Month"), F.col("ExchangeName")
    meta = _text_map(symbol=F.col("Symbol"), interval=F.lit("1day"), currency=F.col("Currency"),
                     exchange_timezone=F.col("ExchangeTimeZone"), exchange=exchange, type=F.col("Type"))
    mic = _text_map(mic_code=F.concat(F.lit("X"), F.substring(exchange, 1, 3)))
    full_meta = F.when(exchange == "ASIA", meta).otherwise(F.map_concat(meta, mic))
    copies = F.when((exchange == "AMERICA") & (month == 1), 2).otherwise(1)
    no_values = F.array().cast("array<map<string,string>>")
    return months.select(
        F.when((exchange == "EUROPE") & (month == 3), F.lit(None)).otherwise(full_meta).alias("meta"),
        F.when((exchange == "AFRICA") & (month == 6), no_values).otherwise(F.col("values")).alias("values"),
        F.when((exchange == "ASIA") & (month == 12), F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        copies.alias("_copies"),
    ).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy", "_copies")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,3)").alias("c_acctbal"))


def first_customers(spark: SparkSession, folder: str) -> DataFrame:
    """First customer load: indebted machinery customers are not known yet."""
    return _customers(spark, folder).filter(
        ~((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)))


def second_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Second load: some left, some changed segment (type 2), balance (type 1), or both."""
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    moved = balance.between(1000, 2000)
    earned = segment == "BUILDING"
    return (_customers(spark, folder)
            .filter(~((segment == "HOUSEHOLD") & (balance > 9000)))
            .select("c_custkey",
                    F.when(moved, F.lit("X")).otherwise(segment).alias("c_mktsegment"),
                    F.when(earned, balance + 1).otherwise(balance).cast("decimal(18,3)").alias("c_acctbal")))


def corrected_bars(daily_bars: DataFrame) -> DataFrame:
    """A later delivery: closes of rising days moved up by one, European symbols missing."""
    close = F.when(F.col("Close") > F.col("Open"), F.col("Close") + 1).otherwise(F.col("Close"))
    return (daily_bars.filter(F.col("ExchangeName") != "EUROPE")
            .withColumn("Close", close.cast("decimal(18,3)")))
