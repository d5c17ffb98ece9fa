"""The logical tables as views over ``events``, and a larger set over ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

LINEITEM = T.StructType(
    [
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]
)

# How interruptions are told apart in the stand-in tables.
SUBSYSTEM = 3
KINDS = ("error", "signup")
SUPPLIER_SUBSYSTEM = 1
SUPPLIER_KINDS = ("R",)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def readings(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin("view", "click")).select(
        F.col("ts").alias("date"),
        F.col("event_type").alias("series"),
        "value",
        F.col("user_id").alias("aircraftid"),
    )


def utilization(events: DataFrame) -> DataFrame:
    delay = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0))
    return events.groupBy(
        F.col("user_id").alias("aircraftid"), F.to_date("ts").alias("timeid")
    ).agg(
        F.sum("value").alias("flighthours"),
        F.sum(delay).alias("delayedminutes"),
        F.count(F.lit(1)).alias("flightcycles"),
    )


def interruptions(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("event_id") % 16).alias("subsystem"),
        F.col("user_id").alias("aircraftregistration"),
        F.col("ts").alias("starttime"),
        F.col("event_type").alias("kind"),
    )


def requests(events: DataFrame) -> DataFrame:
    """Asset-days on which something was signed up for; some of them have no feature row."""
    return events.where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("aircraftid"), F.to_date("ts").alias("date")
    )


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LINEITEM).parquet(f"{folder}/lineitem.parquet")


def supplier_readings(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_shipdate").alias("date"),
        F.col("l_returnflag").alias("series"),
        F.col("l_quantity").alias("value"),
        F.col("l_suppkey").alias("aircraftid"),
    )


def supplier_utilization(lineitem: DataFrame) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(F.lit(0.0))
    return lineitem.groupBy(
        F.col("l_suppkey").alias("aircraftid"), F.to_date("l_shipdate").alias("timeid")
    ).agg(
        F.sum("l_extendedprice").alias("flighthours"),
        F.sum(returned).alias("delayedminutes"),
        F.count(F.lit(1)).alias("flightcycles"),
    )


def supplier_interruptions(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_linenumber").alias("subsystem"),
        F.col("l_suppkey").alias("aircraftregistration"),
        F.col("l_shipdate").alias("starttime"),
        F.col("l_returnflag").alias("kind"),
    )
