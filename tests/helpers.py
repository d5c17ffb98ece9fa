"""Frames by hand, rows and plans, for the tests."""

from datetime import date, datetime

from pyspark.sql import types as T

READING = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("series", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("aircraftid", T.StringType()),
    ]
)
UTILIZATION = T.StructType(
    [
        T.StructField("timeid", T.DateType()),
        T.StructField("aircraftid", T.StringType()),
        T.StructField("flighthours", T.DoubleType()),
        T.StructField("delayedminutes", T.DoubleType()),
        T.StructField("flightcycles", T.LongType()),
    ]
)
INTERRUPTION = T.StructType(
    [
        T.StructField("subsystem", T.StringType()),
        T.StructField("aircraftregistration", T.StringType()),
        T.StructField("starttime", T.TimestampType()),
        T.StructField("kind", T.StringType()),
    ]
)


def rows(frame, *columns):
    """Rows of a frame as sorted tuples, in the named column order."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def formatted(frame):
    """The physical plan before it runs, in full."""
    explain = frame.sparkSession._jvm.PythonSQLUtils.explainString
    return explain(frame._jdf.queryExecution(), "formatted")


def day(d, month=1):
    return date(2024, month, d)


def at(d, hour=12, minute=0, month=1):
    return datetime(2024, month, d, hour, minute)


class Build:
    """Small frames by hand."""

    def __init__(self, spark):
        self.spark = spark

    def readings(self, *entries):
        """(timestamp, value, asset)"""
        return self.spark.createDataFrame([(t, "eventData", v, a) for t, v, a in entries], READING)

    def utilization(self, *entries):
        """(day, asset[, hours, delay, cycles])"""
        full = [(d, a, *(more or (1.0, 0.0, 1))) for d, a, *more in entries]
        return self.spark.createDataFrame(full, UTILIZATION)

    def interruptions(self, *entries):
        """(timestamp, asset[, subsystem, kind])"""
        full = [(*(more or ("3453", "Delay")), t, a) for t, a, *more in entries]
        return self.spark.createDataFrame([(s, a, t, k) for s, k, t, a in full], INTERRUPTION)
