"""Explicit schemas of files read and written, so that no scan needs an inference pass."""

from pyspark.sql import types as T

READING_FILE = T.StructType(
    [
        T.StructField("date", T.TimestampType()),
        T.StructField("series", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

MODEL_SCORES = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("Model", T.StringType()),
        T.StructField("F1-Score", T.DoubleType()),
    ]
)

GRID_SCORES = T.StructType(
    [
        T.StructField("Model", T.StringType()),
        T.StructField("point", T.IntegerType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("mean_f1", T.DoubleType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("model_path", T.StringType()),
    ]
)


def matrix(key: T.DataType = T.StringType(), labelled: bool = True) -> T.StructType:
    """Schema of the matrix, or of unlabelled feature rows, for an asset key type."""
    fields = [
        T.StructField("date", T.DateType()),
        T.StructField("aircraftid", key),
        T.StructField("sensor_mean_value", T.DoubleType()),
        T.StructField("flighthours", T.DoubleType()),
        T.StructField("delayedminutes", T.DoubleType()),
        T.StructField("flightcycles", T.LongType()),
    ]
    if labelled:
        fields.append(T.StructField("label", T.IntegerType()))
    return T.StructType(fields)

SETTINGS = T.StructType(
    [
        T.StructField("horizon", T.IntegerType()),
        T.StructField("subsystem", T.StringType()),
        T.StructField("kinds", T.ArrayType(T.StringType())),
        T.StructField("features", T.ArrayType(T.StringType())),
    ]
)
