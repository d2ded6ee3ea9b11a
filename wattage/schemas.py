"""Declared schemas of the raw and ML tables (marts take the schema of their plan)."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_KEY = ("period_date", "respondent", "data_type")

RAW_READINGS = T.StructType(
    [
        T.StructField("period_date", T.TimestampNTZType(), False),
        T.StructField("respondent", T.StringType(), False),
        T.StructField("respondent_name", T.StringType(), True),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("data_type_name", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("value_units", T.StringType(), True),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
)

# One landed page of the readings service: {"response": {"total": .., "data": [..]}}.
# Every field of a reading arrives as text; hyphenated names are kept as sent.
READING_FIELDS = ("period", "respondent", "respondent-name", "type", "type-name", "value", "value-units")

PAGE = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("total", T.StringType(), True),
                    T.StructField(
                        "data",
                        T.ArrayType(T.StructType([T.StructField(f, T.StringType(), True) for f in READING_FIELDS])),
                        True,
                    ),
                ]
            ),
            True,
        )
    ]
)

# As read: a page that is not JSON of this shape arrives whole as text.
CORRUPT = "_corrupt_record"
PAGE_AS_READ = T.StructType([*PAGE.fields, T.StructField(CORRUPT, T.StringType(), True)])

FORECAST_KEY = ("region", "forecast_date", "generated_at")

FORECAST_RESULTS = T.StructType(
    [
        T.StructField("region", T.StringType(), False),
        T.StructField("forecast_date", T.TimestampNTZType(), False),
        T.StructField("actual", T.DoubleType(), True),
        T.StructField("forecast", T.DoubleType(), True),
        T.StructField("lower_bound", T.DoubleType(), True),
        T.StructField("upper_bound", T.DoubleType(), True),
        T.StructField("generated_at", T.TimestampNTZType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
)

METRIC_KEY = ("model_version", "region", "metric_name")

MODEL_METRICS = T.StructType(
    [
        T.StructField("model_version", T.StringType(), False),
        T.StructField("training_date", T.TimestampNTZType(), True),
        T.StructField("region", T.StringType(), False),
        T.StructField("metric_name", T.StringType(), False),
        T.StructField("metric_value", T.DoubleType(), True),
        T.StructField("dataset_type", T.StringType(), True),
        T.StructField("created_at", T.TimestampNTZType(), True),
    ]
)
