"""Fixed schemas of the documents and tables."""

from pyspark.sql import types as T

_D = T.DoubleType()
_S = T.StringType()

DOCUMENT = T.StructType(
    [
        T.StructField("dt", T.LongType()),
        T.StructField("coord", T.StructType([T.StructField("lon", _D), T.StructField("lat", _D)])),
        T.StructField(
            "main",
            T.StructType([T.StructField(c, _D) for c in ("temp", "feels_like", "humidity", "pressure")]),
        ),
        T.StructField("wind", T.StructType([T.StructField("speed", _D)])),
        T.StructField("clouds", T.StructType([T.StructField("all", _D)])),
        # A batch without rain lacks the whole object, so the schema is never inferred.
        T.StructField("rain", T.StructType([T.StructField("1h", _D)])),
        T.StructField(
            "city_info",
            T.StructType(
                [
                    T.StructField("city", _S),
                    T.StructField("country", _S),
                    T.StructField("lat", _D),
                    T.StructField("lon", _D),
                ]
            ),
        ),
        T.StructField("fetch_timestamp", _S),
        T.StructField("processed", T.BooleanType()),
    ]
)

CORRUPT = "_corrupt_record"

COUNTRY = T.StructType([T.StructField("country_id", T.LongType()), T.StructField("country_name", _S)])

CITY = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", _S),
        T.StructField("country_id", T.LongType()),
        T.StructField("lon", _D),
        T.StructField("lat", _D),
    ]
)

# Columns and types of the reading table a sink accepts.
READING = T.StructType(
    [
        T.StructField("location", _S),
        T.StructField("temperature", _D),
        T.StructField("humidity", _D),
        T.StructField("pressure", _D),
        T.StructField("wind_speed", _D),
        T.StructField("wind_direction", _S),
        T.StructField("precipitation", _D),
        T.StructField("rain_probability", _D),
        T.StructField("recorded_at", T.TimestampNTZType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("weather_data_id", T.LongType()),
        T.StructField("prediction", T.BooleanType()),
        T.StructField("confidence", _D),
        T.StructField("model_version", _S),
        T.StructField("predicted_at", T.TimestampType()),
    ]
)

MEASURES = ["temperature", "humidity", "pressure", "wind_speed", "precipitation"]
