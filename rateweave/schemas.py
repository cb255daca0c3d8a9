"""Declared schemas: nothing in the library infers a schema from data."""

from pyspark.sql import types as T

# One rating after parsing; ``timestamp`` is epoch seconds.
RATING = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# JSON body of one event on the topic.
EVENT_JSON = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# The part of the broker's record the operators read.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RECOMMENDATIONS = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_id", T.IntegerType()),
                        T.StructField("rating", T.FloatType()),
                    ]
                )
            ),
        ),
    ]
)

# Items in ranking order, best first.
RANKED = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_id", T.IntegerType()),
                        T.StructField("predicted_rating", T.FloatType()),
                    ]
                )
            ),
        ),
    ]
)
