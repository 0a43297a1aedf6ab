"""Declared schemas of the inputs, so that no read needs a pass to infer one."""

from __future__ import annotations

from pyspark.sql import types as T

VISIT = T.StructType(
    [T.StructField("timestamp", T.LongType()), T.StructField("url", T.StringType())]
)

WEBLOGS = T.StructType(
    [T.StructField("uid", T.StringType()), T.StructField("visits", T.ArrayType(VISIT))]
)

LABELLED_WEBLOGS = T.StructType(
    [
        T.StructField("gender_age", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("visits", T.ArrayType(VISIT)),
    ]
)

SHOP_VISITS = T.StructType(
    [
        T.StructField("uid", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# As stored by the event split: the day is also kept in the rows.
STORED_VISITS = T.StructType(SHOP_VISITS.fields + [T.StructField("date", T.StringType())])

DOMAIN_CATEGORIES = T.StructType(
    [T.StructField("domain", T.StringType()), T.StructField("category", T.StringType())]
)
