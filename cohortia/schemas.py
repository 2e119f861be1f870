"""Fixed table schemas."""

from pyspark.sql import types as T

TARGETS = T.StructType(
    [
        T.StructField("xid", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("aspect", T.StringType()),
        T.StructField("value", T.FloatType()),
    ]
)

ACTIVE_SEGMENTS = T.StructType(
    [
        T.StructField("segment_id", T.IntegerType()),
        T.StructField("segment_name", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("last_processed_date", T.DateType()),
    ]
)

MEMBERSHIP = T.StructType(
    [
        T.StructField("ref_date", T.DateType()),
        T.StructField("type", T.StringType()),
        T.StructField("timestamp", T.IntegerType()),
        T.StructField("mcid", T.StringType()),
        T.StructField("segment_array", T.ArrayType(T.IntegerType())),
    ]
)

SCORES = T.StructType(
    [
        T.StructField("xid", T.StringType()),
        T.StructField("score", T.FloatType()),
        T.StructField("decile", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("tid", T.IntegerType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("workflow_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("arg_date", T.DateType()),
        T.StructField("execution_date", T.TimestampType()),
        T.StructField("info", T.StringType()),
        T.StructField("stats", T.StringType()),
        T.StructField("warnings", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("traceback", T.StringType()),
    ]
)

STAGE_REPORT = T.StructType(
    [
        T.StructField("workflow_id", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("trait_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("ui_name", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("arg_date", T.DateType()),
        T.StructField("execution_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("info", T.StringType()),
        T.StructField("stats", T.StringType()),
        T.StructField("warnings", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("traceback", T.StringType()),
    ]
)

# entries stay maps: writers differ in the case of ``FileName``
MANIFEST = T.StructType(
    [T.StructField("Files", T.ArrayType(T.MapType(T.StringType(), T.StringType())))]
)

SEGMENT_LIST = T.ArrayType(
    T.StructType(
        [
            T.StructField("SID", T.StringType()),
            T.StructField("Name", T.StringType()),
        ]
    )
)
