"""JSON form of window results and alerts between jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvane import schemas

# Bad text must fail the query, so nothing beyond standard JSON is let through.
STRICT = {
    "mode": "FAILFAST",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowNumericLeadingZeros": "false",
}


def to_messages(rows: DataFrame, schema: T.StructType, ordinal: str) -> DataFrame:
    """Rows as (key, value, ordinal): the room's bytes, a JSON document and the
    place among the messages of the room, which topic writers keep."""
    return rows.filter(F.col("room").isNotNull()).select(
        F.col("room").cast("binary").alias("key"),
        F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"}).alias("value"),
        F.col(ordinal).alias("ordinal"),
    )


def window_messages(window_results: DataFrame) -> DataFrame:
    return to_messages(window_results, schemas.WINDOW_RESULT, "bucket_ms")


def alert_messages(alerts: DataFrame) -> DataFrame:
    return to_messages(alerts, schemas.ALERT, "window_start_ms")


def read_messages(
    messages: DataFrame, schema: T.StructType = schemas.WINDOW_RESULT,
    value: str = "value", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decode JSON documents; bad JSON or an unknown field fails the query.

    An absent number reads 0. Numbers may be quoted.
    """
    text = F.col(value).cast("string")
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])
    known = F.array(*[F.lit(name) for name in schema.names])
    parsed = messages.select(
        *keep, text.alias("_text"), F.from_json(text, as_text, STRICT).alias("_doc"))
    checked = parsed.filter(
        F.assert_true(F.col("_doc").isNotNull(), F.concat(
            F.lit("not a JSON object: "), F.coalesce("_text", F.lit("null")))).isNull()
        & F.assert_true(F.size(F.array_except(F.json_object_keys("_text"), known)) == 0, F.concat(
            F.lit("unknown field in "), F.coalesce("_text", F.lit("null")))).isNull())
    columns = []
    for field in schema.fields:
        col = F.col("_doc")[field.name]
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            number = F.nullif(col, F.lit("")).cast("decimal(38,6)").cast(field.dataType)
            col = F.coalesce(number, F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.DoubleType):
            col = F.coalesce(F.nullif(col, F.lit("")).cast("double"), F.lit(0.0))
        columns.append(col.alias(field.name))
    return checked.select(*keep, *columns)
