"""Table schemas and the contract check applied before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column names of the sensor hierarchy, the only storable
# types, and the published popularity schema.
NETWORK_COLUMNS = ["folder_name", "floor_name", "user_id", "place_id", "network_id", "unit_id", "rssi_fx"]
DIMENSION_COLUMNS = ["folder_name", "user_id", "place_id", "floor_name", "network_id"]
STORABLE_TYPES = (
    T.DateType,
    T.TimestampType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.StringType,
    T.BinaryType,
    T.BooleanType,
)


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def popularity_schema(grain: str, member: str) -> T.StructType:
    fields = [("date", T.DateType())]
    if grain == "hour":
        fields.append(("hour", T.IntegerType()))
    fields += [(name, T.StringType()) for name in ("user_id", "place_id", "floor_name", member)]
    fields.append(("popular_area", T.DoubleType()))
    return T.StructType([T.StructField(name, kind, nullable=False) for name, kind in fields])


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns by name, cast them, and fail the job on a null in a NOT NULL one.

    The check is part of the projection, so it costs no extra pass.
    """
    columns = []
    for field in schema.fields:
        if not isinstance(field.dataType, STORABLE_TYPES):
            raise TypeError(f"column {field.name}: type {field.dataType.simpleString()} cannot be stored")
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"column {field.name} must not be null")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)
