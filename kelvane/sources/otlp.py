"""Metric batches on the wire: protobuf bytes to and from nested rows.

``decode_batches(native=True)`` is ``from_protobuf``, with the Spark protobuf
module on the class path; without the module the bytes are read by ``wire``, a
batch of messages at a time. Everything behind this step is native Spark.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvane import schemas
from kelvane.sources import wire

PACKAGE = "kelvane.wire"
ROOT_MESSAGE = f"{PACKAGE}.Batch"

# Fixed values of the public metrics protocol: fields as (name, number, type).
# "*" marks a repeated field; a trailing "?group" names its oneof.
WIRE_MESSAGES = {
    "Batch": ["resource_metrics 1 *ResourceMetrics"],
    "ResourceMetrics": ["resource 1 Resource", "scope_metrics 2 *ScopeMetrics"],
    "Resource": ["attributes 1 *KeyValue"],
    "ScopeMetrics": ["metrics 2 *Metric"],
    "Metric": [
        "name 1 string", "description 2 string", "unit 3 string",
        "gauge 5 Gauge ?data", "sum 7 Other ?data", "histogram 9 Other ?data",
        "exponential_histogram 10 Other ?data", "summary 11 Other ?data",
    ],
    "Other": [],
    "Gauge": ["data_points 1 *DataPoint"],
    "DataPoint": [
        "attributes 7 *KeyValue", "time_unix_nano 3 fixed64",
        "as_double 4 double ?value", "as_int 6 sfixed64 ?value",
    ],
    "KeyValue": ["key 1 string", "value 2 AnyValue"],
    "AnyValue": [
        "string_value 1 string ?value", "bool_value 2 bool ?value",
        "int_value 3 int64 ?value", "double_value 4 double ?value",
        "array_value 5 Other ?value", "kvlist_value 6 Other ?value", "bytes_value 7 bytes ?value",
    ],
}


def _file_descriptor():
    from google.protobuf import descriptor_pb2
    kinds = descriptor_pb2.FieldDescriptorProto
    scalars = {
        "string": kinds.TYPE_STRING, "bytes": kinds.TYPE_BYTES, "bool": kinds.TYPE_BOOL,
        "double": kinds.TYPE_DOUBLE, "int64": kinds.TYPE_INT64,
        "fixed64": kinds.TYPE_FIXED64, "sfixed64": kinds.TYPE_SFIXED64,
    }
    file = descriptor_pb2.FileDescriptorProto(
        name="kelvane_wire.proto", package=PACKAGE, syntax="proto3")
    for message_name, fields in WIRE_MESSAGES.items():
        message = file.message_type.add(name=message_name)
        groups: list[str] = []
        for spec in fields:
            name, number, kind, *group = spec.split()
            field = message.field.add(name=name, number=int(number))
            field.label = kinds.LABEL_REPEATED if kind[0] == "*" else kinds.LABEL_OPTIONAL
            kind = kind.lstrip("*")
            if kind in scalars:
                field.type = scalars[kind]
            else:
                field.type, field.type_name = kinds.TYPE_MESSAGE, f".{PACKAGE}.{kind}"
            if group:
                if group[0] not in groups:
                    groups.append(group[0])
                    message.oneof_decl.add(name=group[0].lstrip("?"))
                field.oneof_index = groups.index(group[0])
    return file


def descriptor_set() -> bytes:
    """The message definitions as a descriptor set for ``from_protobuf``."""
    from google.protobuf import descriptor_pb2
    return descriptor_pb2.FileDescriptorSet(file=[_file_descriptor()]).SerializeToString()


def decode_batches(messages: DataFrame, value: str = "value", native: bool = True) -> DataFrame:
    """Replace ``value`` by ``resource_metrics``, null where it cannot be read.

    ``native`` uses ``from_protobuf`` (needs the Spark protobuf module).
    """
    if native:
        decoded = _from_protobuf(F.col(value))
    else:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = to_arrow_type(schemas.RESOURCE_METRICS)

        @F.arrow_udf(schemas.RESOURCE_METRICS)
        def read(values: pa.Array) -> pa.Array:
            return wire.resource_metrics(values, kind)

        decoded = read(F.col(value))
    return messages.withColumn("resource_metrics", decoded).drop(value)


def _from_protobuf(value: Column) -> Column:
    from pyspark.sql.protobuf.functions import from_protobuf
    filled = F.when(F.octet_length(value) > 0, value)
    batch = from_protobuf(filled, ROOT_MESSAGE, options={"mode": "PERMISSIVE"},
                          binaryDescriptorSet=descriptor_set())
    return shaped(batch["resource_metrics"], schemas.RESOURCE_METRICS)


def shaped(col: Column, kind: T.DataType) -> Column:
    """A nested column cut down to the fields of ``kind``, by name."""
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: shaped(x, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(
            *[shaped(col[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return col


def encode_batches(batches: DataFrame, value: str = "value") -> DataFrame:
    """Replace ``resource_metrics`` by message bytes; row by row, for tests and made-up input."""

    @F.arrow_udf("binary")
    def write(values: pa.Array) -> pa.Array:
        return wire.all_coded(values)

    return batches.withColumn(value, write("resource_metrics")).drop("resource_metrics")
