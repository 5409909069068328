"""Types: from a graph model to Spark columns, and from Spark columns to an index's field mapping."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

from ..model import Property, id_column

# Names of field types, and text as a whole with its analysed form, are what an index takes (fixed values).
#: Booleans are kept as text, as documents show them; numbers are doubles.
SCALAR = {"number": T.DoubleType(), "integer": T.LongType(), "string": T.StringType(), "boolean": T.StringType()}
#: From the widest on: what an index must take for a property of several types.
WIDEST = ("number", "integer", "boolean", "string")
FIELD = {"number": "float", "integer": "long", "string": "keyword", "boolean": "keyword"}


def spark_type(p: Property) -> T.DataType:
    """By the first type that is declared."""
    return T.ArrayType(SCALAR[p.items if p.items in SCALAR else "string"]) if p.is_array else SCALAR[p.types[0]]


def reduced_type(fn: str | None, p: Property) -> T.DataType:
    """Type of a property after a reducer."""
    if fn in ("set", "list"):
        kind = spark_type(p)
        return kind if isinstance(kind, T.ArrayType) else T.ArrayType(kind)
    return T.LongType() if fn == "count" else spark_type(p)


def index_type(p: Property) -> str:
    """Field type by the widest of the declared types; arrays count by their items."""
    if p.is_array:
        return FIELD[p.items if p.items in FIELD else "string"]
    return FIELD[min((t for t in p.types if t in FIELD), key=WIDEST.index, default="string")]


def node_schema(properties: dict[str, Property]) -> T.StructType:
    return T.StructType([T.StructField(n, spark_type(p)) for n, p in properties.items()])


def _field(kind: T.DataType) -> dict[str, Any]:
    if isinstance(kind, T.ArrayType):
        return _field(kind.elementType)
    if isinstance(kind, T.StructType):
        return {"type": "nested", "properties": {f.name: _field(f.dataType) for f in kind.fields}}
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return {"type": "float"}
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return {"type": "long"}
    return {"type": "keyword", "fields": {"analyzed": {"type": "text"}}}


def field_mapping(schema: T.StructType, doc_type: str) -> dict[str, Any]:
    """Field mapping of an index: text is searchable as a whole and analysed; the access fields are always there."""
    fields = {f.name: _field(f.dataType) for f in schema.fields if f.name != id_column(doc_type)}
    for name in ("auth_resource_path", "project_id"):
        fields[name] = {"type": "keyword"}
    fields["node_id"] = {"type": "keyword"}
    fields[id_column(doc_type)] = {"type": "keyword"}
    return {"mappings": {"properties": fields}}


def array_fields(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of all fields that hold arrays, nested ones included."""
    out: list[str] = []
    for f in schema.fields:
        kind = f.dataType
        if isinstance(kind, T.ArrayType):
            out.append(prefix + f.name)
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            out += array_fields(kind, f"{prefix}{f.name}.")
    return out
