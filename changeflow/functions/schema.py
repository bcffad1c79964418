"""Schemas and specifications given as text; all errors are raised before a job starts."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

OP = "_op"
METADATA = ("_stream", "_seq_num", "_timestamp")

# Type names of the schema notation. Unsigned types take the next wider signed one.
NAMED = {
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(), "long": T.LongType(),
    "uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0),
    "float32": T.FloatType(), "float": T.FloatType(), "float64": T.DoubleType(), "double": T.DoubleType(),
    "string": T.StringType(), "utf8": T.StringType(), "large_string": T.StringType(), "large_utf8": T.StringType(),
    "date": T.DateType(), "date32": T.DateType(),
    "timestamp": T.TimestampNTZType(), "timestamp_s": T.TimestampNTZType(), "timestamp_ms": T.TimestampNTZType(), "timestamp_us": T.TimestampNTZType(), "timestamp_ns": T.TimestampNTZType(),
}

# Column types of a Postgres table. All others are kept as text.
POSTGRES = {
    "bool": T.BooleanType(), "int2": T.ShortType(), "int4": T.IntegerType(), "int8": T.LongType(), "oid": T.LongType(),
    "float4": T.FloatType(), "float8": T.DoubleType(), "bytea": T.BinaryType(), "date": T.DateType(), "time": T.StringType(),
    "timestamp": T.TimestampNTZType(), "timestamptz": T.TimestampType(),
}

#: Conversions that lose nothing; any other difference of types gives null.
WIDER = {
    ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"),
}

#: Ranges of unsigned types, which the wider signed type doesn't enforce.
UNSIGNED = {"uint8": 2**8 - 1, "uint16": 2**16 - 1, "uint32": 2**32 - 1, "uint64": 2**64 - 1}


def parse_schema(spec: str) -> T.StructType:
    """``"id:int64, value:string?"`` as a schema; ``?`` marks a nullable column, type names ignore case."""
    fields = []
    for part in (p.strip() for p in spec.split(",")):
        name, colon, kind = (x.strip() for x in part.partition(":"))
        if not colon:
            raise ValueError(f"column {part!r} has no type; write name:type" if part else "the schema is empty or has an empty column")
        if not name:
            raise ValueError(f"column {part!r} has no name")
        nullable, kind = kind.endswith("?"), kind.rstrip("?").strip().lower()
        if kind not in NAMED:
            raise ValueError(f"unknown type {kind!r} of column {name!r}; one of {', '.join(NAMED)}")
        metadata = {"max": str(UNSIGNED[kind])} if kind in UNSIGNED else {}
        fields.append(T.StructField(name, NAMED[kind], nullable, metadata))
    return T.StructType(fields)


def check_reserved(schema: T.StructType, *, op_col: str = OP, include_metadata: bool = False) -> None:
    """A declared column may not be named like the op column, or like metadata that is added."""
    taken = {op_col, *(METADATA if include_metadata else ())}
    if clash := [f.name for f in schema.fields if f.name in taken]:
        raise ValueError(f"reserved column names: {', '.join(clash)}")


def pg_schema(columns: list[tuple[str, str]], *, op_col: str = OP) -> T.StructType:
    """(name, Postgres type) pairs as a schema of nullable columns."""
    if not columns:
        raise ValueError("the table has no columns")
    schema = T.StructType([T.StructField(n, POSTGRES.get(t.lower(), T.StringType()), True) for n, t in columns])
    check_reserved(schema, op_col=op_col)
    return schema


def parse_partition_columns(spec: str | None, schema: T.StructType) -> list[str]:
    """Comma list of columns in the order of the path; blank means none, a trailing comma is ignored."""
    names = [p.strip() for p in (spec or "").split(",")]
    while names and not names[-1]:
        names.pop()
    for k, n in enumerate(names):
        if not re.fullmatch(r"[A-Za-z0-9_]+", n):
            raise ValueError(f"partition column {n!r} has characters other than letters, digits and underscore")
        if n in names[:k]:
            raise ValueError(f"partition column {n!r} is named twice")
        if n not in schema.names:
            raise ValueError(f"no column {n!r}; there are {', '.join(schema.names)}")
    return names


@dataclass(frozen=True)
class Segment:
    text: str
    is_column: bool


def parse_stream_template(template: str) -> list[Segment]:
    """``"events/{tenant}"`` as literal and column segments."""
    if not template:
        raise ValueError("the stream template is empty")
    out, literal, at = [], "", 0
    while at < len(template):
        c = template[at]
        if c == "}":
            raise ValueError(f"stray }} at {at} in {template!r}")
        if c != "{":
            literal, at = literal + c, at + 1
            continue
        end = template.find("}", at)
        if end < 0:
            raise ValueError(f"unclosed {{ at {at} in {template!r}")
        name = template[at + 1 : end]
        if "{" in name:
            raise ValueError(f"nested {{ in {template!r}")
        if not name.strip():
            raise ValueError(f"empty {{}} in {template!r}")
        if literal:
            out.append(Segment(literal, False))
        out.append(Segment(name.strip(), True))
        literal, at = "", end + 1
    return [*out, Segment(literal, False)] if literal else out


# Column types by dialect. Nested values are JSON; all others are text.
RELATIONAL = {
    "mysql": {
        T.BooleanType: "BOOLEAN", T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT",
        T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.BinaryType: "LONGBLOB", T.DateType: "DATE",
        T.TimestampType: "DATETIME(6)", T.TimestampNTZType: "DATETIME(6)", T.StructType: "JSON", T.ArrayType: "JSON", T.MapType: "JSON",
    },
    "standard": {
        T.BooleanType: "BOOLEAN", T.ByteType: "SMALLINT", T.ShortType: "SMALLINT", T.IntegerType: "INTEGER", T.LongType: "BIGINT",
        T.FloatType: "REAL", T.DoubleType: "DOUBLE PRECISION", T.BinaryType: "BLOB", T.DateType: "DATE",
        T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
    },
}
#: Text of unknown length, and text that a key can have.
_TEXT = {"mysql": ("TEXT", "TEXT"), "standard": ("CLOB", "VARCHAR(255)")}
_QUOTE = {"mysql": "`", "standard": '"'}


def quoted(name: str, dialect: str = "mysql") -> str:
    mark = quote_of(dialect)
    return mark + name.replace(mark, 2 * mark) + mark


def quote_of(dialect: str) -> str:
    if dialect not in _QUOTE:
        raise ValueError(f"dialect must be one of {', '.join(_QUOTE)}, not {dialect!r}")
    return _QUOTE[dialect]


def relational_type(kind: T.DataType, dialect: str = "mysql", *, key: bool = False) -> str:
    """Column type of a relational table."""
    quote_of(dialect)
    if isinstance(kind, T.DecimalType):
        precision = min(kind.precision, 65)
        return f"DECIMAL({precision}, {min(kind.scale, 30, precision)})"
    return RELATIONAL[dialect].get(type(kind), _TEXT[dialect][key])


def create_table_sql(schema: T.StructType, table: str, keys: list[str], *, op_col: str = OP, dialect: str = "mysql") -> str:
    """Statement that makes the table, in MySQL where it is missing; there text and binary keys use a prefix of 255."""
    fields = [f for f in schema.fields if f.name != op_col]
    kinds = {f.name: relational_type(f.dataType, dialect, key=f.name in keys) for f in fields}
    if missing := [k for k in keys if k not in kinds]:
        raise ValueError(f"key columns that don't exist: {', '.join(missing)}")
    q = lambda name: quoted(name, dialect)
    mysql = dialect == "mysql"
    lines = [f"  {q(f.name)} {kinds[f.name]}{'' if f.nullable and (mysql or f.name not in keys) else ' NOT NULL'}" for f in fields]
    if keys:
        prefixed = (f"{q(k)}(255)" if mysql and kinds[k] in ("TEXT", "LONGBLOB") else q(k) for k in keys)
        lines.append(f"  PRIMARY KEY ({', '.join(prefixed)})")
    return f"CREATE TABLE {'IF NOT EXISTS ' if mysql else ''}{q(table)} (\n" + ",\n".join(lines) + "\n)"
