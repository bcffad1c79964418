"""Column expressions: operations, headers, text forms, 256-bit numbers and path segments."""

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.schema import OP, parse_stream_template

#: Latest instant that Spark prints: the end of the year 9999.
LAST_MILLIS = 253402300799999
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def header_value(headers: Column, name: str) -> Column:
    """Value of the first header of that name as text, null where there is none."""
    return F.get(F.filter(headers, lambda h: h["key"].cast("string") == name), F.lit(0))["value"].cast("string")


def restore_op(code: Column) -> Column:
    """i, u or d from a log's code: c and r are inserts, and so is a missing or unknown code."""
    return F.when(code == "u", "u").when(code == "d", "d").otherwise("i")


def known_op(code: Column) -> Column:
    return code.isNull() | code.isin("c", "r", "u", "d")


def encode_op(op: Column) -> Column:
    """A log's code from i, u or d; anything else, null included, is an error."""
    bad = F.raise_error(F.concat(F.lit("not an operation: "), F.coalesce(op, F.lit("null")))).cast("string")
    return F.when(op == "i", "c").when(op == "u", "u").when(op == "d", "d").otherwise(bad)


def require_op(df: DataFrame, op_col: str = OP) -> None:
    if op_col not in df.columns:
        raise ValueError(f"no operation column {op_col!r}; there are {', '.join(df.columns)}")


def checked_op(df: DataFrame, op_col: str = OP) -> DataFrame:
    """The rows with an operation column that fails where it is null.

    In the column itself: whoever compares it meets the error, whereas filters may be reordered and skip rows before a check.
    """
    require_op(df, op_col)
    return df.withColumn(op_col, F.coalesce(F.col(op_col), F.raise_error(F.lit(f"null operation in {op_col}")).cast("string")))


def strip_op(df: DataFrame, op_col: str = OP) -> DataFrame:
    return df.drop(op_col)


def headers_json(headers: Column) -> Column:
    """Headers as a JSON object with sorted keys; the last value of a repeated key counts; null without headers."""
    text = F.transform(headers, lambda h: F.struct(h["key"].cast("string").alias("key"), h["value"].cast("string").alias("value")))
    keys = F.array_sort(F.array_distinct(F.transform(text, lambda h: h["key"])))
    last = lambda k: F.element_at(F.filter(text, lambda h: h["key"] == k), -1)["value"]
    return F.when(F.size(headers) > 0, F.to_json(F.map_from_arrays(keys, F.transform(keys, last))))


def lossy_utf8(body: Column) -> Column:
    """Bytes as text; what is no UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(body.cast("string"))


def clamp_timestamp(millis: Column) -> Column:
    """Epoch milliseconds as a timestamp; values beyond the last instant stay there and never wrap."""
    return F.timestamp_millis(F.least(millis, F.lit(LAST_MILLIS)).cast("long"))


def hash_name(name: Column) -> Column:
    """Stable 64-bit id of a name: the first 8 bytes of its SHA-256, big-endian and unsigned."""
    return F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def percent_encoded(text: Column) -> Column:
    """RFC 3986: all but letters, digits and ``-._~``."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def hive_path_segment(columns: list[str]) -> Column:
    """``a=1/b=x%20y``, in the order given; nulls have the name that Hive gives them."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(percent_encoded(F.col(c).cast("string")), F.lit(HIVE_NULL))) for c in columns]
    return F.concat_ws("/", *parts)


def _u256(text: pd.Series) -> pd.Series:
    def one(s: str) -> bytes:
        n = int(s)
        if not 0 <= n < 1 << 256:
            raise ValueError(f"not an unsigned 256-bit number: {s}")
        return n.to_bytes(32, "big")

    return text.map(one, na_action="ignore")


def to_u256(text: Column) -> Column:
    """A decimal text as 32 bytes, big-endian; numbers below 0 or beyond 2**256 - 1 are errors."""
    return F.pandas_udf(_u256, T.BinaryType())(text)


def _u256_text(value: pd.Series) -> pd.Series:
    def one(b: bytes) -> str:
        if len(b) != 32:
            raise ValueError(f"not a 256-bit number: {len(b)} bytes")
        return str(int.from_bytes(b, "big"))

    return value.map(one, na_action="ignore")


def u256_to_text(value: Column) -> Column:
    """32 bytes, big-endian, as a decimal text; Spark's numbers end at 38 digits."""
    return F.pandas_udf(_u256_text, T.StringType())(value)


def cell_text(name: str, kind: T.DataType) -> Column:
    """A cell as text: plain decimals, base64 bytes, ISO dates and times with six digits, nested values as JSON."""
    c = F.col(name)
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(kind, T.TimestampType):
        return F.concat(F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    return c.cast("string")


def json_cell(value: Column, kind: T.DataType) -> Column:
    """A value as JSON is to have it: bytes as hex at every depth; what holds no bytes is left as it is."""
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(value))
    if not _holds_bytes(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: json_cell(x, kind.elementType))
    if isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(json_cell(e["key"], kind.keyType).alias("key"), json_cell(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(pairs)
    fields = F.struct(*(json_cell(value[f.name], f.dataType).alias(f.name) for f in kind.fields))
    return F.when(value.isNotNull(), fields)


def _holds_bytes(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_bytes(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_bytes(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_bytes(kind.keyType) or _holds_bytes(kind.valueType)
    return isinstance(kind, T.BinaryType)


def row_json(fields: list[T.StructField], u256: tuple[str, ...] = ()) -> Column:
    """The named columns as one JSON object without nulls: the body of messages and log records, whichever way they go."""
    return F.to_json(F.struct(*((u256_to_text(F.col(f.name)) if f.name in u256 else json_cell(F.col(f.name), f.dataType)).alias(f.name) for f in fields)))


def relational_cell(name: str, kind: T.DataType) -> Column:
    """A cell for a relational statement: a fraction of a second only where there is one, decimals with their scale."""
    c = F.col(name)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        fraction = F.date_format(c, "SSSSSS")
        return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))
    if isinstance(kind, T.DecimalType):
        return c.cast("string")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c


def route_name(template: str, columns: list[str]) -> Column:
    """The template filled from a row. A null value, a ``/`` in a value and the names ``.``, ``..`` and blank are errors."""
    parts = []
    for segment in parse_stream_template(template):
        if not segment.is_column:
            parts.append(F.lit(segment.text))
            continue
        if segment.text not in columns:
            raise ValueError(f"template column {segment.text!r} doesn't exist; there are {', '.join(columns)}")
        value = F.col(segment.text).cast("string")
        fail = lambda why, name=segment.text: F.raise_error(F.concat(F.lit(f"column {name} {why}: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("string")
        parts.append(F.when(value.isNull(), fail("has no value")).when(value.contains("/"), fail("has a /")).otherwise(value))
    name = F.concat(*parts)
    bad = F.trim(name).isin("", ".", "..") | (F.octet_length(name) > 512)
    return F.when(bad, F.raise_error(F.concat(F.lit("not a stream name: "), name)).cast("string")).otherwise(name)
