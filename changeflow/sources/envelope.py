"""Log records: ``stream, seq_num, timestamp, headers array<struct<key,value>>, body``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.columns import clamp_timestamp, header_value, headers_json, known_op, lossy_utf8, restore_op
from changeflow.functions.schema import METADATA, OP, WIDER, check_reserved, parse_schema
from changeflow.operators.progress import schema_asof

#: Ends a body's array when a body is tested; no record holds it.
_MARK = "~changeflow-end-of-body~"


def select_streams(df: DataFrame, *, streams: str | list[str] | None = None, stream_prefix: str | None = None) -> DataFrame:
    """Records of named streams and of streams with a prefix; at least one of the two is needed.

    A literal filter, so partitions and row groups of other streams aren't read.
    """
    named = streams.split(",") if isinstance(streams, str) else list(streams or [])
    named = list(dict.fromkeys(s.strip() for s in named if s.strip()))
    if not named and not stream_prefix:
        raise ValueError("give streams or stream_prefix")
    wanted = F.lit(False)
    if named:
        wanted = F.col("stream").isin(named)
    if stream_prefix:
        wanted = wanted | F.col("stream").startswith(stream_prefix)
    return df.where(wanted)


def from_position(df: DataFrame, positions: DataFrame | None = None, *, start_position: str = "earliest", tails: DataFrame | None = None) -> DataFrame:
    """Records at or after each stream's saved position ``(stream, next_seq)``.

    Streams without one start at their first record, or at their tail for ``latest``: that of ``tails``
    (``stream, next_seq``), which a streaming query has to give, or of the table as it is now. Streams found later start at their first record.
    """
    if start_position not in ("earliest", "latest"):
        raise ValueError(f"start_position must be earliest or latest, not {start_position!r}")
    saved = None if positions is None else positions.select("stream", F.col("next_seq").cast("long").alias("_saved"))
    if start_position == "latest":
        if tails is None and df.isStreaming:
            raise ValueError("a streaming query that starts at the latest records needs tails")
        tails = df.groupBy("stream").agg((F.max("seq_num") + 1).alias("_tail")) if tails is None else tails.select("stream", F.col("next_seq").alias("_tail"))
        starts = tails if saved is None else tails.join(saved, "stream", "full")
        start = F.col("_tail") if saved is None else F.coalesce("_saved", "_tail")
        starts = starts.select("stream", start.alias("_from"))
    elif saved is None:
        return df
    else:
        starts = saved.withColumnRenamed("_saved", "_from")
    joined = df.join(starts, "stream", "left")
    return joined.where(F.col("seq_num") >= F.coalesce("_from", F.lit(0))).select(*df.columns)


def envelope(df: DataFrame, *, op_header: str = "dbz.op", op_col: str = OP, observation: Observation | None = None) -> DataFrame:
    """Raw records: ``op, stream, seq_num, timestamp, headers (JSON), body (text)``; unknown codes are counted."""
    code = header_value(F.col("headers"), op_header)
    if observation is not None:
        df = df.observe(observation, F.count_if(~known_op(code)).alias("unknown_ops"), F.count(F.lit(1)).alias("records"))
    when = F.col("timestamp") if isinstance(df.schema["timestamp"].dataType, (T.TimestampType, T.TimestampNTZType)) else clamp_timestamp(F.col("timestamp"))
    return df.select(restore_op(code).alias(op_col), "stream", "seq_num", when.alias("timestamp"), headers_json(F.col("headers")).alias("headers"), lossy_utf8(F.col("body")).alias("body"))


def _parsed(body: Column, fields: list[T.StructField]) -> Column:
    """The body and a mark as an array of two objects with the declared fields as text, those of text columns as variants.

    As text a number with a fraction has double precision, which a variant's has not.
    """
    raw = [T.StructField(f.name, T.VariantType() if isinstance(f.dataType, T.StringType) else T.StringType()) for f in fields]
    kind = T.ArrayType(T.StructType([*raw, T.StructField(_MARK, T.StringType())]))
    # Only JSON itself: Spark's reader would take more.
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    return F.from_json(F.concat(F.lit("["), body, F.lit(f',{{"{_MARK}":"{_MARK}"}}]')), kind, strict)


def _one_object(parsed: Column) -> Column:
    first, mark = F.get(parsed, F.lit(0)), F.get(parsed, F.lit(1))[_MARK]
    return F.coalesce((F.size(parsed) == 2) & (mark == _MARK) & first.isNotNull(), F.lit(False))


def is_single_json_object(body: Column) -> Column:
    """Exactly one JSON object; white space around it is fine, a second value isn't."""
    return _one_object(_parsed(body, [])) & F.ltrim(body, F.lit(" \t\r\n")).startswith("{")


def _text(raw: Column, field: T.StructField) -> Column:
    return F.try_variant_get(raw, "$", "string") if isinstance(field.dataType, T.StringType) else raw


def _typed(text: Column, field: T.StructField) -> Column:
    """The text of a value in the declared type, null where it isn't one: 1.5 and true are no integers, 2024 is no date."""
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true")
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        # 1e3 and 5.0 are integers, 1.5 isn't; most are plain digits, which the first cast takes.
        exact = text.try_cast("decimal(38,9)")
        value = F.when(exact == F.floor(exact), exact.try_cast(kind))
        value = F.coalesce(text.try_cast(kind), value) if isinstance(kind, T.IntegralType) else value
    elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        value = F.when(text.contains("-"), text.try_cast(kind))
    else:
        value = text.try_cast(kind)
    if limit := field.metadata.get("max"):
        value = F.when((value >= 0) & (value <= F.lit(limit).cast("decimal(38,0)")), value)
    return value


def _decoded(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of ``df``, ``_values`` (the declared columns) and ``_fine``; a body is parsed once and each value is cast once."""
    body = lossy_utf8(F.col("body"))
    # A generator's output is a column that no filter or later projection takes apart, so nothing is evaluated again.
    once = lambda rows, value, name: rows.select(*rows.columns, F.explode(F.array(value)).alias(name))
    rows = once(df.withColumn("_text", body), F.struct(_parsed(F.col("_text"), schema.fields).alias("p")), "_parse")
    first = F.get(F.col("_parse.p"), F.lit(0))
    whole = _one_object(F.col("_parse.p")) & F.ltrim(F.col("_text"), F.lit(" \t\r\n")).startswith("{")
    there = lambda f: F.lit(False) if isinstance(f.dataType, T.StringType) else first[f.name].isNotNull()  # noqa: E731  any value is a text
    pairs = [F.struct(there(f).alias("there"), _typed(_text(first[f.name], f), f).alias("value")).alias(f.name) for f in schema.fields]
    rows = once(rows, F.struct(whole.alias("whole"), F.struct(*pairs).alias("c")), "_cast")
    fine = F.col("_cast.whole")
    for f in schema.fields:
        there, value = F.col("_cast.c")[f.name]["there"], F.col("_cast.c")[f.name]["value"]
        fine = fine & (value.isNotNull() | ~there if f.nullable else value.isNotNull())
    values = F.struct(*(F.col("_cast.c")[f.name]["value"].alias(f.name) for f in schema.fields))
    return rows.select(*df.columns, values.alias("_values"), F.coalesce(fine, F.lit(False)).alias("_fine"))


def decode_json(df: DataFrame, schema: str | T.StructType, *, include_metadata: bool = False, on_malformed: str = "error", op_col: str = OP, op_header: str = "dbz.op", observation: Observation | None = None) -> DataFrame:
    """Records with JSON bodies as ``op, declared columns``, and metadata columns if asked for.

    Columns go by name, unknown keys are ignored (also repeated ones; of a repeated declared one the last counts),
    numbers and texts are taken for each other where nothing is lost. A malformed body (not one JSON object, a value of the wrong type, a required
    value that is missing) fails the query with its stream and seq_num, or is skipped and counted.
    """
    if on_malformed not in ("error", "skip"):
        raise ValueError(f"on_malformed must be error or skip, not {on_malformed!r}")
    schema = parse_schema(schema) if isinstance(schema, str) else schema
    check_reserved(schema, op_col=op_col, include_metadata=include_metadata)
    rows = _decoded(df, schema)
    if observation is not None:
        rows = rows.observe(observation, F.count_if(~F.col("_fine")).alias("malformed"), F.count(F.lit(1)).alias("records"))
    keep = F.col("_fine")
    if on_malformed == "error":
        # In the filter itself: in a column that nobody reads the error would never be raised.
        fail = F.raise_error(F.concat(F.lit("malformed record: stream "), F.col("stream"), F.lit(", seq_num "), F.col("seq_num").cast("string"))).cast("boolean")
        keep = F.when(keep, F.lit(True)).otherwise(fail)
    op = restore_op(header_value(F.col("headers"), op_header)).alias(op_col)
    extra = [F.col(c).alias(n) for c, n in zip(("stream", "seq_num", "timestamp"), METADATA, strict=True)] if include_metadata else []
    return rows.where(keep).select(op, *(F.col("_values")[f.name].alias(f.name) for f in schema.fields), *extra)


def malformed_rows(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """The records that ``on_malformed="skip"`` leaves out, as they are."""
    schema = parse_schema(schema) if isinstance(schema, str) else schema
    return _decoded(df, schema).where(~F.col("_fine")).select(*df.columns)


def decode_by_version(events: DataFrame, versions: DataFrame, output: str | T.StructType, *, body: str = "body", most: int = 1000) -> DataFrame:
    """``tbl, lsn, snapshot_id, output columns, malformed``: JSON images read by the schema that was in force at their ``lsn``.

    ``versions`` has ``tbl, snapshot_id, schema`` (schemas as text, see ``parse_schema``), at most ``most`` of them: they become one
    projection with a branch for each. An image is parsed once. A version reads only its own columns in its own types; they are
    aligned by name to the output and widened where that loses nothing, and what a version doesn't have is null. ``malformed`` tells
    rows with a value that is not of its version's type (it is null), without a required one, with a body that isn't one object, or before all versions.
    """
    output = parse_schema(output) if isinstance(output, str) else output
    given = versions.select("tbl", F.col("snapshot_id").cast("long"), "schema").distinct().limit(most + 1).collect()
    if len(given) > most:
        raise ValueError(f"more than {most} versions; decode table by table")
    schemas = {(r.tbl, r.snapshot_id): parse_schema(r.schema) for r in given}
    if len(schemas) < len(given):
        raise ValueError("two schemas for one version")
    names = sorted({f.name for s in schemas.values() for f in s.fields})
    found = schema_asof(events.select("tbl", "lsn", lossy_utf8(F.col(body)).alias("_text")), versions.select("tbl", "snapshot_id").distinct())
    raw = F.struct(_parsed(F.col("_text"), [T.StructField(n, T.StringType()) for n in names]).alias("p"))
    rows = found.select("*", F.explode(F.array(raw)).alias("_parse"))
    first = F.get(F.col("_parse.p"), F.lit(0))
    whole = _one_object(F.col("_parse.p")) & F.ltrim(F.col("_text"), F.lit(" \t\r\n")).startswith("{")
    rows = rows.select("tbl", "lsn", "snapshot_id", F.explode(F.array(F.struct(whole.alias("whole"), *(F.try_variant_get(first[n], "$", "string").alias(f"v{k}") for k, n in enumerate(names))))).alias("_v"))
    text = {n: F.col(f"_v.v{k}") for k, n in enumerate(names)}
    values = {f.name: F.lit(None).cast(f.dataType) for f in output.fields}
    bad = F.lit(True)
    for (tbl, snapshot), schema in schemas.items():
        here = (F.col("tbl") == tbl) & (F.col("snapshot_id") == snapshot)
        typed = {f.name: _typed(text[f.name], f) for f in schema.fields}
        wrong = ~F.col("_v.whole")
        for f in schema.fields:
            wrong = wrong | (typed[f.name].isNull() & (text[f.name].isNotNull() if f.nullable else F.lit(True)))
        bad = F.when(here, wrong).otherwise(bad)
        for f in output.fields:
            if f.name in typed:
                kind = schema[f.name].dataType
                fits = kind == f.dataType or (kind.simpleString(), f.dataType.simpleString()) in WIDER
                values[f.name] = F.when(here, typed[f.name].cast(f.dataType) if fits else F.lit(None).cast(f.dataType)).otherwise(values[f.name])
    return rows.select("tbl", "lsn", "snapshot_id", *(v.alias(n) for n, v in values.items()), bad.alias("malformed"))
