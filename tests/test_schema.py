import pytest
from changeflow.functions.schema import check_reserved, create_table_sql, parse_partition_columns, parse_schema, parse_stream_template, pg_schema, relational_type
from pyspark.sql import types as T


def test_parse_schema():
    s = parse_schema(" id:INT64 , value: string? ,u:uint64,t:timestamp_ns?")
    assert [(f.name, f.dataType, f.nullable) for f in s] == [("id", T.LongType(), False), ("value", T.StringType(), True), ("u", T.DecimalType(20, 0), False), ("t", T.TimestampNTZType(), True)]


@pytest.mark.parametrize("spec", ["", " ", "id", "id:", ":int64", "id:decimal", "id:int64,,x:string", "id:int64,"])
def test_bad_schemas(spec):
    with pytest.raises(ValueError):
        parse_schema(spec)


def test_reserved_names():
    with pytest.raises(ValueError):
        check_reserved(parse_schema("_op:string"))
    check_reserved(parse_schema("_stream:string"))
    with pytest.raises(ValueError):
        check_reserved(parse_schema("_stream:string"), include_metadata=True)


def test_pg_schema():
    s = pg_schema([("id", "int8"), ("n", "numeric"), ("o", "OID"), ("at", "timestamptz"), ("t", "time"), ("tags", "_text")])
    assert [f.dataType.simpleString() for f in s] == ["bigint", "string", "bigint", "timestamp", "string", "string"] and all(f.nullable for f in s)
    with pytest.raises(ValueError):
        pg_schema([])


def test_partition_columns():
    s = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "dt", "chain")])
    assert parse_partition_columns(None, s) == parse_partition_columns("  ", s) == []
    assert parse_partition_columns("dt, chain,", s) == ["dt", "chain"]
    for bad in ("dt,dt", "d-t", "nope", ",dt"):
        with pytest.raises(ValueError):
            parse_partition_columns(bad, s)


def test_stream_template():
    assert [(s.text, s.is_column) for s in parse_stream_template("events/{tenant}-{id}")] == [("events/", False), ("tenant", True), ("-", False), ("id", True)]
    assert [(s.text, s.is_column) for s in parse_stream_template("fixed")] == [("fixed", False)]
    for bad in ("", "a{b", "a{b{c}}", "a}b", "a{}", "a{ }"):
        with pytest.raises(ValueError):
            parse_stream_template(bad)


def test_create_table():
    s = T.StructType([T.StructField("_op", T.StringType()), T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()), T.StructField("p", T.DecimalType(38, 31)), T.StructField("x", T.ArrayType(T.LongType()))])
    sql = create_table_sql(s, "t", ["id", "name"])
    assert sql == "CREATE TABLE IF NOT EXISTS `t` (\n  `id` BIGINT NOT NULL,\n  `name` TEXT,\n  `p` DECIMAL(38, 30),\n  `x` JSON,\n  PRIMARY KEY (`id`, `name`(255))\n)"
    assert relational_type(T.TimestampNTZType()) == "DATETIME(6)"
    with pytest.raises(ValueError):
        create_table_sql(s, "t", ["nope"])
