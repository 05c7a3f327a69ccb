"""S3: what a CSV holds is what was written, for any text, null and value."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from bramble.sources.sinks import NULL, own_path, read_csv, write_csv

AWKWARD = ["two\nlines", " padded ", "", None, '"', '""', "a,b", "\\", NULL, "\\\\N", "\r\n", "\r", "\n", "null", "é\u2028", "#", "\t", "'", 'x"\n,"y', "\\\"", "NaN", "\x01", "a\\", '\\"']


def same(spark, df, **write):
    back = read_csv(spark, write_csv(df, **write), df.schema)
    assert back.columns == df.columns and [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    key = lambda r: repr(tuple(r))
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)


def test_awkward_texts(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in AWKWARD for b in AWKWARD)]
    df = spark.createDataFrame(rows, "id bigint, `a,\"b` string, `c\nd` string")
    same(spark, df.repartition(3))
    same(spark, df, single_file=True)
    same(spark, df.repartition(2), rows_per_file=7)


def test_one_column_of_nulls_and_blanks(spark):
    same(spark, spark.createDataFrame([(x,) for x in AWKWARD * 3], "only string"))
    same(spark, spark.createDataFrame([], "only string, n int"))


def test_other_types_keep_all_digits(spark):
    rows = [
        (1, 0.1 + 0.2, Decimal("12345678901234567.89"), True, dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 23, 59, 59, 123456), b"\x00\xff\n", float("inf")),
        (None, None, None, None, None, None, None, None),
        (-(2**63), 1e-310, Decimal("-0.01"), False, dt.date(1, 1, 1), dt.datetime(1970, 1, 1), b"", -0.0),
    ]
    df = spark.createDataFrame(rows, "a bigint, b double, c decimal(20,2), d boolean, e date, f timestamp_ntz, g binary, h double")
    same(spark, df)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet=st.sampled_from('a"\\N,\n\r\t é'), max_size=8)), st.one_of(st.none(), st.text(max_size=5).filter(lambda s: "\x00" not in s and not any(0xD800 <= ord(c) < 0xE000 for c in s)))), max_size=30))
def test_any_text(spark, rows):
    same(spark, spark.createDataFrame([Row(a=a, b=b) for a, b in rows], "a string, b string"))


def test_own_paths_and_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    one, two = write_csv(df), write_csv(df)
    assert one != two and own_path(spark, "csv") != own_path(spark, "csv")
    path = write_csv(df, str(tmp_path / "c"))
    with pytest.raises(Exception):
        write_csv(df, path)
    with pytest.raises(ValueError):
        write_csv(spark.createDataFrame([([1],)], "a array<int>"))
    with pytest.raises(Exception):
        read_csv(spark, path, "id int, t int").collect()
    assert [tuple(r) for r in read_csv(spark, path).collect()] == [("1", "x")]
