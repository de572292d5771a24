import pytest
from pyspark.sql import functions as F

from millrace.functions import (
    blank_to_null,
    drop_blank_entries,
    merge_maps,
    period_seconds,
    short_type_name,
    size_bytes,
    split_list,
)


def apply(spark, function, values):
    rows = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in rows.select(function(F.col("x"))).collect()]


def test_sizes_are_1024_based_and_bad_text_is_null(spark):
    values = ["1 GB", "10 KB", "1.5 KB", " 7B ", "2 TB", "x", "", "-1 KB", "9" * 22 + " TB", None]
    assert apply(spark, size_bytes, values) == [
        1073741824, 10240, 1536, 7, 2 * 1024**4, None, None, None, None, None,
    ]


def test_periods(spark):
    values = ["5 min", "0 sec", "1 hour", "1500 ms", "2 days", "0 0/5 * * * ?", None]
    assert apply(spark, period_seconds, values) == [300, 0, 3600, 1, 172800, None, None]


def test_blank(spark):
    assert apply(spark, blank_to_null, [" a ", " \t\r\n\x0b ", "", None]) == ["a", None, None, None]


@pytest.mark.parametrize("drop, expected", [(False, ["a", "", "b"]), (True, ["a", "b"])])
def test_comma_list(spark, drop, expected):
    found = apply(spark, lambda c: split_list(c, drop), ["a, ,b", "  ", None])
    assert found == [expected, None, None]


def test_short_type_name(spark):
    values = ["org.example.GetFile", "GetFile", "a.b.", ""]
    assert apply(spark, short_type_name, values) == ["GetFile", "GetFile", "a.b.", ""]


def test_maps(spark):
    row = spark.range(1).select(
        merge_maps(
            F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")),
            F.create_map(F.lit("b"), F.lit("3"), F.lit("c"), F.lit("4")),
        ),
        merge_maps(F.lit(None).cast("map<string,string>"), F.create_map(F.lit("a"), F.lit("1"))),
        drop_blank_entries(F.create_map(F.lit("a"), F.lit(""), F.lit("b"), F.lit("2"))),
    ).first()
    assert tuple(row) == ({"a": "1", "b": "3", "c": "4"}, {"a": "1"}, {"b": "2"})
