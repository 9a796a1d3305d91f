"""Random strings: Spark split expressions vs plain-Python models of the JVM
behaviour the reference relies on. One Spark job per generated batch."""
import re

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigshape.functions.split import split_csv, split_list_cell, split_literal

ALPHABET = st.sampled_from(list("ab|,; \t"))
BATCH = st.lists(st.text(ALPHABET, max_size=12), min_size=20, max_size=60)
SETTINGS = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def java_split_limit0(s: str, sep: str) -> list[str]:
    """``String.split`` with a literal separator and limit 0."""
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def csv_model(s: str) -> list[str]:
    """``(s + ",appendSplit").split(",").dropRight(1)``."""
    return java_split_limit0(s + ",appendSplit", ",")[:-1]


def whole_separator_model(s: str, sep: str) -> list[str]:
    """Whole-separator split preserving all tokens."""
    if s == "":
        return []
    if sep == "":
        return re.split(r"[ \t\n\x0b\f\r]", s)
    return s.split(sep)


def _spark(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


@SETTINGS
@given(BATCH)
def test_list_cell_split_matches_string_split(spark, values):
    assert _spark(spark, values, split_list_cell) == [java_split_limit0(v, "|") for v in values]


@SETTINGS
@given(BATCH)
def test_csv_split_matches_sentinel_trick(spark, values):
    assert _spark(spark, values, split_csv) == [csv_model(v) for v in values]


@SETTINGS
@given(BATCH, st.sampled_from(["|", "||", ",;", "; ", "", "a|"]))
def test_literal_split_matches_whole_separator_split(spark, values, sep):
    got = _spark(spark, values, lambda c: split_literal(c, sep))
    assert got == [whole_separator_model(v, sep) for v in values]


@SETTINGS
@given(BATCH, st.sampled_from(["||", ";,"]))
def test_multichar_list_cell_split(spark, values, sep):
    got = _spark(spark, values, lambda c: split_list_cell(c, sep))
    assert got == [java_split_limit0(v, sep) for v in values]


UNICODE = st.lists(st.text(st.sampled_from(list("a|,é中😀  ")), max_size=10), min_size=20, max_size=40)


@SETTINGS
@given(UNICODE, st.sampled_from(["|", "😀", "中|", "é"]))
def test_unicode_text_and_separators(spark, values, sep):
    """Multi-byte and astral-plane characters (the JVM splits UTF-16, Spark stores UTF-8)."""
    assert _spark(spark, values, split_list_cell) == [java_split_limit0(v, "|") for v in values]
    assert _spark(spark, values, split_csv) == [csv_model(v) for v in values]
    got = _spark(spark, values, lambda c: split_literal(c, sep))
    assert got == [whole_separator_model(v, sep) for v in values]
