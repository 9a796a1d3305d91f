import pytest
from pyspark.sql import functions as F

from sigshape.functions.split import (decode_escapes, quote_literal, split_csv, split_list_cell,
                                      split_literal)
from sigshape.sources.records import topic_set


def _apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_csv_split_keeps_trailing_empties(spark):
    got = _apply(spark, split_csv, ["", ",", "a,b,", "a,,b"])
    assert got == [[""], ["", ""], ["a", "b", ""], ["a", "", "b"]]


def test_list_cell_split_drops_only_trailing_empties(spark):
    got = _apply(spark, split_list_cell, ["", "|", "||", "a||", "|a", "a||b", "a"])
    assert got == [[""], [], [], ["a"], ["", "a"], ["a", "", "b"], ["a"]]


def test_list_cell_split_null_stays_null(spark):
    assert _apply(spark, split_list_cell, [None]) == [None]


def test_literal_split_is_not_regex(spark):
    got = _apply(spark, lambda c: split_literal(c, "||"), ["a||b|c", "||", "a||||b", "a|||b"])
    assert got == [["a", "b|c"], ["", ""], ["a", "", "b"], ["a", "|b"]]


def test_literal_split_escaped_separator(spark):
    sep = decode_escapes("\\t")
    assert sep == "\t"
    got = _apply(spark, lambda c: split_literal(c, sep), ["a\tb\t", "a\\tb"])
    assert got == [["a", "b", ""], ["a\\tb"]]


def test_literal_split_empty_separator_splits_whitespace(spark):
    got = _apply(spark, lambda c: split_literal(c, ""), ["a b", "a  b "])
    assert got == [["a", "b"], ["a", "", "b", ""]]


def test_literal_split_empty_input_gives_no_tokens(spark):
    assert _apply(spark, lambda c: split_literal(c, "|"), ["", None]) == [[], None]


def test_literal_separator_containing_quote_end(spark):
    sep = "\\E"
    assert quote_literal(sep).startswith("\\Q")
    got = _apply(spark, lambda c: split_literal(c, sep), ["a\\Eb"])
    assert got == [["a", "b"]]


@pytest.mark.parametrize("text,want", [
    ("\\u0001", "\u0001"), ("\\\\", "\\"), ("|", "|"), ("\\101", "101"), ("\\n\\r", "\n\r"), ("a\\", "a\\"),
    ("\\x", "x"), ("\\u0041b", "Ab"),
])
def test_decode_escapes(text, want):
    assert decode_escapes(text) == want


@pytest.mark.parametrize("text", ["\\u00", "\\uu0041", "\\uZZZZ"])
def test_decode_escapes_rejects_bad_unicode(text):
    with pytest.raises(ValueError):
        decode_escapes(text)


@pytest.mark.parametrize("text,want", [
    ("a,b,a", ["a", "b"]), ("a,b,", ["a", "b"]), (",a", ["", "a"]), ("", [""]), (",", []),
    ("a, b", ["a", " b"]), ("test", ["test"]),
])
def test_topic_set_like_string_split(text, want):
    assert topic_set(text) == want


def test_empty_separator_uses_java_whitespace(spark):
    # unit separator and em space are whitespace to the JVM; no-break space is not
    got = _apply(spark, lambda c: split_literal(c, ""), ["a\u001fb", "a\u2003b", "a\u00a0b"])
    assert got == [["a", "b"], ["a", "b"], ["a\u00a0b"]]
