import math
import sys
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridwarden.functions import columns, dates, ids, numbers, text


def column_of(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def evaluate(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


IDS = [" 0a:27:78:a3:1b:e3 ", "0A27 78A31BE3", "xyz", None, "0a2778a31be3", "\t0a2778a31be3 ", "0a:27:78:a3:1b:e", ""]


def test_id_forms(spark):
    df = column_of(spark, IDS)
    c = F.col("c")
    bare = "0A2778A31BE3"
    assert evaluate(df, ids.clean_id(c)) == [bare, "0A27 78A31BE3", "XYZ", None, bare, bare, "0A2778A31BE", ""]
    assert evaluate(df, ids.clean_id(c, drop_spaces=True)) == [bare, bare, "XYZ", None, bare, bare, "0A2778A31BE", ""]
    assert evaluate(df, ids.canonical_id(c)) == [bare, None, None, None, bare, bare, None, None]


NUMBERS = ["abc", "", "-3", "5d", None, " 5 ", "1e3", "+.5", "1.", "0x10", "nan", "inf", "-Infinity", "1_0", "7f", "1 2"]


def test_text_numbers_agree_with_pandas(spark):
    df = column_of(spark, NUMBERS)
    read = pd.to_numeric(pd.Series(NUMBERS, dtype=object), errors="coerce")
    assert evaluate(df, numbers.to_number(df, "c")) == [None if math.isnan(v) else v for v in read]
    assert evaluate(df, numbers.number_or_zero(df, "c")) == read.fillna(0).tolist()
    assert evaluate(df, numbers.non_negative(df, "c")) == read.fillna(0).clip(lower=0).tolist()
    kept = [None if math.isnan(v) else v for v in read.clip(lower=0)]
    assert evaluate(df, numbers.non_negative_or_null(df, "c")) == kept


def test_typed_numbers_keep_their_type(spark):
    df = column_of(spark, [2**60 + 1, -5, None], "bigint")
    assert evaluate(df, numbers.non_negative(df, "c")) == [2**60 + 1, 0, 0]
    df = column_of(spark, [float("nan"), -1.5, None, 2.5], "double")
    assert evaluate(df, numbers.non_negative(df, "c")) == [0, 0, 0, 2.5]
    assert evaluate(df, numbers.non_negative_or_null(df, "c")) == [None, 0, None, 2.5]
    df = column_of(spark, [True, False, None], "boolean")
    assert evaluate(df, numbers.number_or_zero(df, "c")) == [1, 0, 0]


def test_read_rate(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 5, 0), (2, 12, 10), (3, None, 3)], "i int, r int, e int")
    assert evaluate(df, numbers.ratio_or_zero(F.col("r"), F.col("e"))) == [0, 0, 1.2, 0]


def test_times_and_days(spark):
    values = ["2026-02-01 03:04:05.25", "2026-02-01T01:00:00+02:00", "bad", None, "2026-02-30", "01.02.2026 10:00"]
    df = column_of(spark, values)
    seconds = evaluate(df, F.unix_micros(dates.to_utc(df, "c")))
    at = pd.Timestamp("2026-02-01 03:04:05.25", tz="UTC").value // 1000
    offset = pd.Timestamp("2026-01-31 23:00", tz="UTC").value // 1000
    assert seconds == [at, offset, None, None, None, None]
    german = evaluate(df, dates.to_utc(df, "c", ["dd.MM.yyyy HH:mm"]).cast("string"))
    assert german[5] == "2026-02-01 10:00:00"
    assert evaluate(df, dates.day_text(df, "c"))[:5] == ["2026-02-01", "2026-02-01", None, None, None]


def reference_normalize(value):
    value = ("" if value is None else value).strip().lower()
    value = "".join(c for c in unicodedata.normalize("NFKD", value) if c.isascii())
    return " ".join([""] * (value[:1].isspace()) + value.split() + [""] * (value[-1:].isspace())) if value else ""


TEXTS = [
    " Fehler  behoben ", "Kein Fehler gefunden", "Straße", None, "", "\tBehöben\n\nneu ", "ﬁx ½ ①②", "Ⅷ ㎏ №", "日本 x",
    " a b ", "été", "𝐀𝟙 ", "x 　y", "ÀÉÎÕÜ ç ñ", "’quote’", "a\x1cb",
]


def test_normalize_text(spark):
    df = column_of(spark, TEXTS)
    assert evaluate(df, text.normalize_text(F.col("c"))) == [reference_normalize(t) for t in TEXTS]


def test_folding_of_every_character(spark):
    """The table is complete: all characters that leave ASCII behind, and a share of the others."""
    chars, folded = [], []
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        left = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if c.isascii())
        if left or code % 997 == 0:
            chars.append(chr(code))
            folded.append(left)
    df = column_of(spark, [f"<{c}>" for c in chars])
    assert evaluate(df, text.fold_to_ascii(F.col("c"))) == [f"<{f}>" for f in folded]


def test_strip_knows_all_white_space(spark):
    values = ["  x y 　", "\x1c\x85x ", "​x", " "]
    df = column_of(spark, values)
    assert evaluate(df, text.strip(F.col("c"))) == [v.strip() for v in values]


def test_flags(spark):
    df = column_of(spark, ["fehler behoben", "FIXED", None, "fixed"])
    assert evaluate(df, text.is_one_of(F.col("c"), text.FIXED_OUTCOMES)) == [1, 0, 0, 1]
    df = column_of(spark, ["", "n a", "netzteil", "none"])
    assert evaluate(df, text.part_replaced(F.col("c"))) == [0, 0, 1, 0]
    df = column_of(spark, [" Schlecht\n", "gut", None, "SCHLECHT"])
    assert evaluate(df, text.binary_target(F.col("c"))) == [1, 0, 0, 1]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, "x", float("nan")), (2, None, None)], "a int, b string, c double")
    assert columns.missing_columns(df, ["b", "z", "y"]) == ["y", "z"]
    with pytest.raises(ValueError, match=r"\['y', 'z'\]"):
        columns.require_columns(df, ["z", "a", "y"], "Table")
    assert columns.first_alias(df, ["q", "c", "a"]) == "c"
    assert columns.first_alias(df, ["q"]) is None
    assert columns.numeric_columns(df, ["a"]) == ["c"]
    assert columns.drop_all_null_columns(df).columns == ["a", "b"]
    assert [r["z"] for r in columns.add_missing_as_zero(df, ["a", "z"]).collect()] == [0.0, 0.0]
    assert [r["c"] for r in columns.fill_numeric(df, ["c", "nope"]).collect()] == [0.0, 0.0]


def test_null_tokens_and_inference(spark):
    df = spark.createDataFrame([("1", "NA", "0012"), ("2.5", "x", "7"), (None, "None", "n/a")], "a string, b string, k string")
    out = columns.infer_numeric(columns.null_tokens(df), keep_text=["k"])
    assert dict(out.dtypes) == {"a": "double", "b": "string", "k": "string"}
    assert [tuple(r) for r in out.collect()] == [(1.0, None, "0012"), (2.5, "x", "7"), (None, None, None)]
