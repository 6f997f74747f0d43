"""Number, date, word and nil grammars on hand-made boundary rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendtable.functions import parsing as P

INF = float("inf")
NUMBERS = {
    " 12 ": 12.0, "+3": 3.0, ".5": 0.5, "5.": 5.0, "1e3": 1000.0, "1E5": 100000.0, "12\n": 12.0,
    "inf": INF, "INF": INF, "+Inf": INF, "infinity": INF, "-Infinity": -INF, "1e-400": 0.0, "007": 7.0,
    " inf ": None, "nan": None, "1e400": None, "-1e400": None, "1_000": None, "1,000": None, "0x10": None,
    "1d": None, "1f": None, "": None, "1e": None, "--1": None, "1 2": None, "True": None, "1" * 310: None,
}
DATES = {
    "2024-01-02": (2024, 1, 2), "2024-1-2": (2024, 1, 2), "2024/1/2": (2024, 1, 2), "2024.01.02": (2024, 1, 2),
    "01/02/2024": (2024, 1, 2), "13/02/2024": (2024, 2, 13), "13-02-2024": (2024, 2, 13),
    "13.02.2024": (2024, 2, 13), "Jan 5 2024": (2024, 1, 5), "January 5, 2024": (2024, 1, 5),
    "JAN 5 2024": (2024, 1, 5), "sept 5 2024": (2024, 9, 5), "5 January 2024": (2024, 1, 5),
    "5-Jan-2024": (2024, 1, 5), "Jan 2024": (2024, 1, 1), "20240102": (2024, 1, 2), "01-2024": (2024, 1, 1),
    "2024": (2024, 1, 1), "2024-01": (2024, 1, 1), " 2024-01-02 ": (2024, 1, 2),
    "2024-01-02 03:04": (2024, 1, 2, 3, 4), "2024-01-02T03:04:05Z": (2024, 1, 2, 3, 4, 5),
    "2024-01-02T03:04:05+02:00": (2024, 1, 2, 1, 4, 5), "01/02/2024 3:04 PM": (2024, 1, 2, 15, 4),
    "2024-02-30": None, "02/30/2024": None, "2024-13-01": None, "12:30": None, "now": None, "today": None,
    "abc": None, "5": None, "1.5": None, "": None, "yes": None, "janember 5 2024": None, "0001-01-01": None,
    "2300-01-01": None, "12:30 2024-01-05": (2024, 1, 5, 12, 30), "10:30 Jan 5, 2024": (2024, 1, 5, 10, 30),
    "10:30PM 1/5/2024": (2024, 1, 5, 22, 30), "Fri Jan  5 10:30:00 2024": (2024, 1, 5, 10, 30), "2024,01,05": (2024, 5, 1),
    "2024-1-5 1:2": (2024, 1, 5, 1, 2), "20240105 1030": (2024, 1, 5, 10, 30), "2024-01-05 10h30": (2024, 1, 5, 10, 30),
    "Jan-05-2024": (2024, 1, 5), "5th of January 2024": (2024, 1, 5), "2024-01-05 10:30:00 EST": (2024, 1, 5, 10, 30),
    "2024-01-05-10:30": (2024, 1, 5, 10, 30), "2024-01-05 10:30 UTC+3": (2024, 1, 5, 13, 30), "24-Jan-5": (2005, 1, 24),
    "Friday, January" + " " * 90 + "5, 2024": (2024, 1, 5), "2024-01-05T10:30Z": (2024, 1, 5, 10, 30), "Jan Jan 2024": None,
    "2024-01-05 13:30 PM": None, "2024-01-05 24:00": None, "2024-01-05 10:61": None, "2024Jan05": None, "2024005": None,
    "(2024-01-05)": None, "the 5th of January 2024": None, "2024-01-05 noon": None, "31/12": None, "Jan 5": None, "13-2024": None,
}
# forms of which pandas may tell, whatever the day it is
DATE_PARTS = ["2024-01-05", "5 Jan 2024", "Jan. 5, 2024", "1/5/2024", "13/2/24", "5th of May, 2024", "20240105", "2024 05 06", "Sept 5 24", "31.12.1999", "2024-02-30"]
CLOCK_PARTS = ["", "10:30", "1:2:3", "10:30:15.25", "10:30 PM", "0:30am", "12 a.m.", "10h30", "10 h 30 m 15 s", "10:30Z", "10:30 +0530", "10:30:00 GMT", "25:00", "10:30 PST", "13:00 pm"]
WORDS = {
    "T": True, " true ": True, "YES": True, "y": True, "1": True, "f": False, "False": False, "no\t": False,
    "N": False, "0": False, "maybe": None, "": None, "10": None,
}
NIL = {None: True, "": True, " \t\n": True, "　\xa0": True, "NaN": True, "nan": True, " nan": False,
       "0": False, "None": False}


def apply(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(column.alias("r")).collect()]


def test_numbers(spark):
    assert apply(spark, NUMBERS, P.to_number("v")) == list(NUMBERS.values())


def test_integers_keep_all_digits(spark):
    got = apply(spark, ["9007199254740993", "1e3", "5.", "-7", "x", "9" * 19], P.to_integer("v"))
    assert got == [9007199254740993, 1000, 5, -7, None, None]


def test_dates(spark):
    got = apply(spark, DATES, P.to_datetime("v").cast("timestamp_ntz"))
    assert got == [dt.datetime(*d) if d else None for d in DATES.values()]


def test_dates_as_pandas(spark):
    import warnings

    import pandas as pd

    values = [f"{d} {c}".strip() for d in DATE_PARTS for c in CLOCK_PARTS] + [f"{c} {d}".strip() for d in DATE_PARTS for c in CLOCK_PARTS[:9]]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        want = [pd.to_datetime(pd.Series([v]), format="mixed", errors="coerce", utc=True).iloc[0] for v in values]
    got = apply(spark, values, P.to_datetime("v").cast("timestamp_ntz"))
    differ = {v: (g, w) for v, g, w in zip(values, got, want) if g != (None if pd.isna(w) else w.tz_localize(None).to_pydatetime())}
    assert differ == {}


def test_no_text_is_too_long(spark):
    long = "5 January 2024" + " " * 5000 + "10:30"
    junk = ["1 " * 20_000, "a1" * 20_000, "1:" * 20_000, "Jan " * 10_000 + "1 2024", "9" * 20_000]
    assert apply(spark, [long, *junk], P.to_datetime("v").cast("timestamp_ntz")) == [dt.datetime(2024, 1, 5, 10, 30), *[None] * 5]


def test_boolean_words(spark):
    assert apply(spark, WORDS, P.to_boolean("v")) == list(WORDS.values())


def test_nil_text(spark):
    assert apply(spark, NIL, P.is_nil("v", T.StringType())) == list(NIL.values())


def test_nil_is_not_empty(spark):
    assert apply(spark, ["", " ", "x"], F.col("v") == "") == [True, False, False]


def test_currency(spark):
    got = apply(
        spark, ["$1,234.50", "€7", "(5)", "5 USD", "", "₹1,00,000"], P.to_number(P.strip_currency_sql("v"))
    )
    assert got == [1234.5, 7.0, None, None, None, 100000.0]


@pytest.mark.parametrize(
    "path, stem, parent",
    [("/a/b/listings.csv", "listings", "b"), ("x.tar.gz", "x.tar", ""), ("/d/.hidden", ".hidden", "d")],
)
def test_paths(spark, path, stem, parent):
    assert apply(spark, [path], P.path_stem("v")) == [stem]
    assert apply(spark, [path], P.path_parent("v")) == [parent]


def test_iso_format(spark):
    got = apply(
        spark, ["2024-01-02 03:04:05", "2024-01-02 03:04:05.25"], P.iso_format(F.col("v").cast("timestamp"))
    )
    assert got == ["2024-01-02T03:04:05", "2024-01-02T03:04:05.250000"]


def test_title_label(spark):
    assert apply(spark, ["unit_price_eur"], P.title_label("v")) == ["Unit Price Eur"]
