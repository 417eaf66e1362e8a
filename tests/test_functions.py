import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from regflow.functions import dates, numbers, text
from regflow.schema import MEASURES, OEM, RTO, STATE, snake


def values(spark, column, rows, schema="x string"):
    frame = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in frame.select(column.alias("v")).collect()]


TEXTS = [
    "MOTOR-CAR (LMV)", "été²_a-b 日本", "  two  spaces\t", "", "&&", "a_b.c/d", "x y",
    "A & B", "UT of DNH and DD",
]


def test_special_characters_match_python(spark):
    x = F.col("x")
    assert values(spark, text.remove_special(x), TEXTS) == [re.sub(r"\W+", " ", t) for t in TEXTS]
    assert values(spark, text.state_folder(x), TEXTS) == [
        re.sub(r"[^a-zA-Z\s]", " ", t).rstrip() for t in TEXTS
    ]
    assert values(spark, text.class_key(x), TEXTS) == [
        re.sub(r"\W+", " ", t).strip() for t in TEXTS
    ]
    assert values(spark, text.strip(x), TEXTS) == [t.strip() for t in TEXTS]
    assert values(spark, text.artifact_label(x), [*TEXTS, None, "z" * 90]) == [
        (re.sub(r"[^A-Za-z0-9._-]+", "_", t or "").strip("_") or "unknown")[:80]
        for t in [*TEXTS, None, "z" * 90]
    ]


LABELS = [
    "RAJPUR ROAD/VIU BURARI - DL51( 08-APR-2016 )", "A - B - HR2( x )", "Bad Label",
    "two\nlines - X1(", " - C9(", "low - hr2(",
]


def test_office_labels(spark):
    x = F.col("x")
    assert values(spark, text.office_folder(x), LABELS) == [
        "RAJPUR ROADVIU BURARI_DL51", "A - B_HR2", None, None, "_C9", None,
    ]
    assert values(spark, text.office_code(x), LABELS) == ["DL51", "HR2", None, None, "C9", None]
    folders = ["a_b_c", "plain", "tail_", "_x"]
    assert values(spark, text.office_folder_name(x), folders) == ["a_b", "plain", "tail", ""]
    assert values(spark, text.office_folder_code(x), folders) == ["c", "", "", "x"]
    codes = ["a - HR2( x", "a - HR29( x", "a - HR260( x"]
    assert values(spark, text.label_has_code(x, F.lit("HR2")), codes) == [True, False, False]


def test_report_paths(spark):
    x, year, month = F.col("x"), F.lit(2026), F.lit("JUN")
    states = ["Andaman & Nicobar Island"]
    assert values(spark, text.report_path(STATE, "r", x, year, month), states) == [
        "r/Andaman   Nicobar Island/2026/JUN/reportTable.xlsx"
    ]
    path = text.report_path(RTO, "r", F.lit("Goa"), year, month, x)
    assert values(spark, path, ["A/B - G1( )", "Bad"]) == [
        "r/Goa/AB_G1/2026/JUN/reportTable.xlsx", None,
    ]
    path = text.report_path(OEM, "r", F.lit("Goa"), year, month, x)
    assert values(spark, path, ["BUS(HEAVY)"]) == ["r/Goa/BUS HEAVY /2026/JUN/reportTable.xlsx".replace(" /", "/")]


def test_dates(spark):
    x = F.col("x")
    assert values(spark, dates.report_date_text(x), ["1/JUN/2026", None]) == ["01/06/2026", None]
    with pytest.raises(Exception):
        values(spark, dates.report_date_text(x), ["1/XXX/2026"])
    assert values(spark, dates.month_number(x), ["JUN", "jun", "", None]) == [6, None, None, None]
    assert values(spark, dates.report_date(x), ["1/6/2026", "01/06/2026 "]) == [date(2026, 6, 1)] * 2
    with pytest.raises(Exception):
        values(spark, dates.report_date(x), ["31/02/2026"])
    assert values(spark, dates.try_report_date(x), ["31/02/2026", "x"]) == [None, None]
    assert values(spark, dates.month_label(x), [" jul ", None]) == ["JUL", None]
    with pytest.raises(Exception, match="no such month"):
        values(spark, dates.month_label(x), ["JULY"])
    day = dates.previous_month_start(F.to_date(x))
    assert values(spark, day, ["2026-07-17", "2026-01-31"]) == [date(2026, 6, 1), date(2025, 12, 1)]
    assert values(spark, dates.month_of(day), ["2026-07-17"]) == ["JUN"]


def test_counts(spark):
    x = F.col("x")
    assert values(spark, numbers.parse_count(x), ["1,234", "7", None]) == [1234, 7, None]
    for bad in ("5.0", "abc"):
        with pytest.raises(Exception):
            values(spark, numbers.parse_count(x), [bad])
    mixed = ["1,234", "5.0", "abc", " 7 ", "-3", "99999999999"]
    want = [1234, None, None, 7, -3, None]
    assert values(spark, numbers.try_parse_count(x), mixed) == want
    assert values(spark, F.expr(numbers.try_parse_count_sql("x")), mixed) == want
    assert values(spark, F.expr(numbers.parse_count_sql("x")), ["1,234"]) == [1234]


def test_small_text_functions(spark):
    x = F.col("x")
    assert values(spark, text.blank_to_null(x), ["  ", " a ", "", "\t"]) == [None, "a", None, "\t"]
    assert values(spark, text.varchar(x, 3), ["abcdef", "ab"]) == ["abc", "ab"]
    titles = ["Vehicle Class Wise Fuel Data  of A & B (JUN,2015) z", "Other"]
    got = [values(spark, text.history_title(x, p), titles) for p in ("state", "month", "year")]
    assert got == [["A & B", None], ["JUN", None], ["2015", None]]
    context = [({"b": "2", "a": "1", "c": None, "d": ""},), ({},)]
    assert values(spark, text.context_text(x), context, "x map<string,string>") == ["a=1, b=2", ""]


def test_first_message_line(spark):
    messages = ["Message: \n  \n#0 frame\r\n real text \nmore", "Stacktrace:\n#1", None, "one\x85two"]
    got = values(spark, text.first_message_line(F.lit("ValueError"), F.col("x")), messages)
    assert got == [
        "ValueError: real text", "ValueError: ValueError", "ValueError: ValueError",
        "ValueError: one",
    ]


def test_blocked_reason(spark):
    rows = [
        (" Access Forbidden ", "x"), ("Home", "<p>Access Forbidden</p>"),
        ("Home", "You don't have permission to access this page"), ("Home", "ok"), (None, None),
    ]
    got = values(spark, text.blocked_reason(F.col("t"), F.col("h")), rows, "t string, h string")
    assert got == [
        "page_title_access_forbidden", "page_source_contains_access_forbidden",
        "page_source_contains_you_don_t_have_permission_to_access_this_page", None, None,
    ]


def test_output_names():
    assert snake("PETROL(E20)/HYBRID/CNG") == "petrol_e20_hybrid_cng"
    assert len(MEASURES) == 37 and MEASURES[0] == "bio_cng_bio_gas" and MEASURES[-1] == "total"
    assert [len(g.columns) for g in (STATE, RTO, OEM)] == [46, 48, 47]


def test_month_of_dates_and_null(spark):
    days = spark.sql("select explode(array(date'2026-01-31', date'0999-12-01', cast(null as date))) as d")
    assert [r[0] for r in days.select(dates.month_of(F.col("d"))).collect()] == ["JAN", "DEC", None]
