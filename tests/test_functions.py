from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.functions import dates, names, numbers, strings
from tests.helpers import apply, frame, text_frame

INF = float("inf")


def test_lenient_number(spark):
    texts = [" 12 ", "1e3", "inf", "-Infinity", "+.5", "7.", "nan", "", "-", "1,000", "1_000",
             "0x10", "1d", "1f", "\t3\n", "\xa04", "1e400", "1e-400", None]
    assert apply(spark, numbers.num("t"), *texts) == [
        12.0, 1000.0, INF, -INF, 0.5, 7.0, None, None, None, None, None, None, None, None, 3.0,
        None, None, 0.0, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=40))
def test_every_printed_float_is_read_back(spark, values):
    assert apply(spark, numbers.num("t"), *[repr(v) for v in values]) == values


def test_nan_is_missing_and_dropped(spark):
    df = frame(spark, "x double", (float("nan"),), (1.0,), (None,), (-1.0,))
    from terravane.operators.columns import to_numbers
    from terravane.operators.filters import keep_non_negative

    assert keep_non_negative(to_numbers(df, "x"), "x").collect() == [(1.0,)]


def test_integral(spark):
    texts = ["2020", "2020.0", "1e3", "2020.5", "inf", "x", "1e30"]
    assert apply(spark, numbers.integral(numbers.num("t")), *texts) == [
        2020, 2020, 1000, None, None, None, None]


def test_sentinels_and_bounds(spark):
    assert apply(spark, numbers.missing_if("t", ["-", "N/A", ""]), "-", "N/A", "", "5", None) == [
        None, None, None, "5", None]
    x = numbers.num("t")
    assert apply(spark, numbers.null_below(x, 0), "-1", "0", "2", None) == [None, 0.0, 2.0, None]
    assert apply(spark, numbers.null_outside(x, (-90, 90)), "-91", "-90", "90", "90.1") == [
        None, -90.0, 90.0, None]


def test_coordinates(spark):
    assert apply(spark, numbers.latitude("t"), "57.05N", "23.1s", "12.5", "N", None, "-5S") == [
        57.05, -23.1, 12.5, None, None, None]
    assert apply(spark, numbers.longitude("t"), "10.33E", "0.13W", "7w") == [10.33, -0.13, -7.0]


def test_strip_and_quotes(spark):
    assert apply(spark, strings.strip("t"), "\t x \n", "\xa0　y\x1f", None) == ["x", "y", None]
    assert apply(spark, strings.strip_quotes("t"), "'South Africa'", "''x'", "a'b") == [
        "South Africa", "x", "a'b"]


def test_title_case_equals_python(spark):
    texts = ["washington d.c.", "guinea-bissau", "côte d'ivoire", "ÉTÉ 2x y3z", "a--b", ""]
    assert apply(spark, strings.title_case("t"), *texts) == [t.title() for t in texts]


def test_normalize_text(spark):
    assert apply(spark, strings.normalize_text("t"), " NaN ", "none", "null", "  ", " Flood ",
                 None) == [None, None, None, None, "flood", None]


def test_iso_shape_preview_keywords(spark):
    assert apply(spark, strings.iso_code_or_null("t"), "FRA", "fra", "FR", "FRAN", None) == [
        "FRA", None, None, None, None]
    assert apply(spark, strings.preview("t"), "é" * 60, "short", None) == ["é" * 50, "short", "N/A"]
    assert apply(spark, strings.contains_any("t", ["Paris", "air quality"]),
                 "In PARIS", "comparison", "Air Quality!", "parish", "none") == [
        True, True, True, True, False]


def test_exclusion_is_null_safe(spark):
    df = text_frame(spark, "Kosovo", " kosovo ", None, "Peru")
    loose = df.filter(strings.is_not_entity("t", "kosovo", strings.strip_lower))
    assert [r.t for r in loose.orderBy("_i").collect()] == [None, "Peru"]
    strict = df.filter(strings.is_not_entity("t", "Kosovo"))
    assert [r.t for r in strict.orderBy("_i").collect()] == [" kosovo ", None, "Peru"]


def test_one_declared_date_format(spark):
    got = apply(spark, dates.lenient_timestamp("t"), "2020-01-01", "01/02/2020", "2020-13-01",
                " 2020-01-02 ", None)
    assert got == [datetime(2020, 1, 1), None, None, datetime(2020, 1, 2), None]
    got = apply(spark, dates.lenient_timestamp("t", dates.DATE_TIME_FORMAT), "2020-01-01",
                "2020-01-01 10:00:00", "2020-01-01 10:00:00+02:00")
    assert got == [datetime(2020, 1, 1), datetime(2020, 1, 1, 10), datetime(2020, 1, 1, 8)]


def test_strict_date_fails(spark):
    assert apply(spark, dates.strict_timestamp("t"), "2020-01-01", None) == [
        datetime(2020, 1, 1), None]
    with pytest.raises(Exception, match="not in format"):
        apply(spark, dates.strict_timestamp("t"), "01/02/2020")


def test_iso_instant(spark):
    assert apply(spark, dates.iso_instant("t"), "2025-05-26T13:46:58.478Z",
                 "2025-05-26T13:46:58+02:00", "12:30", "soon") == [
        datetime(2025, 5, 26, 13, 46, 58, 478000), datetime(2025, 5, 26, 11, 46, 58), None, None]


PARTS = [("2020", None, None), ("2020", "2", None), ("2020", "13", "1"), ("2020", "2", "30"),
         (None, "1", "1"), ("2020.0", " 3 ", "x"), ("inf", "1", "1")]


def test_date_from_parts(spark):
    def run(mode):
        made = dates.date_from_parts(F.col("y"), F.col("m"), F.col("d"), mode).cast("date")
        return apply(spark, made, *PARTS, columns="y m d")

    assert run("start") == [date(2020, 1, 1), date(2020, 2, 1), None, None, None,
                            date(2020, 3, 1), None]
    assert run("end")[:2] == [date(2020, 12, 31), date(2020, 2, 29)]
    with pytest.raises(ValueError):
        run("middle")


def test_landed_names(spark):
    df = frame(spark, "`AQI Value` int, `Avg Temp (°C)` int", (1, 2))
    assert names.sanitize_columns(df).columns == ["AQI_Value", "Avg_Temp___C_"]
    clash = frame(spark, "`a b` int, `a-b` int", (1, 2))
    with pytest.raises(ValueError):
        names.sanitize_columns(clash)
    assert names.sanitize_columns(clash, "suffix").columns == ["a_b_0", "a_b_1"]


def test_snake_case_names(spark):
    df = frame(spark, "`No. Injured` int, `A b` int, `a  b` int, `%%` int", (1, 2, 3, 4))
    assert names.snake_case_columns(df).columns == ["no_injured", "a_b_0", "a_b_1", "unnamed_col"]
