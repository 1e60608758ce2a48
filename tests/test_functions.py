from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import scalars as S

RANGES = [
    ("27 Sep _ 01 Oct 15", None, "2015-09-27", "2015-10-01"), ("27 Sep 15-01 Oct 15", None, "2015-09-27", "2015-10-01"), ("27 Sep 2015 - 1 Oct 2015", None, "2015-09-27", "2015-10-01"),
    ("30 Dec _ 02 Jan 16", None, "2015-12-30", "2016-01-02"), ("8_12 July 2015", None, "2015-07-08", "2015-07-12"), ("8-12 July 2015", None, "2015-07-08", "2015-07-12"), ("8 to 12 July 2015", None, "2015-07-08", "2015-07-12"),
    ("8-12 July", (date(2015, 4, 1), date(2015, 9, 30)), "2015-07-08", "2015-07-12"), ("8/9 July 2015", None, "2015-07-08", "2015-07-09"), ("08/07/2015-09/07/2015", None, "2015-07-08", "2015-07-09"),
    ("not a date", None, None, None), ("27 Sep _ 01 Vember 15", None, None, None), ("31-32 July 2015", None, None, None),
]
DAYS = [
    ("1st March 2020", "2020-03-01"), ("03/04/68", "2068-04-03"), ("03/04/69", "1969-04-03"), ("31.12.1999", "1999-12-31"), ("1.2.99", "1999-02-01"), ("2020.1.5", "2020-01-05"), ("01/022020", "2020-02-01"), ("2020 1 5", "2020-01-05"),
    ("2020-1 5", "2020-01-05"), ("Monday, 3 February 2020", "2020-02-03"), ("February 3, 2020", "2020-02-03"), ("43831", "2020-01-01"), ("2020-02-30", None), ("n/a", None), ("??5 Feb 2020*", "2020-02-05"), ("2020-05-06T10:00:00", "2020-05-06"), ("5-Feb-20", "2020-02-05"), (None, None),
]


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


def test_day_ranges(spark):
    rows = [(i, t, h[0] if h else None, h[1] if h else None) for i, (t, h, _, _) in enumerate(RANGES)]
    got = spark.createDataFrame(rows, "i int, t string, a date, b date").select("i", D.parse_day_range(F.col("t"), F.col("a"), F.col("b")).alias("r")).collect()
    assert {r.i: (r.r.start, r.r.end) if r.r else (None, None) for r in got} == {i: x[2:] for i, x in enumerate(RANGES)}


def test_days(spark):
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DAYS)], "i int, t string").select("i", D.parse_date(F.col("t")).alias("r")).collect()
    assert {r.i: r.r for r in got} == {i: x for i, (_, x) in enumerate(DAYS)}


def test_serials(spark):
    assert one(spark, 43831.7, D.parse_serial, "double") == "2020-01-01"
    assert one(spark, float("nan"), D.parse_serial, "double") is None


def test_months_and_years(spark):
    assert one(spark, "Septeber", D.month_number) == 9
    assert one(spark, "Marchy", D.month_number) is None
    start, end = F.lit(date(2019, 10, 1)), F.lit(date(2020, 3, 31))
    assert one(spark, 11, lambda c: D.infer_year(c, start, end), "int") == 2019
    assert one(spark, 2, lambda c: D.infer_year(c, start, end), "int") == 2020
    assert one(spark, 2, lambda c: D.infer_year(c, None, end), "int") is None
    r = one(spark, "Dec", lambda c: D.parse_month_value(c, start, end))
    assert (r.start, r.end) == ("2019-12-01", "2019-12-31")
    r = one(spark, "Nov to Feb", lambda c: D.parse_month_span(c, F.lit(2020)))
    assert (r.start, r.end) == ("2019-11-01", "2020-02-29")
    assert one(spark, "05/02/3020", lambda c: D.parse_year_hint_date(c, start, end)) == "2020-02-05"
    assert one(spark, "020-02-05", lambda c: D.parse_year_hint_date(c, F.lit(date(2020, 1, 1)), end)) == "2020-02-05"
    assert one(spark, "0202-02-05", lambda c: D.parse_year_hint_date(c, start, end)) == "2020-02-05"
    assert one(spark, "12 Nov", lambda c: D.parse_partial_date(c, start, end)) == "2019-11-12"
    r = one(spark, "March 2020", lambda c: D.parse_day_or_month(c, start, end))
    assert (r.kind, r.start, r.end) == ("month", "2020-03-01", "2020-03-31")


def test_tokens(spark):
    assert one(spark, "2020-02", lambda c: D.date_token(c, True)) == date(2020, 2, 29)
    assert one(spark, "2020", D.date_token) is None
    assert one(spark, "2020", D.bad_token) is False
    assert one(spark, "2020-02-31", D.bad_token) is True


@pytest.mark.parametrize(
    "value, f, expected",
    [
        (" N/A ", S.clean_string, None), ("  x ", S.clean_string, "x"), ("£1,234.50", S.parse_amount, 1234.5), ("1d", S.parse_amount, None), ("1_000", S.parse_amount, None), ("$1.5", S.parse_thousands, 1500), ("abc", S.parse_thousands, None),
        ("12345", S.normalize_gb_coh, "00012345"), (" sc123456", S.normalize_gb_coh, "SC123456"), ("XX1", S.normalize_gb_coh, None), ("RS007853Z", S.is_gb_coh, True), ("", S.is_gb_coh, False),
        ("GB-COH-123", S.id_weight, 4), ("Q42", S.id_weight, 3), ("NK-abc", S.id_weight, 2), ("x", S.id_weight, 1), ("Smith and Jones and sons", S.is_complex, True), ("a, b", S.is_complex, False), (" Consultant Lobbyist", S.normalize_role, "lobbyist"), (" ", S.normalize_role, None),
        ("a  b", S.strip_html, "a  b"), ("<p>a<b>b</b> &amp; c</p>", S.strip_html, "a b & c"), ("plain", S.fingerprint, None),
    ],
)
def test_scalars(spark, value, f, expected):
    import hashlib

    expected = hashlib.sha1(value.encode()).hexdigest() if f is S.fingerprint else expected
    assert one(spark, value, f) == expected


def test_ids_and_properties(spark):
    df = spark.createDataFrame([("a", None, "01-2"), (None, None, None)], "x string, y string, n string")
    got = df.select(S.make_id("p", "x", "y").alias("h"), S.make_id("p", "x", reg_nr="n", register="GB-COH").alias("r")).collect()
    assert got[0].r == "GB-COH-012" and got[0].h.startswith("p-") and got[1].h is None and got[1].r is None
    with pytest.raises(ValueError):
        S.make_id("p", "x", reg_nr="n")
    items = spark.createDataFrame([(["name= A=B ", "alias=x", "alias=y"],), (["name"],), (["=x"],), ([],)], "i array<string>")
    got = [r.p for r in items.select(S.parse_properties("i").alias("p")).collect()]
    assert got[0].properties == {"name": ["A=B"], "alias": ["x", "y"]} and [g.error for g in got] == [None, "missing =", "empty key", "no properties"]


@pytest.mark.parametrize(
    "value, f, expected",
    [
        ("\u00a0N/A\u2003", S.clean_string, None), ("\x1c x\u3000y\u2028", S.clean_string, "x\u3000y"), ("a\u00a0\u2003b\x85", S.normalize_ws, "a b"), ("\u00a0£1,5\u2009", S.parse_amount, 15.0), ("\u00a0sc123456\u00a0", S.normalize_gb_coh, "SC123456"),
        ("\u2003Consultant Lobbyist\u00a0", S.normalize_role, "lobbyist"), ("\u00a0" * 20 + "a, b", S.is_complex, False), ("x&#8217;s &#x1F600;&#X41", S.strip_html, "x’s 😀A"), ("&#38;lt; &amp;#65; &#; &#x; &#0; &#1114112; &#55296;", S.strip_html, "&lt; &#65; &#; &#x; \ufffd \ufffd \ufffd"),
        ("<p>&nbsp;a&#160;</p>", S.strip_html, "a"),
    ],
)
def test_white_space_and_references(spark, value, f, expected):
    assert one(spark, value, f) == expected


def test_dates_between_odd_spaces(spark):
    assert one(spark, "1\u00a0January\u20032020\u3000", D.parse_date) == "2020-01-01"
    assert one(spark, "\u00a0March\u00a0", D.month_number) == 3


def test_folding(spark):
    from ledgerloom.operators.search import fold, plain_letters

    assert one(spark, "ŁÓDŹ Őrség ĀāĞğ İstanbul Weißæ Þór Ångström é ŉ", fold) == "lodz orseg aagg istanbul weissae thor angstrom e ŉ"
    assert plain_letters()["ș"] == "s" and plain_letters()["ế"] == "e" and "ß" not in plain_letters()
