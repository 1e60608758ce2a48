"""Messy dates: Column to Column.

Texts that are dates come out as ISO strings; ranges as struct<start,end> of ISO
strings; hints (start, end) are DATE columns or None.  A date is built as ISO text and cast
with try_cast, so an impossible day is null and never an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import clean_string, normalize_ws, strip

# Month names and the misspellings that are understood.
MONTHS = {
    "jan": 1, "january": 1, "feb": 2, "february": 2, "februrary": 2, "mar": 3, "march": 3, "marc": 3, "apr": 4, "april": 4, "may": 5,
    "jun": 6, "june": 6, "junee": 6, "jul": 7, "july": 7, "aug": 8, "august": 8, "sep": 9, "sept": 9, "september": 9, "septeber": 9,
    "oct": 10, "october": 10, "nov": 11, "november": 11, "dec": 12, "december": 12,
}
_FULL = "january february march april may june july august september october november december".split()
_ABBR = [m[:3] for m in _FULL]
_WEEKDAY = "(?:monday|tuesday|wednesday|thursday|friday|saturday|sunday)"
_B, _A = "(" + "|".join(_FULL) + ")", "(" + "|".join(_ABBR) + ")"
_D, _Y4, _Y2 = r"(\d{1,2})", r"(\d{4})", r"(\d{2})"
# The date formats in their order; the letters name what each group is.
FORMATS = [
    (rf"{_D}/{_D}/{_Y4}", "dmY"), (rf"{_D}/{_D}/{_Y2}", "dmy"), (rf"{_Y4}-{_D}-{_D}", "Ymd"), (rf"{_D}-{_D}-{_Y4}", "dmY"),
    (rf"{_D}-{_A}-{_Y4}", "dbY"), (rf"{_D}-{_A}-{_Y2}", "dby"), (rf"{_D} {_A} {_Y4}", "dbY"), (rf"{_D} {_A} {_Y2}", "dby"),
    (rf"{_D} {_B} {_Y4}", "dbY"), (rf"{_D} {_B} {_Y2}", "dby"), (rf"{_B} {_D}, {_Y4}", "bdY"), (rf"{_WEEKDAY}, {_B} {_D}, {_Y4}", "bdY"),
    (rf"{_WEEKDAY}, {_D} {_B} {_Y4}", "dbY"), (rf"{_WEEKDAY}, {_D} {_B} {_Y2}", "dby"), (rf"{_Y4}/{_D}/{_D}", "Ymd"),
]

_SEP, _M = r"(?:\s*[-_]\s*|\s+to\s+)", "([A-Za-z]+)"
# The forms of months, ranges, partial and mistyped dates. The forms of ranges are tried in their order.
FORMS = {
    "month day": r"(\d{4})-(\d{1,2})-(\d{1,2})",
    "month": r"(\d{4})-(\d{1,2})",
    "month name": rf"{_M}(?:[\s,-]+(\d{{2,4}}))?",
    "range slashes": r"(\d{1,2})/(\d{1,2})/(\d{2,4})-(\d{1,2})/(\d{1,2})/(\d{2,4})",
    "range iso": r"(\d{4})[/-](\d{1,2})-(\d{1,2})\D+(\d{4})-(\d{1,2})-(\d{1,2})",
    "range within": rf"{_D}{_SEP}{_D}\s+{_M}(?:\s+(\d{{2,4}}))?",
    "range pair": rf"{_D}/{_D}\s+{_M}\s+(\d{{2,4}})",
    "range cross": rf"{_D}\s+{_M}(?:\s+(\d{{2,4}}))?\s*[-_]\s*{_D}\s+{_M}\s+(\d{{2,4}})",
    "range open": rf"{_D}\s+{_M}{_SEP}{_D}\s+{_M}(?:\s+(\d{{2,4}}))?",
    "wrong slashes": rf"{_D}/{_D}/{_Y4}",
    "wrong iso": rf"{_Y4}-{_Y2}-{_Y2}",
    "wrong short": rf"(\d{{3}})-{_Y2}-{_Y2}",
    "partial": rf"{_D}[\s/-]+{_M}(?:[\s,-]+(\d{{2,4}}))?",
}


def _let(c: Column, body: Callable[[Column], Column]) -> Column:
    """body(c) with c worked out once: without it the texts nest into each other, and plans grow beyond all bounds."""
    return F.element_at(F.transform(F.array(c), body), 1)


def _null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def _hint(d: Column | None) -> Column:
    return _null("date") if d is None else d


def _group(t: Column, pattern: str, k: int) -> Column:
    return F.nullif(F.regexp_extract(t, f"(?i)^{pattern}$", k), F.lit(""))


def _number(t: Column, pattern: str, k: int) -> Column:
    return _group(t, pattern, k).try_cast("int")


def _fits(t: Column, pattern: str) -> Column:
    return t.rlike(f"(?i)^{pattern}$")


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """ISO text of a possible date, else null."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    text = F.concat(pad(year, 4), F.lit("-"), pad(month, 2), F.lit("-"), pad(day, 2))
    return F.date_format(F.when(text.rlike(r"^(?!0000)\d{4}-"), text).try_cast("date"), "yyyy-MM-dd")


def _span(start: Column, end: Column) -> Column:
    return _let(F.struct(start.alias("start"), end.alias("end")), lambda s: F.when(s["start"].isNotNull() & s["end"].isNotNull(), s))


def month_number(c: Column) -> Column:
    """P-05: every name that is understood begins with its month's three letters."""
    t = F.lower(strip(c))
    return F.when(t.rlike("^(?:" + "|".join(MONTHS) + ")$"), ((F.instr(F.lit("".join(_ABBR)), F.substring(t, 1, 3)) + 2) / 3).cast("int"))


def _pivot(year: Column) -> Column:
    """Two-digit years as strptime reads them: 69..99 in the 1900s, 0..68 in the 2000s."""
    return F.when(year >= 69, year + 1900).otherwise(year + 2000)


def _short(year: Column) -> Column:
    return F.when(year < 100, year + 2000).otherwise(year)


def normalize_date_text(c: Column) -> Column:
    """P-03"""
    t = normalize_ws(clean_string(c))
    t = F.regexp_replace(t, r"^[ ?]+", "")
    t = F.regexp_replace(t, r"[*`]+$", "")
    t = F.regexp_replace(t, "[–—Ð�]", "-")
    t = F.regexp_replace(t, r"(?i)(\d)(st|nd|rd|th)\b", "$1")
    t = F.regexp_replace(t, r"\s*-\s*", "-")
    return _let(t, _punctuate)


def _punctuate(t: Column) -> Column:
    """The first of the seven rules that fits."""
    return (
        F.when(t.rlike(r"^\d{2}\.\d{2}\.\d{4}$") | t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{2,4}$"), F.translate(t, ".", "/"))
        .when(t.rlike(r"^\d{4}\.\d{1,2}\.\d{1,2}$"), F.translate(t, ".", "-"))
        .when(t.rlike(r"^\d{2}/\d{6}$"), F.regexp_replace(t, r"^(\d{2})/(\d{2})(\d{4})$", "$1/$2/$3"))
        .when(t.rlike(r"^\d{4}\s+\d{1,2}\s+\d{1,2}$"), F.regexp_replace(t, r"\s+", "-"))
        .when(t.rlike(r"^\d{4}-\d{1,2}\s+\d{1,2}$") | t.rlike(r"^\d{4}\s+\d{1,2}-\d{1,2}$"), F.translate(t, " ", "-"))
        .otherwise(t)
    )


def _strip_time(t: Column) -> Column:
    return F.when(t.rlike(r"^.{4}-.{2}-.{2}T"), F.regexp_extract(t, "^([^T]*)T", 1)).otherwise(t)


def _by_format(t: Column, pattern: str, parts: str) -> Column:
    at = {p: k for k, p in enumerate(parts, 1)}
    year = _number(t, pattern, at["Y"]) if "Y" in at else _pivot(_number(t, pattern, at["y"]))
    month = _number(t, pattern, at["m"]) if "m" in at else month_number(_group(t, pattern, at["b"]))
    return iso_date(year, month, _number(t, pattern, at["d"]))


def serial_date(c: Column) -> Column:
    """Days since 1899-12-30 as ISO text."""
    return F.date_add(F.lit("1899-12-30").cast("date"), c.cast("int")).cast("string")


def parse_serial(c: Column) -> Column:
    """P-04 for numbers: a day serial from 10000 to 100000 (whole part), else the number's text is parsed."""
    n = c.cast("double")
    return F.when(F.isnan(n) | n.isNull(), _null()).when(F.floor(n).between(10000, 100000), serial_date(F.floor(n))).otherwise(parse_date(c.cast("string")))


def parse_date(c: Column, fmt: tuple[str, str] | None = None) -> Column:
    """P-04: ISO text of the first format that fits, else null. fmt: one more (pattern, parts), tried first."""
    return _let(normalize_date_text(c), lambda t: _date(t, fmt))


def _date(t: Column, fmt: tuple[str, str] | None = None) -> Column:
    return _let(_strip_time(t), lambda cut: _date_or_serial(t, cut, fmt))


def _date_or_serial(t: Column, cut: Column, fmt: tuple[str, str] | None) -> Column:
    return F.when(t.rlike(r"^\d{5}$"), serial_date(t.try_cast("int"))).otherwise(F.coalesce(*[_by_format(cut, *f) for f in ([fmt] if fmt else []) + FORMATS]))


def infer_year(month: Column, start: Column | None, end: Column | None) -> Column:
    """P-06"""
    s, e = F.year(_hint(start)), F.year(_hint(end))
    return F.when(s.isNull() | e.isNull(), _null("int")).when(s == e, s).when(month >= F.month(_hint(start)), s).otherwise(e)


def _whole_month(year: Column, month: Column) -> Column:
    first = iso_date(year, month, F.lit(1))
    return _span(first, F.last_day(first.try_cast("date")).cast("string"))


def parse_month_value(c: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """P-07"""
    return _let(_strip_time(normalize_date_text(c)), lambda t: _month(t, start, end))


def _month(t: Column, start: Column | None, end: Column | None) -> Column:
    day, iso, name = (FORMS[k] for k in ("month day", "month", "month name"))
    month = month_number(_group(t, name, 1))
    year = F.coalesce(_short(_number(t, name, 2)), infer_year(month, start, end))
    return F.when(_fits(t, day), _whole_month(_number(t, day, 1), _number(t, day, 2))).when(_fits(t, iso), _whole_month(_number(t, iso, 1), _number(t, iso, 2))).when(_fits(t, name), _whole_month(year, month))


def parse_day_range(c: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """P-08: the first pattern that fits decides; with an impossible part it gives null."""
    return _let(normalize_date_text(c), lambda t: _range(t, start, end))


def _range(t: Column, start: Column | None, end: Column | None) -> Column:
    n = lambda p, k: _number(t, p, k)
    m = lambda p, k: month_number(_group(t, p, k))
    two = lambda y: F.when(F.length(y) == 2, y.try_cast("int") + 2000).otherwise(y.try_cast("int"))
    slashes, iso, within, pair, cross, open_ = (FORMS[f"range {k}"] for k in ("slashes", "iso", "within", "pair", "cross", "open"))
    within_year = F.coalesce(two(_group(t, within, 4)), infer_year(m(within, 3), start, end))
    pair_year = _short(n(pair, 4))
    cross_end = _short(n(cross, 6))
    cross_start = F.coalesce(_short(n(cross, 3)), F.when(m(cross, 2) > m(cross, 5), cross_end - 1).otherwise(cross_end))
    open_end = F.coalesce(two(_group(t, open_, 5)), infer_year(m(open_, 4), start, end))
    open_start = F.when(m(open_, 2) > m(open_, 4), open_end - 1).otherwise(open_end)
    return (
        F.when(_fits(t, slashes), _span(iso_date(_short(n(slashes, 3)), n(slashes, 2), n(slashes, 1)), iso_date(_short(n(slashes, 6)), n(slashes, 5), n(slashes, 4))))
        .when(_fits(t, iso), _span(iso_date(n(iso, 1), n(iso, 2), n(iso, 3)), iso_date(n(iso, 4), n(iso, 5), n(iso, 6))))
        .when(_fits(t, within), _span(iso_date(within_year, m(within, 3), n(within, 1)), iso_date(within_year, m(within, 3), n(within, 2))))
        .when(_fits(t, pair), _span(iso_date(pair_year, m(pair, 3), n(pair, 1)), iso_date(pair_year, m(pair, 3), n(pair, 2))))
        .when(_fits(t, cross), _span(iso_date(cross_start, m(cross, 2), n(cross, 1)), iso_date(cross_end, m(cross, 5), n(cross, 4))))
        .when(_fits(t, open_), _span(iso_date(open_start, m(open_, 2), n(open_, 1)), iso_date(open_end, m(open_, 4), n(open_, 3))))
    )


def _in_years(year: Column, start: Column, end: Column) -> Column:
    return F.when(year.between(F.year(start), F.year(end)), year)


def parse_year_hint_date(c: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """P-11: dates whose year is mistyped, repaired to lie within the hints."""
    return _let(normalize_date_text(c), lambda t: _repaired(t, start, end))


def _repaired(t: Column, start: Column | None, end: Column | None) -> Column:
    start, end = _hint(start), _hint(end)
    slash, iso, short = (FORMS[f"wrong {k}"] for k in ("slashes", "iso", "short"))
    first = lambda years, month, day: F.coalesce(*[iso_date(_in_years(y, start, end), month, day) for y in years])
    y = _number(t, slash, 3)
    by_slash = first([y, F.when(y >= 1000, y - 1000)], _number(t, slash, 2), _number(t, slash, 1))
    y = _number(t, iso, 1)
    by_iso = F.when(~y.between(1900, 2100), first([F.reverse(_group(t, iso, 1)).try_cast("int"), F.when(y >= 1000, y - 1000)], _number(t, iso, 2), _number(t, iso, 3)))
    digits = _group(t, short, 1)
    by_short = first([F.when(F.year(start) == F.year(end), F.year(start)), F.concat(F.floor(F.year(start) / 1000).cast("string"), digits).try_cast("int")], _number(t, short, 2), _number(t, short, 3))
    return F.when(start.isNotNull() & end.isNotNull(), F.coalesce(by_slash, by_iso, by_short))


def parse_partial_date(c: Column, start: Column | None = None, end: Column | None = None) -> Column:
    """P-09"""
    return _let(normalize_date_text(c), lambda t: _partial(t, start, end))


def _partial(t: Column, start: Column | None, end: Column | None) -> Column:
    p = FORMS["partial"]
    month, text = month_number(_group(t, p, 2)), _group(t, p, 3)
    year = F.when(text.isNull(), infer_year(month, start, end)).when(F.length(text) == 2, text.try_cast("int") + 2000).otherwise(text.try_cast("int"))
    return F.coalesce(_date(t), _repaired(t, start, end), iso_date(year, month, _number(t, p, 1)))


def parse_month_span(c: Column, year: Column | None) -> Column:
    """P-10"""
    year = _null("int") if year is None else year
    months = F.filter(F.transform(F.regexp_extract_all(normalize_date_text(c), F.lit("([A-Za-z]+)"), 1), month_number), lambda m: m.isNotNull())

    def span(m: Column) -> Column:
        first, last = F.element_at(m, 1), F.element_at(m, -1)
        begin = iso_date(F.when(first > last, year - 1).otherwise(year), first, F.lit(1))
        return _span(begin, F.last_day(iso_date(year, last, F.lit(1)).try_cast("date")).cast("string"))

    return _let(months, lambda m: F.when((F.size(m) >= 2) & year.isNotNull(), span(m)))


def parse_day_or_month(c: Column, start: Column | None = None, end: Column | None = None, fmt: tuple[str, str] | None = None) -> Column:
    """P-12: struct<kind,start,end>; a single day has no end."""
    pack = lambda kind, s, e: F.struct(F.lit(kind).alias("kind"), s.alias("start"), e.alias("end"))
    span = lambda kind, f: lambda t: _let(f(t, start, end), lambda s: F.when(s.isNotNull(), pack(kind, s["start"], s["end"])))
    day = lambda t: _let(F.coalesce(_date(t, fmt), _partial(t, start, end)), lambda x: F.when(x.isNotNull(), pack("day", x, _null())))
    return _let(normalize_date_text(c), lambda t: F.coalesce(day(t), span("day", _range)(t), span("month", lambda t, a, b: _month(_strip_time(t), a, b))(t)))


def date_token(c: Column, is_end: bool = False) -> Column:
    """P-13: DATE of YYYY-MM (its first day, or its last if is_end) or YYYY-MM-DD; other lengths are null."""
    month = F.when(c.rlike(r"^\d{4}-\d{2}$"), F.concat(c, F.lit("-01")).try_cast("date"))
    return F.when(F.length(c) == 7, F.last_day(month) if is_end else month).when((F.length(c) == 10) & c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def bad_token(c: Column) -> Column:
    """P-13: a token of length 7 or 10 that is no date; its record is dropped."""
    return F.length(c).isin(7, 10) & date_token(c).isNull()
