"""Text, amount, identifier and key functions: Column to Column, no Python in the tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: White space of Unicode, with the four separators U+001C to U+001F.
SPACES = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: What isn't one U+0020 between two other characters; a pattern looks up single small characters in a bit set, so they are named one by one.
_ODD = "[" + "".join(f"\\x{{{ord(x):X}}}" for x in SPACES if ord(x) < 0x100 and x != " ") + r"\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(c: Column | str) -> Column:
    """Without white space at its ends; F.trim alone knows U+0020 only."""
    return F.trim(_c(c), F.lit(SPACES))


def clean_string(c: Column | str) -> Column:
    """P-01: trimmed; null for an empty text, nan, none and n/a in any case."""
    t = strip(_c(c).cast("string"))
    return F.when(~F.lower(t).isin("", "nan", "none", "n/a"), t)


def normalize_ws(c: Column | str) -> Column:
    """P-02: runs of white space become one space; trimmed."""
    # Only what changes matches: a single space stays where it is.
    return F.trim(F.regexp_replace(_c(c), f"(?: *{_ODD})+ *|  +", " "))


def parse_amount(c: Column | str) -> Column:
    """P-14: a number without currency signs and thousands separators, else null."""
    t = strip(F.translate(clean_string(c), "£$€,", ""))
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))


def parse_thousands(c: Column | str) -> Column:
    """P-15: thousands of pounds as a whole number of pounds (cut, not rounded), else null."""
    t = strip(F.translate(_c(c).cast("string"), ",£$", ""))
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), (t.try_cast("double") * 1000).cast("bigint"))


def thousands_currency(c: Column | str) -> Column:
    """GBP where the amount is there."""
    return F.when(parse_thousands(c).isNotNull(), F.lit("GBP"))


# Fixed value: the pattern of company numbers.
COH = r"^(((AC|CE|CS|FC|FE|GE|GS|IC|LP|NC|NF|NI|NL|NO|NP|OC|OE|PC|R0|RC|SA|SC|SE|SF|SG|SI|SL|SO|SR|SZ|ZC|\d{2})\d{6})|((IP|SP|RS)[A-Z\d]{6})|(SL\d{5}[\dA])|(RS007853Z))$"


def is_gb_coh(c: Column | str) -> Column:
    """P-16: a valid company number as it stands; null and empty are not."""
    return F.coalesce(_c(c).rlike(COH), F.lit(False))


def normalize_gb_coh(c: Column | str) -> Column:
    """P-16: trimmed, upper case, digits padded to eight; null if not valid then."""
    t = F.upper(strip(_c(c).cast("string")))
    t = F.when(t.rlike("^[0-9]{1,7}$"), F.lpad(t, 8, "0")).otherwise(t)
    return F.when(is_gb_coh(t), t)


def make_id(prefix: str | Column, *parts: Column | str, reg_nr: Column | str | None = None, register: Column | str | None = None) -> Column:
    """P-17: the registry id where there is a registration number, else a hash of the parts under the prefix; null if all parts are.

    A registration number without a register is an error.
    """
    if reg_nr is not None and register is None:
        raise ValueError("a registration number needs its register")
    cols = [_c(p).cast("string") for p in parts]
    pre = F.lit(prefix) if isinstance(prefix, str) else prefix
    hashed = F.when(F.coalesce(*cols).isNotNull(), F.concat_ws("-", pre, F.sha1(F.concat_ws("|", *cols)))) if cols else F.lit(None).cast("string")
    if reg_nr is None:
        return hashed
    number = F.regexp_replace(F.upper(_c(reg_nr).cast("string")), "[^A-Z0-9]", "")
    reg = F.lit(register) if isinstance(register, str) else register
    return F.when(F.length(number) > 0, F.concat_ws("-", reg, number)).otherwise(hashed)


REGISTRY = r"^[A-Z]{2}-[A-Z0-9]+-[A-Z0-9]+$"


def id_weight(c: Column | str) -> Column:
    """P-18: registry ids 4, Q ids 3, NK- ids 2, others 1."""
    c = _c(c)
    return F.when(c.rlike(REGISTRY), 4).when(c.rlike("^Q[0-9]+$"), 3).when(c.startswith("NK-"), 2).otherwise(1)


def fingerprint(c: Column | str) -> Column:
    """P-19: SHA-1 of the UTF-8 text, in hex."""
    return F.sha1(_c(c))


def is_complex(c: Column | str) -> Column:
    """P-20: 20 characters or more after trimming, and a sign that several names are in it."""
    t = strip(_c(c))
    return F.coalesce((F.length(t) >= 20) & F.lower(t).rlike(r"[,;():]| and | & "), F.lit(False))


# Roles that mean another one.
ROLES = {"consultant lobbyist": "lobbyist"}


def normalize_role(c: Column | str) -> Column:
    """P-21"""
    t = F.lower(strip(_c(c)))
    out = F.when(t == "", F.lit(None).cast("string"))
    for role, same in ROLES.items():
        out = out.when(t == role, F.lit(same))
    return out.otherwise(t)


def pair_key(a: Column | str, b: Column | str) -> Column:
    """P-22: the same for (a, b) and (b, a)."""
    return F.concat_ws("::", F.least(_c(a), _c(b)), F.greatest(_c(a), _c(b)))


def packed(c: Column | str) -> Column:
    """An id as bytes, those of a hash in half their length: for ids that travel. Equal ids alone have equal bytes; ``unpacked`` gives the id back."""
    c = _c(c)
    hashed = F.substring(c, -40, 40)
    short = F.concat(F.lit(b"\1"), F.unhex(hashed), F.substring(c, F.lit(1), F.length(c) - 40).cast("binary"))
    return F.when(hashed.rlike("^[0-9a-f]{40}$"), short).otherwise(F.concat(F.lit(b"\0"), c.cast("binary")))


def unpacked(c: Column | str) -> Column:
    c = _c(c)
    text = F.concat(F.substring(c, 22, 1 << 30).cast("string"), F.lower(F.hex(F.substring(c, 2, 20))))
    return F.when(F.substring(c, 1, 1) == F.lit(b"\1"), text).otherwise(F.substring(c, 2, 1 << 30).cast("string"))


# Character references that tags' texts use most; numbers are decoded by rule.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ", "&pound;": "£", "&euro;": "€", "&copy;": "©", "&middot;": "·", "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&rsquo;": "’", "&lsquo;": "‘", "&ldquo;": "“", "&rdquo;": "”", "&amp;": "&"}
_NUMBER = r"(?i)^(x[0-9a-f]{1,6}|[0-9]{1,7});?"


def _numbered(piece: Column) -> Column:
    """What follows "&#": the character of its number and the rest; as it is where no number of a character stands there."""
    digits = F.regexp_extract(piece, _NUMBER, 1)
    code = F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, 2, 6), 16, 10)).when(digits != "", digits).cast("long")
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    char = F.when(code == 38, "&amp;").otherwise(char)  # is decoded with the names, which come after
    return F.when(digits == "", F.concat(F.lit("&#"), piece)).otherwise(F.concat(char, F.regexp_replace(piece, _NUMBER, "")))


def strip_html(c: Column | str) -> Column:
    """P-23: as it is without < and &; else the text with one space where tags were, references decoded once."""
    c = _c(c)
    t = F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]*>", " ")
    pieces = F.split(t, "&#", -1)
    t = F.array_join(F.concat(F.slice(pieces, 1, 1), F.transform(F.slice(pieces, 2, 1 << 30), _numbered)), "")
    for name, char in ENTITIES.items():
        t = F.replace(t, F.lit(name), F.lit(char))
    return F.when(c.rlike("[<&]"), normalize_ws(t)).otherwise(c)


def parse_properties(items: Column | str) -> Column:
    """P-24: array of KEY=VALUE to struct<properties map<string,array<string>>, error string>.

    Split at the first =, both sides trimmed; a missing =, an empty key or no items is an error.
    """
    items = _c(items)
    pairs = F.transform(items, lambda i: F.struct(strip(F.regexp_extract(i, "(?s)^([^=]*)=", 1)).alias("k"), strip(F.regexp_extract(i, "(?s)^[^=]*=(.*)$", 1)).alias("v"), F.contains(i, F.lit("=")).alias("fine")))
    error = F.when(items.isNull() | (F.size(items) == 0), "no properties").when(F.exists(pairs, lambda p: ~F.coalesce(p["fine"], F.lit(False))), "missing =").when(F.exists(pairs, lambda p: p["k"] == ""), "empty key")
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    grouped = F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"])))
    return F.struct(F.when(error.isNull(), grouped).alias("properties"), error.alias("error"))


def lookup(df: DataFrame, table: DataFrame, col: str, name: str, out: str = "looked_up") -> DataFrame:
    """P-25: left join with a lookup table (lookup, match, value) on the trimmed lower-cased value; no match: null."""
    found = table.where(F.col("lookup") == name).groupBy(F.lower(strip("match")).alias("__match")).agg(F.min("value").alias(out))
    return df.join(found, F.lower(strip(F.col(col))) == F.col("__match"), "left").drop("__match")


def user_label(user_id: Column | str, name: Column | str | None = None, prefix: str = "reviewer") -> Column:
    """P-27: prefix:user[:name]"""
    user = _c(user_id).cast("string")
    if name is None:
        return F.concat_ws(":", F.lit(prefix), user)
    n = strip(_c(name))
    return F.concat_ws(":", F.lit(prefix), user, F.when(n != "", n))
