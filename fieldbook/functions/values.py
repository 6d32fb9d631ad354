"""Scalar helpers shared by staging, CRM and statistics code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens that mean "suppressed or not available" in agricultural statistics.
SUPPRESSED = ["(D)", "(NA)", "(Z)", "(X)", "(S)", "(L)", "(H)"]
# Tokens that mean NULL in loaded text files.
NULL_TOKENS = ["NAN", "NAT", "NONE", "NULL", ""]
# Consumer mail providers.
CONSUMER_MAIL = "gmail|yahoo|hotmail|outlook|aol"

METRES_TO_FEET = 3.28084
INCHES_TO_MM = 25.4
SQUARE_METRES_PER_ACRE = 4047.0
METRES_TO_MILES = 0.000621371
SQUARE_FEET_PER_ACRE = 43560.0


def text_or(c: Column | str, default: str) -> Column:
    """Trimmed text, or ``default`` when null or blank."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(F.trim(col), F.lit("")), F.lit(default))


def within(c: Column, low, high, low_open=False, high_open=False) -> Column:
    """The value when inside the interval, else NULL."""
    above = c > low if low_open else c >= low
    below = c < high if high_open else c <= high
    return F.when(above & below, c)


def float_ratio(num: Column, den: Column) -> Column:
    """num / den as floating-point numbers divide: over 0 it is infinite, and 0 / 0 is NaN."""
    over_zero = F.when(F.isnan(num.cast("double")) | (num == 0), float("nan")).when(num > 0, float("inf")).when(num < 0, float("-inf"))
    return F.when(den == 0, over_zero).otherwise(num / den)


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den where den is positive, else NULL."""
    return F.when(den > 0, num / den)


def first_match(pairs: Sequence[tuple[Column, object]], default=None) -> Column:
    """CASE: the value of the first condition that holds."""
    out = None
    for cond, value in pairs:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default) if default is not None else out


def right_closed_bin(c: Column, edges: Sequence[float], labels: Sequence[object]) -> Column:
    """Bins (e0, e1], (e1, e2], …; the last edge may be None for infinity. Outside is NULL."""
    pairs = []
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        cond = c > low
        if high is not None:
            cond = cond & (c <= high)
        pairs.append((cond, label))
    return first_match(pairs)


def mapped(c: Column, table: Mapping[str, object], default) -> Column:
    """Literal lookup with a default for unknown and null keys."""
    out = None
    for key, value in table.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out.otherwise(default)


def surrogate_key(*cols: str, null_token: str = "~null~") -> Column:
    """MD5 over the text of several columns; a null is distinct from an empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in cols]))


def statistic_value(c: Column) -> Column:
    """Numeric value of a published statistic; suppressed and malformed text is NULL."""
    text = F.trim(c)
    plain = F.regexp_replace(text, "[,$]", "")
    return F.when(~F.upper(text).isin(SUPPRESSED), plain.try_cast("double"))


def fips_parts(fips: Column, state: Column | None = None, county: Column | None = None) -> Column:
    """struct(state_fips, county_fips) from a 4- or 5-digit code; explicit parts win."""
    digits = F.regexp_replace(fips, r"\D", "")
    padded = F.when(F.length(digits).isin(4, 5), F.lpad(digits, 5, "0"))
    s = F.substring(padded, 1, 2)
    k = F.substring(padded, 4 - 1, 3)
    if state is not None:
        s = F.coalesce(F.lpad(state.cast("string"), 2, "0"), s)
    if county is not None:
        k = F.coalesce(F.lpad(county.cast("string"), 3, "0"), k)
    return F.struct(s.alias("state_fips"), k.alias("county_fips"))


def two_letter_state(c: Column) -> Column:
    code = F.upper(F.trim(c))
    return F.when(F.length(code) == 2, code)


def iso_day(c: Column) -> Column:
    """The date at the front of an ISO timestamp text, or NULL."""
    head = F.substring(c, 1, 10)
    return F.when(
        head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(head, F.lit("yyyy-MM-dd")).cast("date")
    )


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole elapsed days, rounded down; not a calendar-day difference."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(86400000000)).cast("bigint")


def mail_domain(c: Column) -> Column:
    return F.get(F.split(c, "@"), F.lit(1))


def is_business_mail(c: Column) -> Column:
    """True unless the domain is a consumer provider; a missing domain counts as business."""
    return F.coalesce(~F.lower(mail_domain(c)).rlike(CONSUMER_MAIL), F.lit(True))


def share_filled(cols: Sequence[str]) -> Column:
    """Share of non-null columns."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return filled / F.lit(len(cols))


def coordinate_id(prefix: str, lat: Column, lon: Column) -> Column:
    micro = [(c * 1000000).cast("bigint").cast("string") for c in (lat, lon)]
    return F.concat(F.lit(f"{prefix}_"), micro[0], F.lit("_"), micro[1])


def null_if_token(c: Column) -> Column:
    return F.when(~F.upper(F.trim(c)).isin(NULL_TOKENS), c)


def bare_county(c: Column) -> Column:
    """County name without a trailing COUNTY or CO."""
    return F.trim(F.regexp_replace(F.upper(F.trim(c)), r"\s+(COUNTY|CO)$", ""))


def hashed_fraction(*keys: Column) -> Column:
    """A reproducible number in [0, 1) from row keys, in place of a random draw."""
    return F.pmod(F.xxhash64(*keys), F.lit(1000)) / 1000.0


def text_bucket(text: Column, n: int) -> Column:
    """A number below ``n`` from the md5 of a text: the same on any engine."""
    return F.pmod(F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 12), 16, 10).cast("bigint"), F.lit(n)).cast("int")
