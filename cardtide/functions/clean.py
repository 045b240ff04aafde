"""Cleaning rules as column expressions.

The analyses do not share one cleaning rule. Each function below is one rule; the operators
pick the one they need by name, and nothing is unified silently.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import fixed

MAX_LONG = (1 << 63) - 1

# Characters removed by a trim: everything up to and including the space (fixed value).
_BLANKS = "".join(map(chr, range(0x21)))


def jtrim(c: Column) -> Column:
    """Strip control characters and spaces from both ends (``trim`` alone strips only spaces)."""
    return F.btrim(c, F.lit(_BLANKS))


def _without(c: Column, chars: str) -> Column:
    for ch in chars:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def drop_quotes(c: Column) -> Column:
    return _without(c, '"')


def _bare(c: Column) -> Column:
    """Trimmed text without quotes; NULL reads as blank."""
    return F.coalesce(drop_quotes(jtrim(c)), F.lit(""))


def trim_quotes(c: Column) -> Column:
    """Trim, remove one pair of surrounding quotes, trim again."""
    t = F.coalesce(jtrim(c), F.lit(""))
    quoted = t.startswith('"') & t.endswith('"') & (F.length(t) >= 2)
    return F.when(quoted, jtrim(t.substr(F.lit(2), F.length(t) - 2))).otherwise(t)


# --- keys -------------------------------------------------------------------------------------

def norm_city(c: Column) -> Column:
    x = F.upper(_bare(c))
    return F.when(x.isin(*fixed.MISSING_WORDS), fixed.UNKNOWN).otherwise(x)


def norm_client(c: Column) -> Column:
    """Client id, or NULL when blank or one of the missing words (case-sensitive)."""
    x = _bare(c)
    return F.when(~x.isin(*fixed.MISSING_WORDS), x)


def norm_state(state: Column, city: Column) -> Column:
    """US state code, ONLINE or UNKNOWN; a missing state is ONLINE when the city says so."""
    s = F.upper(_bare(state))
    online_city = F.upper(_bare(city)) == fixed.ONLINE
    return (
        F.when(s.isin(*fixed.US_STATES, fixed.ONLINE), s)
        .when(s.isin(*fixed.MISSING_WORDS) & online_city, fixed.ONLINE)
        .otherwise(fixed.UNKNOWN)
    )


def us_state(c: Column) -> Column:
    """US state code, else NULL."""
    s = F.upper(_bare(c))
    return F.when(s.isin(*fixed.US_STATES), s)


def country(c: Column) -> Column:
    """Any present location that is not a US state code, else NULL."""
    s = F.upper(_bare(c))
    return F.when(~s.isin(*fixed.MISSING_WORDS, *fixed.US_STATES), s)


def mcc_strict(c: Column) -> Column:
    """Category code made of digits only, else NULL."""
    return F.nullif(F.regexp_extract(_bare(c), r"\A[0-9]+\z", 0), F.lit(""))


def mcc_lenient(c: Column) -> Column:
    x = _bare(c)
    return F.when(x.isin(*fixed.MISSING_WORDS), fixed.UNKNOWN_MCC).otherwise(F.upper(x))


def nz_unknown(c: Column) -> Column:
    """Trimmed upper-case text, UNKNOWN when blank."""
    x = F.upper(F.coalesce(jtrim(c), F.lit("")))
    return F.when(x == "", fixed.UNKNOWN).otherwise(x)


def nz_empty(c: Column) -> Column:
    """Quote-free trimmed upper-case text, empty when missing."""
    return F.coalesce(F.upper(jtrim(drop_quotes(c))), F.lit(""))


# --- money ------------------------------------------------------------------------------------

def cents_exact(c: Column) -> Column:
    """Money text to whole cents, rounded half up once; NULL when it is no number or out of range.

    Plain digits after the 18th decimal cannot change the rounding; they are cut off before the
    cast, which would round them.
    """
    text = _without(jtrim(c), '"$ ,')
    cut = F.when(F.length(text) > 19, F.regexp_replace(text, r"(\.[0-9]{18})[0-9]+\z", "$1")).otherwise(text)
    dollars = F.round(cut.try_cast("decimal(38,18)"), 2)
    return (dollars * F.lit(100)).try_cast("bigint")


def cents_double(c: Column) -> Column:
    """Money text to whole cents through a double, halves rounded toward plus infinity.

    Cents beyond 64 bits become the largest or smallest 64-bit number, NaN becomes 0; only texts
    that are no number give NULL. Add them up with ``wide_parts`` and ``wide_total``.
    """
    dollars = jtrim(_without(c, '"$,')).try_cast("double")
    cents = dollars * 100.0
    return (
        F.when(F.isnan(cents), F.lit(0).cast("bigint"))
        .when(cents >= F.lit(2.0**63), F.lit(MAX_LONG))
        .when(cents <= F.lit(-(2.0**63)), F.lit(-MAX_LONG - 1))
        .otherwise(F.floor(cents + 0.5))
    )


def wide_parts(cents: Column) -> tuple[Column, Column]:
    """64-bit cents that may be saturated, in two columns to be added up apart: ordinary ones as 64-bit
    numbers, the few beyond 10 trillion dollars as decimals."""
    ordinary = F.abs(F.greatest(cents, F.lit(-MAX_LONG))) < F.lit(10**15)
    return F.when(ordinary, cents), F.when(~ordinary, cents.cast("decimal(20,0)"))


def wide_total(ordinary: Column, beyond: Column) -> Column:
    """The sums of ``wide_parts`` as one total, held to 64 bits; NULL when neither has a value."""
    beyond = beyond.cast("decimal(38,0)")
    total = F.coalesce(ordinary.cast("decimal(38,0)"), beyond * 0) + F.coalesce(beyond, F.lit(0).cast("decimal(38,0)"))
    return F.greatest(F.least(total, F.lit(MAX_LONG)), F.lit(-MAX_LONG - 1)).cast("bigint")


def amount_double(c: Column) -> Column:
    """Money text to a double after removing ``$`` only; a thousands comma makes it NULL."""
    return _without(jtrim(c), "$").try_cast("double")


# --- flags ------------------------------------------------------------------------------------

def has_error(c: Column, rule: str) -> Column:
    """Whether the error text counts as an error under one of four rules.

    ``no_error``: any text but NO_ERROR; ``any_text``: any text at all; ``none_na``: any text but
    NONE and N/A; ``null_na``: any text but null (any case) and N/A.
    """
    if rule == "no_error":
        x = _bare(c)
        return (x != "") & (F.upper(jtrim(x)) != "NO_ERROR")
    if rule == "any_text":
        return F.coalesce(jtrim(c), F.lit("")) != ""
    if rule == "none_na":
        return ~nz_empty(c).isin("", "NONE", "N/A")
    if rule == "null_na":
        x = F.coalesce(jtrim(c), F.lit(""))
        return ~(x.isin("", "N/A") | (F.lower(x) == "null"))
    raise ValueError(f"unknown error rule: {rule}")


def is_online(c: Column, rule: str) -> Column:
    """Whether the channel text means online: ``phrase``, ``phrase_or_word`` or ``contains``."""
    if rule == "phrase":
        return F.upper(trim_quotes(c)) == "ONLINE TRANSACTION"
    if rule == "phrase_or_word":
        return nz_empty(c).isin("ONLINE TRANSACTION", "ONLINE")
    if rule == "contains":
        return F.coalesce(c, F.lit("")).contains("Online")
    raise ValueError(f"unknown online rule: {rule}")


def truthy(c: Column) -> Column:
    return F.lower(_bare(c)).isin("1", "true", "t", "y", "yes")


def capitalize_words(c: Column) -> Column:
    """One space between words, first letter of each upper-case, the rest lower-case."""
    return F.initcap(F.regexp_replace(c, r"\s+", " "))


def txn_type(c: Column) -> Column:
    """Channel text to a transaction type name."""
    x = F.upper(_bare(c))
    chain = F.when(x.contains("TRANSACTION"), capitalize_words(x))
    for name, words in fixed.TXN_TYPE_WORDS.items():
        chain = chain.when(x.isin(*words), name)
    return chain.otherwise(capitalize_words(F.concat(x, F.lit(" Transaction"))))


# --- time -------------------------------------------------------------------------------------

def day_period(c: Column) -> Column:
    """MORNING, AFTERNOON or NIGHT from the hour of the second word; the date is not checked."""
    hour = F.regexp_extract(_bare(c), r"\A[^ ]* ([^ :]*)", 1).try_cast("int")
    by_hour = [code for code, first, end, _ in fixed.DAY_PERIODS for _ in range(first, end)]
    return F.get(F.array(*map(F.lit, by_hour)), hour)


def parse_ts(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm[:ss]`` to a zone-free timestamp; impossible dates give NULL.

    The text must already be trimmed. One-digit fields are accepted. Canonical 19-character
    texts use the plain cast.
    """
    t = F.coalesce(c, F.lit(""))
    canonical = t.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z")
    words = F.split(t, " ")
    date = F.split(F.rtrim(F.get(words, 0), F.lit("-")), "-")
    time = F.split(F.rtrim(F.get(words, 1), F.lit(":")), ":")
    part = lambda arr, i: F.get(arr, F.lit(i)).try_cast("int")
    second = F.when(F.size(time) > 2, part(time, 2)).otherwise(F.lit(0))
    loose = F.when(
        second.between(0, 59),
        F.try_make_timestamp_ntz(part(date, 0), part(date, 1), part(date, 2), part(time, 0), part(time, 1), second),
    )
    return F.when(canonical, t.try_cast("timestamp_ntz")).otherwise(loose)


def parse_ts_prefix(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` at the start of a text to a zone-free timestamp, read leniently.

    Whatever follows is ignored, as in ``2010-01-01 00:01:00.0``. Numbers beyond a field's range carry
    over into the next larger one: ``2001-02-30`` is 2 March, month 13 is January of the next year, and
    day 0 is the last of the month before. Fields of more than six digits give NULL.
    """
    t = F.coalesce(c, F.lit(""))
    canonical = t.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?![0-9])")
    pattern = r"\A([0-9]{1,6})-([0-9]{1,6})-([0-9]{1,6}) ([0-9]{1,6}):([0-9]{1,6}):([0-9]{1,6})(?![0-9])"
    year, month, day, hour, minute, second = (F.regexp_extract(t, pattern, i).try_cast("int") for i in range(1, 7))
    months = year * 12 + month - 1
    first = F.try_make_timestamp_ntz(F.floor(months / 12).cast("int"), months % 12 + 1, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    lenient = F.try_add(first, F.make_dt_interval(day - 1, hour, minute, second.cast("decimal(18,6)")))
    return F.coalesce(F.when(canonical, t.substr(1, 19).try_cast("timestamp_ntz")), lenient)


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 of a zone-free timestamp, read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


# --- arithmetic and labels --------------------------------------------------------------------

def pct(x: Column, total: Column) -> Column:
    """``x`` as a percentage of ``total``, 0 when there is no total."""
    return F.when(total > 0, x * F.lit(100.0) / total).otherwise(F.lit(0.0))


def ratio(x: Column, total: Column) -> Column:
    return F.when(total > 0, x.cast("double") / total).otherwise(F.lit(0.0))


def int_div(x: Column, n: Column) -> Column:
    """Integer quotient truncated toward zero; 0 when ``n`` is 0."""
    return F.when(n != 0, F.call_function("div", x, n)).otherwise(F.lit(0).cast("bigint"))


def single(threshold: float) -> Column:
    """A rate limit kept in single precision, as rates are compared against single-precision limits.

    0.05, 0.60 and 0.80 are a little larger in single than in double precision, so a rate of
    exactly that value stays below the limit; 0.02, 0.70 and 0.90 are a little smaller.
    """
    return F.lit(float(threshold)).cast("float")


def peak_period(morning: Column, afternoon: Column, night: Column) -> Column:
    """Display name of the busiest part of the day; ties go to the earlier part."""
    names = [p[3] for p in fixed.DAY_PERIODS]
    return (
        F.when((morning >= afternoon) & (morning >= night), names[0])
        .when(afternoon >= night, names[1])
        .otherwise(names[2])
    )


def lowest_period(morning: Column, afternoon: Column, night: Column) -> Column:
    """Display name of the quietest part of the day; ties go to the earlier part."""
    return peak_period(-morning, -afternoon, -night)


def period_order(period: Column) -> Column:
    chain = F.lit(len(fixed.DAY_PERIODS) + 1)
    for i, (code, *_) in enumerate(fixed.DAY_PERIODS, start=1):
        chain = F.when(period == code, i).otherwise(chain)
    return chain


def period_label(city: Column, period: Column) -> Column:
    """``CITY [Manhã]``."""
    name = period
    for code, _, _, display in fixed.DAY_PERIODS:
        name = F.when(period == code, display).otherwise(name)
    return F.concat(city, F.lit(" ["), name, F.lit("]"))


def severity_rank(category: Column) -> Column:
    x = F.upper(category)
    chain = F.lit(0)
    for name, rank, _ in fixed.RISK_CATEGORIES:
        chain = F.when(x == name, rank).otherwise(chain)
    return chain


def fmt_money(cents: Column, thousands: bool = False) -> Column:
    """Cents as ``1234.50``, or ``1,234.50`` with thousands separators."""
    return F.format_string("%,.2f" if thousands else "%.2f", cents / F.lit(100.0))


def mcc_category(c: Column, variant: str) -> Column:
    """General category by first digit, ``long`` or ``short`` wording."""
    labels = fixed.MCC_CATEGORY_LONG if variant == "long" else fixed.MCC_CATEGORY_SHORT
    other, blank = fixed.MCC_CATEGORY_OTHER[variant]
    x = F.coalesce(jtrim(c), F.lit(""))
    chain = F.when(x == "", blank)
    for digit, label in labels.items():
        chain = chain.when(x.startswith(digit), label)
    return chain.otherwise(other)


def mcc_error_cause(c: Column) -> Column:
    """Probable cause of errors: exact codes first, then two-digit prefixes."""
    chain = F.when(F.coalesce(jtrim(c), F.lit("")) == "", fixed.ERROR_CAUSE_BLANK)
    for code, cause in fixed.ERROR_CAUSE_BY_CODE.items():
        chain = chain.when(c == code, cause)
    for prefix, cause in fixed.ERROR_CAUSE_BY_PREFIX.items():
        chain = chain.when(c.startswith(prefix), cause)
    return chain.otherwise(fixed.ERROR_CAUSE_DEFAULT)
