"""Column functions on prices and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFAULT_CURRENCY

# Fixed values.
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")


def money(c: Column) -> Column:
    """To two decimals; what doesn't fit is null."""
    return c.try_cast("decimal(12,2)")


def price_from_text(c: Column) -> Column:
    digits = F.regexp_extract(c, r"₲\.?\s*([\d.]+)", 1)
    return money(F.nullif(F.replace(digits, F.lit("."), F.lit("")), F.lit("")))


def price_minor_units(price: Column, unit: Column) -> Column:
    powers = F.array(*[F.lit(10**k).cast("decimal(10,0)") for k in range(7)])
    return money(price.try_cast("decimal(20,6)") / F.try_element_at(powers, F.coalesce(unit.cast("int"), F.lit(0)) + 1))


def price_offer(price: Column, offer: Column, on_offer: Column) -> Column:
    """The offer if on offer and not zero, else the price; cut to a whole number."""
    chosen = F.when(F.coalesce(on_offer, F.lit(False)) & (F.coalesce(offer.try_cast("double"), F.lit(0.0)) != 0), offer).otherwise(price)
    value = F.nullif(F.nullif(F.nullif(chosen.cast("string"), F.lit("None")), F.lit("null")), F.lit("")).try_cast("double")
    return money(F.when(value != 0, F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))))


def price_promo(price: Column, promo: Column) -> Column:
    """The promotion unless null (zero counts), else the price; text must be a whole number."""
    return money(F.coalesce(promo, price).try_cast("bigint"))


def currency(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(DEFAULT_CURRENCY))


# English months by their first three letters, weekdays, words without a meaning, zones by their names.
ENGLISH = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
_WEEKDAY = "mon(?:day)?|tue(?:s|sday)?|wed(?:nesday)?|thu(?:r|rs|rsday)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?"
_ZONE = r"(?:utc|gmt|z)?\s*([+-]\d{1,2}:?\d{2}|[+-]\d{1,2})|(?:utc|gmt|z)"
_CLOCK = r"(?<!\d)(\d{1,2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*([ap])?\.?(?:(?<=[ap]\.|[ap])m\b\.?)?|\s*([ap])\.?m\b\.?)"
#: A number of two digits is a year of this century up to here, and of the last one beyond.
LAST_SHORT_YEAR = 68


def _bound(value: Column, make) -> Column:
    """make(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def free_timestamp(c: Column) -> Column:
    """A time in UTC without zone, from English text of words and numbers in any usual order; null where it names no day.

    Each token gets a role: the first `h:mm[:ss[.f]] [am|pm]` or `h am|pm` is the clock, what follows it may be a zone
    (Z, UTC, GMT, +hh[:mm]), a month's name is the month, weekdays and `of`, `at`, `on`, `the` mean nothing. Of the
    numbers left, one of three or four digits is the year; with a named month the other is the day, and of two short ones
    the second is the year. Three numbers are year, month, day if the first is the year; else month, day, year, or day, month, year
    where the first is over 12. Eight digits are year, month, day, followed by four or six more or not. A day, a month and
    a year must be there, and a word without a role makes the text none; nothing is filled in from today.
    """
    return _bound(F.lower(F.trim(c)), lambda t: F.when(F.length(t) <= 100, _bound(_spread(t), _with_clock))).cast("timestamp_ntz")


def _spread(t: Column) -> Column:
    """Digits without marks are given some, so they take the same way as the others."""
    compact = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2})?)?(?=z|[+-]|\s|$)", "$1 $2 $3 $4:$5:$6 ")
    tidy = F.regexp_replace(F.regexp_replace(compact, "^(\\d{4} \\d\\d \\d\\d) :: ", "$1 "), "^(\\d{4} \\d\\d \\d\\d \\d\\d:\\d\\d): ", "$1 ")
    return F.regexp_replace(tidy, r"(?<=\d)t(?=\d)", " ")


def _with_clock(t: Column) -> Column:
    def zoned(clock: Column) -> Column:
        # a zone only after a clock: elsewhere a sign is a mark between numbers
        after = F.when(F.length(clock) > 0, F.ltrim(F.substring(t, F.instr(t, clock) + F.length(clock), F.length(t)))).otherwise(F.lit(""))
        return _bound(after, lambda rest: _bound(F.regexp_extract(rest, rf"^(?:{_ZONE})(?![a-z0-9:])", 0), lambda zone: tokens(clock, rest, zone)))

    def tokens(clock: Column, after: Column, zone: Column) -> Column:
        rest = F.when(F.length(clock) > 0, F.concat_ws(" ", F.substring(t, F.lit(1), F.instr(t, clock) - 1), F.substring(after, F.length(zone) + 1, F.length(after)))).otherwise(t)
        words = F.regexp_replace(rest, rf"\b(?:{_WEEKDAY}|of|at|on|the)\b\.?|(?<=\d)(?:st|nd|rd|th)\b", " ")
        found = F.regexp_extract_all(words, F.lit(r"[a-z]+|\d+|[^\s\w.,/;-]|_"), F.lit(0))
        return _bound(found, lambda all_of: _bound(F.filter(all_of, lambda w: w.rlike("^[0-9]{1,4}$")), lambda numbers: roles(clock, zone, all_of, numbers)))

    def roles(clock: Column, zone: Column, all_of: Column, numbers: Column) -> Column:
        names = F.filter(all_of, lambda w: w.rlike(f"^(?:{_MONTH})$"))
        return _bound(names, lambda named: _day(all_of, named, numbers) + _time(clock, zone))

    return _bound(F.regexp_extract(t, _CLOCK, 0), zoned)


def _int(w: Column) -> Column:
    return w.try_cast("int")


def _day(tokens: Column, named: Column, numbers: Column) -> Column:
    """The day that a month's names and the numbers give, null unless every token has a role."""
    n = [F.get(numbers, F.lit(i)) for i in range(3)]
    month = F.array_position(F.array(*[F.lit(m) for m in ENGLISH]), F.substring(F.get(named, F.lit(0)), 1, 3)).cast("string")
    year_first = F.length(n[0]) >= 3
    with_name = F.when(year_first, F.array(n[0], month, n[1])).otherwise(F.array(n[1], month, n[0]))
    three = F.when(year_first, numbers).when(_int(n[0]) > 12, F.array(n[2], n[1], n[0])).otherwise(F.array(n[2], n[0], n[1]))
    whole = F.size(tokens) == F.size(named) + F.size(numbers)
    parts = F.when(whole & (F.size(named) == 1) & (F.size(numbers) == 2), with_name).when(whole & (F.size(named) == 0) & (F.size(numbers) == 3), three)

    def day(p: Column) -> Column:
        y, m, d = (F.get(p, F.lit(i)) for i in range(3))
        short = F.when(F.length(y) < 3, F.when(_int(y) <= LAST_SHORT_YEAR, 2000).otherwise(1900)).otherwise(0)
        return F.try_make_timestamp_ntz(_int(y) + short, _int(m), _int(d), F.lit(0), F.lit(0), F.lit(0))

    return _bound(parts, day)


def _time(clock: Column, zone: Column) -> Column:
    """The clock as time since midnight in UTC; null where it is none."""
    g = lambda i: F.regexp_extract(clock, _CLOCK, i)
    half = F.concat(g(5), g(6))
    read, minute = F.coalesce(_int(g(1)), F.lit(0)), F.coalesce(_int(g(2)), F.lit(0))
    hour = F.when(half == "", F.when(read < 24, read)).when(read.between(1, 12), F.pmod(read, F.lit(12)) + F.when(half == "p", 12).otherwise(0))
    second = F.concat(F.coalesce(F.nullif(g(3), F.lit("")), F.lit("0")), F.lit("."), F.substring(F.rpad(g(4), 6, "0"), 1, 6)).try_cast("decimal(8,6)")
    z = lambda i: F.regexp_extract(zone, r"([+-])(\d{1,2}):?(\d{2})?$", i)
    offset = F.coalesce(_int(z(2)), F.lit(0)) * 60 + F.coalesce(_int(z(3)), F.lit(0))
    own = F.make_dt_interval(hours=hour, mins=F.when(minute < 60, minute), secs=F.when(second < 60, second))
    return F.when(F.length(clock) == 0, F.make_dt_interval()).otherwise(own - F.make_dt_interval(mins=F.when(z(1) == "-", -offset).otherwise(offset)))


def iso_timestamp(c: Column) -> Column:
    """A time in UTC without zone, from ISO text or else from any that free_timestamp() reads; null where none does. A time
    without a day is none, though Spark would read it as today's."""

    def read(t: Column) -> Column:
        iso = F.when(t.rlike(r"^\s*[0-9]{4}"), F.try_to_timestamp(t)).cast("timestamp_ntz")
        return F.coalesce(iso, F.when(t.rlike("[0-9]"), free_timestamp(t)))

    return _bound(c, read)


def spanish_date(c: Column) -> Column:
    """`Mes d, yyyy [hh:mm [a. m.|p. m.]]`; null where it names no date. The text is searched once, and what was found cut up."""
    found = F.regexp_extract(c, r"(?iU)\b(" + "|".join(MONTHS) + r")\s+(\d{1,2}),\s+(\d{4})(?:\s+(\d{1,2}):(\d{2})(?:\s*([ap])\.?\s*m\.?)?)?", 0)
    return _bound(F.split(found, r"(?U)[\s,:.]+|(?<=\d)(?=[apAP])"), _spanish)


def _spanish(part: Column) -> Column:
    n = lambda i: F.get(part, F.lit(i)).try_cast("int")
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.get(part, F.lit(0)))).cast("int")
    hour, half = F.coalesce(n(3), F.lit(0)), F.lower(F.substring(F.get(part, F.lit(5)), 1, 1))
    hour = F.when((half == "p") & (hour < 12), hour + 12).when((half == "a") & (hour == 12), F.lit(0)).otherwise(hour)
    return F.when(month > 0, F.try_make_timestamp_ntz(n(2), month, n(1), hour, F.coalesce(n(4), F.lit(0)), F.lit(0)))
