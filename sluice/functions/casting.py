"""Lenient casts from loosely typed sources. What does not fit becomes null, never an error."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import Column

TRUE_WORDS = ("1", "t", "true", "yes", "y", "on")
FALSE_WORDS = ("0", "f", "false", "no", "n", "off", "")

_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_MONTH = (
    "(?i:(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
    "|nov(?:ember)?|dec(?:ember)?))[.]?"
)
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
#: Rewrites of dates in free form to year-month-day, each a no-op where it does not match. Months come before days
#: between slashes, after them between dots.
_REWRITES = (
    (r"^(?i:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?)[.]?,? +", ""),
    (r"(?i),? +at +(?=\d)", " "),
    (rf"^{_MONTH} +{_DAY} +(\d{{1,2}}:\d{{2}}(?::\d{{2}}(?:[.]\d+)?)?)( [A-Z]{{3,4}}| [+-]\d{{4}})? +(\d{{4}})$", "$5-$1-$2 $3$4"),
    (rf"^{_DAY}[ /-]+(?:of )?{_MONTH}[ /,-]+(\d{{4}})(?!\d)", "$3-$2-$1"),
    (rf"^{_MONTH}[ /-]+{_DAY},? +(\d{{4}})(?!\d)", "$3-$1-$2"),
    (rf"^(\d{{4}})[ /-]{_MONTH}[ /-]{_DAY}(?!\d)", "$1-$2-$3"),
    (r"^(\d{4})年(\d{1,2})月(\d{1,2})日 ?", "$1-$2-$3 "),
    (r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})(?!\d)", "$1-$2-$3 $4:$5:$6"),
    (r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(?!\d)", "$1-$2-$3"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", "$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/([0-6]\d)(?!\d)", "20$3-$1-$2"),
    (r"^(\d{1,2})/(\d{1,2})/([7-9]\d)(?!\d)", "19$3-$1-$2"),
    (r"^(\d{1,2})[.](\d{1,2})[.](\d{4})(?!\d)", "$3-$2-$1"),
    (r"^(\d{4}-\w+-\d+)[T, ]+(?=\d)", "$1 "),
)
_CLOCK = r"(?i)^(\S+) (\d{1,2})(:\d{2}(?::\d{2}(?:[.]\d+)?)?) ?([ap])[.]?m[.]?(.*)$"


def try_each(options: list[C]) -> C:
    return reduce(lambda a, b: F.coalesce(a, b), options)


def to_bool(c: C) -> C:
    """Text to boolean by words; anything else is null."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def decimal_to_int(c: C) -> C:
    """Numbers to integers, towards zero."""
    number = c.cast("double")
    return F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("long")


def epoch_to_timestamp(c: C) -> C:
    """Numbers to timestamps; the unit follows from the magnitude: s, ms, µs or ns since 1970."""
    n = c.cast("long")
    size = F.abs(n)
    whole = F.call_function("div", n - F.pmod(n, F.lit(1000)), F.lit(1000))  # integers only: a double has no room for nanoseconds
    micros = (
        F.when(size > 10**18, whole).when(size > 10**15, n).when(size > 10**12, n * 1000).otherwise(n * 1_000_000)
    )
    return F.timestamp_micros(micros)


def to_date(c: C) -> C:
    """Text to date: the date that an ISO text begins with, else what ``to_timestamp`` finds."""
    text = F.trim(c.cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).cast("date"))
    return try_each([iso, to_timestamp(text).cast("date")])


def _bind(value: C, use: Callable[[C], C]) -> C:
    """``use(value)`` with the value written once, however often it is used: plans stay small."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _numbered_month(text: C) -> C:
    month = F.regexp_extract(text, r"^\d{4}-([A-Za-z]{3})", 1)
    number = ((F.instr(F.lit(_MONTHS), F.lower(month)) + 3) / 4).cast("int").cast("string")
    return F.when(month != "", F.concat(F.substring(text, 1, 5), number, F.regexp_replace(text, r"^\d{4}-[A-Za-z]+", ""))).otherwise(text)


def _full_day(text: C) -> C:
    part = lambda k: F.regexp_extract(text, _CLOCK, k)
    hour = part(2).try_cast("int") % 12 + F.when(F.lower(part(4)) == "p", 12).otherwise(0)
    clock = F.concat(part(1), F.lit(" "), hour.cast("string"), part(3), part(5))
    return F.when(text.rlike(_CLOCK), clock).otherwise(text)


def _free_form(text: C) -> C:
    """Text with a date in one of many written forms to timestamp."""
    for pattern, new in _REWRITES:
        text = F.regexp_replace(text, pattern, new)
    ready = _bind(_bind(F.trim(text), _numbered_month), _full_day)
    return _bind(ready, lambda t: F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{2}.*)?$"), t.try_cast("timestamp")))


def to_timestamp(c: C) -> C:
    """Text to timestamp: ISO with or without zone, seconds to nanoseconds since 1970 as digits, or a date in free form.

    Free form: year, month and day in the usual orders, months by number or English
    name, with a weekday before and a time of day (12 or 24 hours, zone) after them.
    """
    text = F.trim(c.cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{1,2}:\d{2}.*)?$"), text.try_cast("timestamp"))
    epoch = F.when(text.rlike(r"^(?:\d{10}|\d{13}|\d{16}|\d{19})$"), epoch_to_timestamp(text.try_cast("long")))
    free = F.when(text.rlike(r"\d.*\d"), _free_form(text))
    return try_each([iso, epoch, free])


def to_time(c: C) -> C:
    """Text ``HH:mm[:ss[.fraction]]`` to time of day."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"), F.try_to_time(text))


def to_array(c: C, element: T.DataType = T.StringType()) -> C:
    """JSON array text to an array; other text is null."""
    return F.when(F.trim(c).rlike(r"^\[.*\]$"), F.from_json(c, T.ArrayType(element)))


def nested_to_json(c: C) -> C:
    """Struct, list or map to compact JSON text."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def cast(c: C, source: T.DataType, target: Column, lenient: bool = True) -> C:
    """A column of a source type to a target column's type."""
    to = target.spark_type
    nested = isinstance(source, (T.StructType, T.MapType, T.ArrayType))
    if source == to and target.kind != "json":
        return c
    if nested and not isinstance(to, T.ArrayType):
        return nested_to_json(c)
    text = isinstance(source, T.StringType)
    if not lenient:
        return c.cast(to)
    if target.kind == "boolean" and text:
        return to_bool(c)
    if target.kind == "date" and text:
        return to_date(c)
    if target.kind == "time" and text:
        return to_time(c)
    if target.kind in ("timestamp", "timestamp_ntz"):
        if text:
            return to_timestamp(c).cast(to)
        if isinstance(source, (T.IntegralType, T.FractionalType)):
            return epoch_to_timestamp(c).cast(to)
    if target.kind == "array" and text:
        return to_array(c, to.elementType)
    if isinstance(to, T.IntegralType) and isinstance(source, T.FractionalType):
        return decimal_to_int(c).try_cast(to)
    return c.try_cast(to)
