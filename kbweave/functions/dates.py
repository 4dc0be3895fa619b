"""Validity ranges such as `1 Jan 2024 - 31 March 2024`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kbweave.functions.text import let, strip

#: Month abbreviations in calendar order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_M = "|".join(MONTHS)
#: Fixed patterns: day, month and year with and without separators; the separator of a range.
FULL = "(?i)([0-9]{1,2})(?:st|nd|rd|th)?\\s+(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\\s+([0-9]{4})"
COMPACT = f"(?i)([0-9]{{1,2}})\\s*[-/']?\\s*({_M})['\\-\\s]?([0-9]{{2,4}})"
RANGE = "(?i)\\s*(?:–|—|-|to)\\s*"
#: The same without the quirk that splits inside the word October and at any hyphen.
SPACED_RANGE = "(?i)\\s+(?:–|—|-|to)\\s+"


def _date(x: Column, pattern: str) -> Column:
    day, month, year = (F.regexp_extract(x, pattern, g) for g in (1, 2, 3))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.left(F.lower(month), F.lit(3)))
    full = F.when(year.try_cast("int") < 100, year.try_cast("int") + 2000).otherwise(year.try_cast("int"))
    text = F.concat_ws("-", F.lpad(full.cast("string"), 4, "0"), F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when(month != "", F.try_to_date(text, "yyyy-MM-dd"))


def one_date(x: Column) -> Column:
    return F.coalesce(_date(x, FULL), _date(x, COMPACT))


def date_range(x: Column, reference_behaviour: bool = True) -> Column:
    """struct<raw, start, end>, all NULL unless both ends parse."""

    def body(text: Column) -> Column:
        parts = F.split(text, RANGE if reference_behaviour else SPACED_RANGE, 2)

        def both(p: Column) -> Column:
            start, end = one_date(F.get(p, F.lit(0))), one_date(F.get(p, F.lit(1)))
            ok = (F.size(p) == 2) & start.isNotNull() & end.isNotNull()
            return F.struct(F.when(ok, text).alias("raw"), F.when(ok, F.date_format(start, "yyyy-MM-dd")).alias("start"), F.when(ok, F.date_format(end, "yyyy-MM-dd")).alias("end"))

        return let(parts, both)

    return let(strip(F.coalesce(x, F.lit(""))), body)
