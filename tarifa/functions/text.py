"""Column helpers for delimited lists, codes and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarifa.fixed_values import SEGMENT_TIME_OFFSET, SEPARATOR, SEPARATOR_REGEX


def pick(values: list, index: Column) -> Column:
    """The element of a literal list at a 0-based index; null outside the list."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def lookup(values: dict, key: Column, default=None) -> Column:
    """The value of a literal map; ``default`` for a missing or null key."""
    pairs = [F.lit(x) for item in values.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def split_list(value: Column) -> Column:
    """Split a delimited text into an array. ``split`` takes a regular expression, hence the class."""
    return F.split(value, SEPARATOR_REGEX)


def first_item(value: Column) -> Column:
    """The first item of a delimited text."""
    return F.substring_index(value, SEPARATOR, 1)


def last_item(value: Column) -> Column:
    """The last item of a delimited text."""
    return F.substring_index(value, SEPARATOR, -1)


def item_count(value: Column) -> Column:
    """The number of items of a delimited text, without the regular expression that ``split`` compiles for every row."""
    removed = F.length(value) - F.length(F.replace(value, F.lit(SEPARATOR), F.lit("")))
    return (removed / len(SEPARATOR) + 1).cast("int")


def list_join(*parts: Column) -> Column:
    """Join texts with the list separator."""
    with_separators = [parts[0]]
    for part in parts[1:]:
        with_separators += [F.lit(SEPARATOR), part]
    return F.concat(*with_separators)


def airport_code(value: Column) -> Column:
    return F.upper(F.trim(value))


def duration_minutes(value: Column) -> Column:
    """Minutes of a ``PT<hours>H<minutes>M`` text; null for any other shape."""
    numbers = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    hours = F.get(numbers, F.lit(0)).try_cast("int")
    minutes = F.get(numbers, F.lit(1)).try_cast("int")
    # Most texts hold just these two numbers, which are cut out in less time than all runs of digits are searched.
    plain = value.rlike("\\APT[0-9]{1,7}H[0-9]{1,7}M\\z")
    hour_text = F.substring_index(F.substr(value, F.lit(3)), "H", 1)
    minute_text = F.substring_index(F.substring_index(value, "H", -1), "M", 1)
    cut = hour_text.cast("int") * 60 + minute_text.cast("int")
    return F.when(plain, cut).when(value.like("PT%H%M"), hours * 60 + minutes)


def first_number(value: Column) -> Column:
    """The first run of digits as text; empty when there is none."""
    return F.regexp_extract(value, "([0-9]+)", 1)


def parse_prices(value: Column) -> Column:
    """Numbers of a comma-separated text. A leading number counts, other entries are dropped."""
    # One pass over the text: an entry starts it or follows a comma.
    number = r"(?:^|,) *([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
    found = F.regexp_extract_all(value, F.lit(number), F.lit(1)).try_cast("array<double>")
    return F.when(F.trim(value) != "", found)


def iso_text(epoch: Column) -> Column:
    """Epoch seconds as ISO text, independent of the session time zone."""
    day = F.date_from_unix_date(F.floor(epoch / 86400).cast("int"))
    second = F.pmod(epoch, F.lit(86400)).cast("int")
    # Literal lists, folded once: a text is picked in less time than it is put together.
    minutes = ",".join(f"T{m // 60:02d}:{m % 60:02d}" for m in range(1440))
    seconds = ",".join(f":{s:02d}{SEGMENT_TIME_OFFSET}" for s in range(60))

    def nth(texts: str, index: Column) -> Column:
        return F.get(F.split(F.lit(texts), ","), index.cast("int"))

    return F.concat(day.cast("string"), nth(minutes, F.floor(second / 60)), nth(seconds, second % 60))
