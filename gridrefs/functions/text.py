"""Text, size, time and version helpers; every function maps Columns to Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unit letters of byte sizes.
UNITS = ("", "K", "M", "G", "T", "P")


def fixed(value: Column, digits: int) -> Column:
    """A number with a fixed number of decimals; the exact binary value is rounded, ties to even."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def format_bytes(value: Column, largest: str = UNITS[-1]) -> Column:
    """Bytes as text: divided by 1000 while above 1000 and below the largest unit, two decimals and unit; null stays null."""
    value, top = value.cast("double"), UNITS.index(largest)
    out = F.concat(fixed(value / 1000.0**top, 2), F.lit(f" {largest}B"))
    for k in range(top - 1, -1, -1):
        out = F.when(value / 1000.0**k <= 1000, F.concat(fixed(value / 1000.0**k, 2), F.lit(f" {UNITS[k]}B"))).otherwise(out)
    return F.when(value.isNotNull(), out)


def parse_bytes(text: Column) -> Column:
    """Bytes of a text such as ``447.10 GB``; null where it is no size."""
    parts = F.split(F.trim(text), " ")
    unit = F.regexp_replace(F.get(parts, 1), "B$", "")
    factor = F.create_map(*[x for k, u in enumerate(UNITS) for x in (F.lit(u), F.lit(1000.0**k))])
    return F.get(parts, 0).try_cast("double") * F.element_at(factor, unit)


def seconds_allowed(text: Column) -> Column:
    """Seconds of ``MM:SS``; a very large number where there is no limit."""
    parts = F.split(text, ":")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(10_000_000_000)).otherwise(F.get(parts, 0).cast("long") * 60 + F.get(parts, 1).cast("long"))


def format_minutes(seconds: Column) -> Column:
    """Seconds as ``MM:00``, a minute added to the whole minutes."""
    minutes = (F.floor(seconds / 60) + 1).cast("string")
    return F.concat(F.when(F.length(minutes) < 2, F.lpad(minutes, 2, "0")).otherwise(minutes), F.lit(":00"))


def fit_width(text: Column, width: int, dots: bool = False, shorten: bool = False) -> Column:
    """Pad or cut a text to a width; ``dots`` marks a cut, ``shorten`` leaves short texts alone."""
    padded = F.rpad(text, width, " ")
    if dots:
        padded = F.when(F.length(text) >= width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(padded)
    return F.when(F.length(text) < width, text).otherwise(padded) if shorten else padded


def substitute(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def code_problem(code: Column) -> Column:
    """Why a project code is not valid; null if it is."""
    return F.when(code.isNull(), "missing").when(code.rlike("^[0-9]+$"), "numeric").when(code.rlike(r"[(){}\[\]<>:;]"), "characters")


def short_status(status: Column) -> Column:
    """The part of a status before its first dash."""
    return F.trim(F.substring_index(status, "-", 1))


def method_prefix(status: Column) -> Column:
    """Combine method that a status starts with, as in ``(P>VK)Fatal-..``; empty without one."""
    return F.regexp_extract(status, r"^(\([A-Z>]+\))", 1)


def without_prefix(status: Column) -> Column:
    """A status without its combine method."""
    return F.regexp_replace(status, r"^\([A-Z>]+\)", "")


def revision(cloud_format: Column, remote: Column, version: Column) -> Column:
    """Initial of the format, ``r`` for remote products, and the version; zarr is always remote."""
    is_remote = (cloud_format == "zarr") | F.coalesce(remote, F.lit(False))
    return F.concat(F.substring(cloud_format, 1, 1), F.when(is_remote, "r").otherwise(""), version)


def next_minor(version: Column) -> Column:
    """Version with its minor number raised by one."""
    parts = F.split(version, r"\.")
    return F.concat_ws(".", F.get(parts, 0), (F.get(parts, 1).cast("int") + 1).cast("string"))


def log_time(text: Column) -> Column:
    """Timestamp of a log line's ``HH:MM dd/mm/yy``."""
    return F.to_timestamp(text, "HH:mm dd/MM/yy")


def age_seconds(ts: Column, now: Column) -> Column:
    """Seconds from a timestamp to now."""
    return F.unix_timestamp(now) - F.unix_timestamp(ts)


def typed_literal(text: Column) -> Column:
    """JSON text of a command-line value: True, False and None become typed."""
    return F.when(text == "True", "true").when(text == "False", "false").when(text == "None", "null").otherwise(F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2))


def closest_divisor(size: Column, target: Column) -> Column:
    """Divisor of a dimension's size that is closest to a target; the smaller of two equally close."""
    low = F.filter(F.sequence(F.lit(1), F.floor(F.sqrt(size)).cast("int")), lambda x: size % x == 0)
    both = F.array_union(low, F.transform(low, lambda x: F.floor(size / x).cast("int")))
    return F.array_min(F.transform(both, lambda x: F.struct(F.abs(x - target).alias("apart"), x.alias("divisor"))))["divisor"]


def close(control: Column, test: Column, atol: Column, rtol: float = 1e-5) -> Column:
    """Whether values are close; NaN equals NaN, and the relative part follows the test value."""
    both_nan = F.isnan(control) & F.isnan(test)
    either = F.isnan(control) | F.isnan(test)
    return F.when(either, both_nan).otherwise(F.abs(control - test) <= atol + rtol * F.abs(test)).eqNullSafe(True)
