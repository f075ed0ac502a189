"""Column expressions shared by the table jobs. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telescale.settings import OVERHEAD_FRACTION, PARAMS_SEPARATOR

_SEPARATOR = PARAMS_SEPARATOR.replace("(", r"\(")
_INT_MIN, _INT_MAX = -2147483648, 2147483647


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b as double, 0 when a is 0 (checked first) and 1 when only b is 0."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(a == 0.0, F.lit(0.0)).when(b == 0.0, F.lit(1.0)).otherwise(a / F.nullif(b, F.lit(0.0)))


def strip_blanks(text: Column) -> Column:
    """Remove blanks and control characters at both ends (``trim`` removes only blanks)."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+\z", "")


def _name_parts(app_name: Column) -> Column:
    # Separators at the very end open no second part.
    return F.split(F.regexp_replace(app_name, rf"({_SEPARATOR})+\z", ""), _SEPARATOR)


def algorithm_name(app_name: Column) -> Column:
    parts = _name_parts(app_name)
    return F.when(F.size(parts) == 2, strip_blanks(F.get(parts, F.lit(0)))).otherwise(app_name)


def algorithm_args(app_name: Column) -> Column:
    """Arguments of ``NAME with Params(a, b)``; empty unless the name has exactly two parts."""
    parts = _name_parts(app_name)
    body = F.regexp_replace(F.get(parts, F.lit(1)), r"\)\z", "")
    kept = F.regexp_replace(body, r",+\z", "")
    none = F.array().cast("array<string>")
    args = (
        F.when(body == "", F.array(F.lit("")))
        .when(kept == "", none)
        .otherwise(F.transform(F.split(kept, ","), strip_blanks))
    )
    return F.when(F.size(parts) == 2, args).otherwise(F.when(app_name.isNotNull(), none))


def datasize_mb(text: Column) -> Column:
    """Text to whole MB, cut towards zero, at least 1; absent means 1."""
    size = F.coalesce(text.try_cast("double"), F.when(text.isNull(), F.lit(1.0)))
    whole = F.least(F.greatest(size, F.lit(float(_INT_MIN))), F.lit(float(_INT_MAX))).cast("int")
    return F.when(F.isnan(size), F.lit(1)).when(size.isNotNull(), F.greatest(F.lit(1), whole))


def memory_overhead(setting: Column, memory: Column) -> Column:
    """The explicit setting, else a tenth of the memory's number followed by its unit."""
    number = F.regexp_replace(memory, "[^0-9.]", "").try_cast("double")
    unit = F.regexp_replace(memory, "[0-9.]", "")
    return F.coalesce(setting, F.concat((number * F.lit(OVERHEAD_FRACTION)).cast("string"), unit))


def whole_number(text: Column) -> Column:
    """Integer setting; unreadable text gives null (see ``specs.unreadable_settings``)."""
    return text.try_cast("int")


def flag(text: Column, default: bool) -> Column:
    """Boolean setting: only true/false in any case count; absent means the default."""
    return (
        F.when(text.isNull(), F.lit(default))
        .when(F.lower(text) == "true", F.lit(True))
        .when(F.lower(text) == "false", F.lit(False))
    )


def machine_type(os_name: Column, cores: Column, memory_bytes: Column, disk_gb: Column) -> Column:
    memory_mb = memory_bytes / F.lit(1024.0 * 1024)
    return F.concat(
        F.lit("os:"), F.regexp_replace(os_name, r"\s+", ""),
        F.lit("-cores:"), cores.cast("string"),
        F.lit("-memory:"), memory_mb.cast("string"),
        F.lit("-disk_size:"), disk_gb.cast("string"),
    )


def interval_clip(start: Column, length: Column, window_start: Column, window_end: Column) -> Column:
    """Length of [start, start + length] inside the window; an empty interval runs to the window's end."""
    end = F.when(length == 0, window_end).otherwise(start + length)
    return F.greatest(window_start, F.least(window_end, end)) - F.least(
        F.greatest(window_start, start), window_end
    )


def failure_reason(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def stage_key(stage_id: Column) -> Column:
    return stage_id.cast("string")
