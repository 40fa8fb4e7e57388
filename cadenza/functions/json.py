"""Reading loosely shaped JSON text: the first of several paths, tri-state booleans, dates and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Path = tuple[str, ...]

# Words that count as true and false.
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")


def at(payload: Column | str, path: Path | str) -> Column:
    """The value at a path, as text; JSON null is null. A value without a nested part has no path below."""
    parts = path.split(".") if isinstance(path, str) else path
    return F.get_json_object(payload, "$" + "".join(f"['{p}']" for p in parts))


def first_of(payload: Column | str, paths: list[Path | str]) -> Column:
    return F.coalesce(*(at(payload, p) for p in paths))


def object_or_only(payload: Column | str, field: str) -> Column:
    """A field of an object, or of the first object of an array."""
    return F.coalesce(F.get_json_object(payload, f"$.{field}"), F.get_json_object(payload, f"$[0].{field}"))


def snake(name: str) -> str:
    """camelCase to snake_case."""
    return "".join("_" + c.lower() if c.isupper() and i and not name[i - 1].isupper() else c.lower() for i, c in enumerate(name))


def either_case(*path: str) -> list[Path]:
    """The path in camel case and in snake case."""
    other = tuple(map(snake, path))
    return [path] if other == path else [path, other]


def tri_state(value: Column, true: tuple[str, ...] = TRUE_WORDS[:2], false: tuple[str, ...] = FALSE_WORDS[:2]) -> Column:
    """True, false or, for any other word, null."""
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*true), F.lit(True)).when(word.isin(*false), F.lit(False))


def boolean_word(value: Column) -> Column:
    return tri_state(value, TRUE_WORDS, FALSE_WORDS)


def civil_date(value: Column) -> Column:
    """A date from ``yyyy-mm-dd`` text or an object with year, month and day; null if it is none."""
    parts = [F.get_json_object(value, f"$.{p}").try_cast("int") for p in ("year", "month", "day")]
    return F.coalesce(value.try_cast("date"), F.format_string("%04d-%02d-%02d", *parts).try_cast("date"))


def instant(value: Column) -> Column:
    """A UTC instant, with or without a fraction, as a timestamp without zone."""
    text = F.regexp_replace(F.regexp_replace(value, "T", " "), "Z$", "")
    return F.when(value.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(\.\d+)?Z?$"), text.try_cast("timestamp_ntz"))


def parse_state(payload: Column) -> Column:
    """missing, malformed or ok."""
    blank = payload.isNull() | (F.trim(payload) == "")
    return F.when(blank, "missing").when(F.try_parse_json(payload).isNull(), "malformed").otherwise("ok")
