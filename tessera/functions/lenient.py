"""Lenient readers of open JSON values (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    return F.try_parse_json(text)


def kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def text(value: Column, path: str) -> Column:
    """A string, trimmed; any other type is empty."""
    got = F.try_variant_get(value, path, "variant")
    return F.when(kind_of(got) == "STRING", F.trim(F.try_variant_get(value, path, "string"))).otherwise("")


def low(value: Column, path: str) -> Column:
    """text in lower case. Only what was found is lowered: of lower(text(...)) Spark lowers the constant while it plans, for
    which the driver sets up the tables of all letters, and that makes 3 GB of garbage there."""
    got = F.try_variant_get(value, path, "variant")
    return F.when(kind_of(got) == "STRING", F.lower(F.trim(F.try_variant_get(value, path, "string")))).otherwise("")


#: The largest 64-bit count; larger numbers stop there.
MOST = (1 << 63) - 1


def count(value: Column, path: str) -> Column:
    """A count of at least 0: a number without its fraction, or a string of ASCII digits; anything else, booleans too,
    is null. Counts beyond 64 bits are the largest one."""
    got = F.try_variant_get(value, path, "variant")
    kind = kind_of(got)
    most, zero = F.lit(MOST), F.lit(0).cast("bigint")
    digits = F.regexp_replace(F.trim(F.try_variant_get(value, path, "string")), "^0+(?=[0-9])", "")
    as_text = F.when(F.length(digits) <= 18, digits.try_cast("bigint")).when(F.length(digits) > 19, most).otherwise(F.coalesce(digits.try_cast("bigint"), most))
    whole = F.greatest(F.try_variant_get(value, path, "bigint"), zero)
    real = F.try_variant_get(value, path, "double")
    as_real = F.when(real >= F.lit(float(MOST)), most).when(real <= 0, zero).otherwise(F.floor(real).try_cast("bigint"))
    return F.when(kind == "STRING", F.when(digits.rlike("^[0-9]+$"), as_text)).when(kind == "BIGINT", whole).when(kind.rlike("^(DOUBLE|FLOAT|DECIMAL)"), as_real)


def truthy(value: Column) -> Column:
    """Of text: 1, true, yes or on, in any case."""
    return F.coalesce(F.lower(F.trim(value)).isin("1", "true", "yes", "on"), F.lit(False))


def yes(value: Column, path: str) -> Column:
    """Of JSON: true, a number but 0, or text that says so."""
    kind = kind_of(F.try_variant_get(value, path, "variant"))
    number = F.coalesce(F.try_variant_get(value, path, "double") != 0, F.lit(False))
    return F.when(kind == "BOOLEAN", F.try_variant_get(value, path, "boolean")).when(kind == "STRING", truthy(F.try_variant_get(value, path, "string"))).otherwise(F.when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), number).otherwise(False))


def exactly(value: Column, path: str, wanted: bool) -> Column:
    """Whether JSON holds this very boolean there; text and numbers never do."""
    got = F.try_variant_get(value, path, "variant")
    return F.coalesce((kind_of(got) == "BOOLEAN") & (F.try_variant_get(value, path, "boolean") == F.lit(wanted)), F.lit(False))


def has(value: Column, path: str) -> Column:
    """Whether something other than null is there."""
    return F.coalesce(kind_of(F.try_variant_get(value, path, "variant")) != "VOID", F.lit(False))


def items(value: Column, path: str) -> Column:
    """The members of a JSON array; of anything else, none."""
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def strings(value: Column, path: str) -> Column:
    """The non-blank strings of a JSON array, trimmed, in order."""
    return F.filter(F.transform(items(value, path), lambda x: text(x, "$")), lambda x: x != "")


def members(value: Column, path: str) -> Column:
    """The members of a JSON object as map<string, variant>; of anything else, none."""
    return F.coalesce(F.try_variant_get(value, path, "map<string,variant>"), F.create_map().cast("map<string,variant>"))


def spelled(value: Column, *paths: str) -> Column:
    """The first of several spellings that is text and not blank."""
    return first_text(*[text(value, p) for p in paths])


def first_text(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(v), F.lit("")) for v in values], F.lit(""))


def informative(column: Column, kind: str) -> Column:
    """Not null, not false, not empty; 0 does inform."""
    if kind == "string":
        return column.isNotNull() & (column != "")
    if kind == "boolean":
        return F.coalesce(column, F.lit(False))
    if kind.startswith(("array", "map")):
        return F.size(column) > 0
    return column.isNotNull()
