"""Typed access to JSON documents held in a variant column."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from questlake.functions.bound import bound

# Whole numbers are read as decimals first so that 12.5 rounds to 13 rather than being cut. With
# eighteen places every double that can round to a bigint keeps the digits that decide.
_NUMBER = "decimal(38,18)"


class Field(NamedTuple):
    """One output column: ``kind`` is bigint, int, double, string, date or variant."""

    name: str
    path: str
    kind: str


def has_key(raw: Column, path: str) -> Column:
    """True if the path exists, also when its value is the JSON null."""
    return F.variant_get(raw, path, "variant").isNotNull()


def lenient_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date, NULL for anything else."""
    return F.try_to_date(text, "yyyy-MM-dd")


def iso_date(text: Column) -> Column:
    """ISO 8601 calendar dates (``2026-06-17``, ``20260617``) and week dates
    (``2026-W25-3``, ``2026W253``, day optional) to a date, NULL for anything else."""
    week = r"^(\d{4})(-?)W(\d{2})(?:\2(\d))?$"

    def part(n: int) -> Column:
        return F.regexp_extract(text, week, n).try_cast("int")

    # The 4th of January lies in week 1; a week belongs to the year that holds its Thursday.
    monday = F.date_add(F.trunc(F.make_date(part(1), F.lit(1), F.lit(4)), "week"), (part(3) - 1) * 7)
    day = F.coalesce(part(4), F.lit(1))
    fits = part(3).between(1, 53) & day.between(1, 7) & (F.year(F.date_add(monday, 3)) == part(1))
    return (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), lenient_date(text))
        .when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))
        .when(text.rlike(week), F.when(fits, F.date_add(monday, day - 1)))
    )


def field(raw: Column, spec: Field, strict: bool = True) -> Column:
    """The value at ``spec.path``, cast; bad casts raise if ``strict``, else give NULL."""
    get = F.variant_get if strict else F.try_variant_get
    if spec.kind in ("bigint", "int"):
        rounded = F.round(get(raw, spec.path, _NUMBER))
        return rounded.cast(spec.kind) if strict else rounded.try_cast(spec.kind)
    if spec.kind == "date":
        return lenient_date(get(raw, spec.path, "string"))
    return get(raw, spec.path, spec.kind)


def cast_failures(raw: Column, specs: Sequence[Field]) -> Column:
    """Names of the numeric fields that hold a value which did not cast, or ``''``; reads the
    columns already extracted without ``strict``, and the document only where one is NULL."""
    return F.concat_ws(
        ",",
        *[
            F.when(F.col(s.name).isNull() & F.try_variant_get(raw, s.path, "string").isNotNull(), F.lit(s.name))
            for s in specs
            if s.kind in ("bigint", "int", "double")
        ],
    )


def elements(value: Column) -> Column:
    """The elements of a variant array, or the values of a variant object, as an array.

    NULL for scalars, JSON null and missing values, so ``explode`` gives no rows for them.
    """
    return F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"),
        F.map_values(F.try_variant_get(value, "$", "map<string,variant>")),
    )


def element_strings(value: Column, path: str = "$.name") -> Column:
    """The text at ``path`` of each element, NULL where the element lacks it."""
    return F.transform(elements(value), lambda e: F.try_variant_get(e, path, "string"))


def element_names(value: Column, path: str = "$.name") -> Column:
    """The non-blank texts at ``path`` of the elements; an empty array for no elements."""
    names = F.filter(element_strings(value, path), lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(names, F.array().cast("array<string>"))


def overlay(base: Column, top: Column) -> Column:
    """Merge two variant objects; a key present in ``top`` wins even if its value is null."""
    left = F.variant_get(base, "$", "map<string,variant>")

    def merge(right: Column) -> Column:
        return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)

    return F.to_variant_object(bound(F.variant_get(top, "$", "map<string,variant>"), merge))
