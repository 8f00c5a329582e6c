"""Reports to CDM tables by a rule table.

A rule says which element of which table comes from which source column, by
which transform, and what stands there when nothing comes out.  The rules are
configuration: they compile to one projection a table over the same scan.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transform = Callable[..., Column]


class Rule(NamedTuple):
    """``sources``: columns read; ``transform``: 'name' or 'name:argument';
    ``default``: text where the result is missing; ``required``: a report
    without a value here has no row in the table."""

    table: str
    element: str
    sources: tuple[str, ...] = ()
    transform: str = "copy"
    default: str | None = None
    required: bool = False


def _decimal(v: Column, digits: str) -> Column:
    return F.round(v, int(digits)).cast(f"decimal(20,{int(digits)})")


def _joined(values: tuple[Column, ...], separator: str) -> Column:
    """The values with the separator between them, missing if one of them is."""
    parts = [values[0].cast("string")]
    for v in values[1:]:
        parts += [F.lit(separator), v.cast("string")]
    return F.concat(*parts)


#: transforms by name; each gets its source columns, then the argument as text
TRANSFORMS: dict[str, Transform] = {
    "copy": lambda v: v,
    "trim": lambda v: F.when(F.trim(v) != "", F.trim(v)),
    "constant": lambda text: F.lit(text),
    "prefix": lambda v, text: F.concat(F.lit(text), v.cast("string")),
    "join": lambda *v: _joined(v[:-1], v[-1]),
    "decimal": lambda v, digits: _decimal(v, digits),
    "kelvin": lambda v, digits="2": _decimal(v + 273.15, digits),
    "pascal": lambda v, digits="0": _decimal(v * 100.0, digits),
    "time": lambda v, pattern="yyyy-MM-dd HH:mm:ss": F.date_format(v, pattern),
}


def _value(rule: Rule, codes: dict[str, dict[str, str]], transforms: dict[str, Transform]) -> Column:
    name, _, argument = rule.transform.partition(":")
    sources = [F.col(c) for c in rule.sources]
    if name == "code":  # a code table given as a map; unknown codes are missing
        pairs = [F.lit(x) for kv in codes[argument].items() for x in kv]
        return F.try_element_at(F.create_map(*pairs), sources[0].cast("string"))
    if name not in transforms:
        raise ValueError(f"{rule.table}.{rule.element}: no transform '{name}'")
    if name == "join":
        return transforms[name](*sources, argument)
    return transforms[name](*sources, *([argument] if argument else []))


def compile_rules(rules: list[Rule], codes: dict[str, dict[str, str]] | None = None,
                  transforms: dict[str, Transform] | None = None) -> dict[str, tuple[list[Column], Column]]:
    """Per table: its text columns in the order of the rules, and the
    condition that its required elements are there (before any default).
    An element with two rules or an unknown transform is an error."""
    known = TRANSFORMS | (transforms or {})
    out: dict[str, tuple[list[Column], Column]] = {}
    seen: set[tuple[str, str]] = set()
    for rule in rules:
        if (rule.table, rule.element) in seen:
            raise ValueError(f"{rule.table}.{rule.element}: two rules")
        seen.add((rule.table, rule.element))
        value = _value(rule, codes or {}, known).cast("string")
        columns, present = out.get(rule.table, ([], F.lit(True)))
        if rule.required:
            present = present & value.isNotNull()
        text = value if rule.default is None else F.coalesce(value, F.lit(rule.default))
        out[rule.table] = ([*columns, text.alias(rule.element)], present)
    return out


def map_to_cdm(reports: DataFrame, rules: list[Rule], codes: dict[str, dict[str, str]] | None = None,
               transforms: dict[str, Transform] | None = None) -> dict[str, DataFrame]:
    """One DataFrame of text columns per table of the rules.  Each is a
    filter and a projection of ``reports`` that reads only the columns its
    rules name; nothing is shuffled.  Missing values are NULL."""
    return {table: reports.where(present).select(*columns)
            for table, (columns, present) in compile_rules(rules, codes, transforms).items()}
