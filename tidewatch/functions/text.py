"""Text forms of values: templates, percentages, bars, legends."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_number(value: Column) -> Column:
    """Number as text without a trailing ``.0``."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def humanize_percentage(ratio: Column) -> Column:
    """Ratio as percent with four significant digits."""
    percent = ratio.cast("double") * 100
    places = 3 - F.floor(F.log10(F.abs(percent)))
    unit = F.pow(F.lit(10.0), places)
    digits = F.when(percent == 0, F.lit(0.0)).otherwise(F.round(percent * unit) / unit)
    return F.concat(plain_number(digits), F.lit("%"))


def render(template: str | Column, fields: Mapping[str, Column]) -> Column:
    """Replace ``{name}`` by the column given for it."""
    if isinstance(template, str):
        pieces = re.split(r"\{(\w+)\}", template)
        parts = [F.lit(p) if i % 2 == 0 else F.coalesce(fields[p], F.lit("")) for i, p in enumerate(pieces)]
        return F.concat(*parts)
    out = template
    for name, column in fields.items():
        out = F.replace(out, F.lit(f"{{{name}}}"), F.coalesce(column, F.lit("")))
    return out


def bar(value: Column, per_unit: float = 20.0) -> Column:
    return F.repeat(F.lit("█"), (value * per_unit).cast("int"))


def legend(*columns: str) -> Column:
    """``a b (c)``: the last label in brackets."""
    *head, tail = [F.col(c) for c in columns]
    return F.concat(F.concat_ws(" ", *head), F.lit(" ("), tail, F.lit(")"))


def joined_reasons(reason: str | Column, digits: int = 1) -> Column:
    """Contributions as one line, separated by bars."""
    reason = F.col(reason) if isinstance(reason, str) else reason
    return F.array_join(
        F.transform(
            reason,
            lambda x: F.format_string(
                f"%s=%.{digits}f (%s, z=%+.{digits}f)", x["metric"], x["value"], x["direction"], x["z"]
            ),
        ),
        " | ",
    )


def level(value: Column, above: float = 5.0) -> Column:
    return F.when(value > above, "ELEVATED").otherwise("Normal")
