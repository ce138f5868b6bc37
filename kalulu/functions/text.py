"""Small text transforms.  Tables come in one spelling (``kalulu.sources.normalise``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kalulu import constants as K


def sex_label(gender: Column | str) -> Column:
    """F -> Female, anything else -> Male."""
    g = F.col(gender) if isinstance(gender, str) else gender
    return F.when(g == "F", F.lit("Female")).otherwise(F.lit("Male"))


def parent_facility(location: Column | str) -> Column:
    """Outreach clinic -> parent facility; any other location maps to itself."""
    loc = F.col(location) if isinstance(location, str) else location
    expr = None
    for clinic, parent in K.OUTREACH_PARENT:
        cond = loc == clinic.rstrip()
        expr = F.when(cond, F.lit(parent)) if expr is None else expr.when(cond, F.lit(parent))
    return expr.otherwise(loc)


def format_identifier(ident: Column | str) -> Column:
    """Split on blanks, zero-pad parts that start with a digit to 4 characters
    (never truncating), join with '-'.  'NNO 12' -> 'NNO-0012'."""
    c = F.col(ident) if isinstance(ident, str) else ident

    def pad(part: Column) -> Column:
        return F.when(
            part.rlike("^[0-9]") & (F.length(part) < 4),
            F.lpad(part, 4, "0"),
        ).otherwise(part)

    return F.array_join(F.transform(F.split(c, " "), pad), "-")


def differs(a: str, b: str) -> Column:
    """Two columns' texts differ, whatever their case and trailing blanks (also of values that no dictionary holds); null when one is null."""
    return F.expr(f"collate({a}, 'UTF8_LCASE_RTRIM') <> collate({b}, 'UTF8_LCASE_RTRIM')")


def regimen_code(regimen: Column | str) -> Column:
    """Text before the first ':' (the whole string when there is none)."""
    c = F.col(regimen) if isinstance(regimen, str) else regimen
    return F.substring_index(c, ":", 1)


def regimen_name(regimen: Column | str) -> Column:
    """Text after the last ':' (the whole string when there is none)."""
    c = F.col(regimen) if isinstance(regimen, str) else regimen
    return F.substring_index(c, ":", -1)
