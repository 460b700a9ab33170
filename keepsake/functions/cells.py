"""Text cells to typed values, as column expressions that hold under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keepsake.constants import NO, YES

# Letters that Java's number parser takes (type suffixes, hexadecimal floats) and that a plain
# decimal reader does not. The words below also contain some of them, so they are let through.
_FOREIGN_LETTERS = "[dDfFxX]"
_INFINITY = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def column(name: str) -> Column:
    """Reference a column by its exact name, with blanks, dots, quotes or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def without_nan(value: Column) -> Column:
    """NaN becomes NULL, so that there is one kind of missing number."""
    return F.nanvl(value, F.lit(None).cast("double"))


def to_double(cell: Column) -> Column:
    """Parse a decimal number; NULL for text, blanks, NaN, hexadecimal and suffixed numbers."""
    plain = ~cell.rlike(_FOREIGN_LETTERS) | F.lower(F.trim(cell)).isin(*_INFINITY)
    return without_nan(F.when(plain, cell.try_cast("double")))


def to_double_or_zero(cell: Column) -> Column:
    """Parse a decimal number; anything unreadable, and NULL, is 0.0."""
    return F.coalesce(to_double(cell), F.lit(0.0))


def to_flag(cell: Column) -> Column:
    """yes -> true, no -> false, anything else NULL. Exact match, case included."""
    return F.when(cell == YES, True).when(cell == NO, False)


def is_yes(cell: Column) -> Column:
    """True for exactly ``yes``; false for every other value and for NULL."""
    return F.coalesce(cell == YES, F.lit(False))


def to_type(cell: Column, type_name: str) -> Column:
    """Read a text cell as the declared type: double, boolean or string."""
    if type_name == "double":
        return to_double(cell)
    if type_name == "boolean":
        return to_flag(cell)
    if type_name == "string":
        return cell
    raise ValueError(f"cells hold string, double or boolean values, not {type_name}")
