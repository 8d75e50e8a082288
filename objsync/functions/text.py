"""Small text expressions used by record mappings."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"


def concat_strip(*parts: Column, sep: str = "") -> Column:
    """Join the parts that hold text and strip all outer white space; never NULL."""
    filled = [F.nullif(part.cast("string"), F.lit("")) for part in parts]
    return F.btrim(F.concat_ws(sep, *filled), F.lit(WHITESPACE))


def template(pattern: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a pattern; a missing value leaves nothing."""
    pieces = []
    for index, piece in enumerate(re.split(r"\{(\w+)\}", pattern)):
        if index % 2:
            pieces.append(F.coalesce(values[piece].cast("string"), F.lit("")))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def is_filled(value: Column) -> Column:
    """Neither NULL nor empty, for required keys."""
    return value.isNotNull() & (value.cast("string") != "")


def is_not(value: Column, excluded: str) -> Column:
    """Differs from one value; a NULL counts as different."""
    return ~value.eqNullSafe(F.lit(excluded))


def child_or(value: Column, default: str = "") -> Column:
    """A struct or JSON field with a default when it is absent."""
    return F.coalesce(value.cast("string"), F.lit(default))


def zero_padded(number: Column, width: int) -> Column:
    """The digits of a number, padded to a width; a longer number keeps all of them."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def object_id(number: Column, prefix: str = "001", width: int = 12) -> Column:
    """An internal id from a number: prefix and zero-padded digits, wider only for numbers beyond the width."""
    return F.concat(F.lit(prefix), zero_padded(number, width))


def all_named(names: Iterable[str]) -> list[Column]:
    """The columns of exactly these names."""
    return [named(name) for name in names]


def named(name: str) -> Column:
    """The column of exactly this name, whatever dots it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
