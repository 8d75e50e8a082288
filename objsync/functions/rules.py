"""Name and filter rules: one verdict column per text column, plus driver-side guards.

The verdict is computed with built-in regular expressions, so auditing a table
of names or filters stays in generated code.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted name shapes and the content that is refused.
NAME_PATTERN = r"^[a-zA-Z][a-zA-Z0-9_]*\z"
DOTTED_NAME_PATTERN = r"^[a-zA-Z][a-zA-Z0-9_]*(\.[a-zA-Z][a-zA-Z0-9_]*)*\z"
REFUSED_PATTERN = (
    r";|--|/\*|\*/|\x00"
    r"|\b(DROP|DELETE|INSERT|UPDATE|TRUNCATE|ALTER|CREATE|EXEC|EXECUTE)\b"
    r"|\(.*SELECT.*\)"
)
REPORTED_KEYWORDS = ("DROP", "DELETE", "UPDATE", "INSERT", "SELECT")
# Every refused piece holds one of these signs, or one of these words in capitals.
# The dotted capital I counts as I in the search but stays itself in capitals.
SUSPECT_SIGNS = (";", "--", "/*", "*/", "\x00", "\u0130")
SUSPECT_WORDS = ("DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "ALTER", "CREATE", "EXEC", "SELECT")

# Flags for Java: ignore case, Unicode word boundaries, "." stops at \n only.
_JAVA_FLAGS = "(?iUd)"


def _first_refused(text: Column) -> Column:
    """The first refused piece of a text in capitals, '' when there is none."""
    return F.upper(F.regexp_extract(text, _JAVA_FLAGS + "(" + REFUSED_PATTERN + ")", 0))


def _refusal(first: Column) -> Column:
    """'keyword' or 'dangerous' for a refused piece, else NULL."""
    reported = first.rlike("|".join(REPORTED_KEYWORDS))
    return F.when(reported, F.lit("keyword")).when(first != "", F.lit("dangerous"))


def name_verdict(name: Column, dotted: bool = False, first: Column | None = None) -> Column:
    """Verdict of an object or field name: empty, invalid, keyword, dangerous or ok."""
    shape = DOTTED_NAME_PATTERN if dotted else NAME_PATTERN
    first = _first_refused(name) if first is None else first
    return (
        F.when(name.isNull() | (name == ""), F.lit("empty"))
        .when(~name.rlike(shape), F.lit("invalid"))
        .otherwise(F.coalesce(_refusal(first), F.lit("ok")))
    )


def filter_verdict(text: Column, first: Column | None = None) -> Column:
    """Verdict of a filter text: keyword, dangerous, unbalanced or ok (also when absent)."""
    quotes = F.length(text) - F.length(F.replace(text, F.lit("'"), F.lit("")))
    first = _first_refused(text) if first is None else first
    return F.when(text.isNull() | (text == ""), F.lit("ok")).otherwise(
        F.coalesce(_refusal(first), F.when(quotes % 2 != 0, F.lit("unbalanced")), F.lit("ok"))
    )


def audit_names(df: DataFrame, name: str, output: str, dotted: bool = False) -> DataFrame:
    """Add the verdict of a name column; each name is searched once."""
    found = df.withColumn("_first", _first_refused(F.col(name)))
    return found.withColumn(output, name_verdict(F.col(name), dotted, F.col("_first"))).drop("_first")


def audit_filter_text(df: DataFrame, text: str, output: str) -> DataFrame:
    """Add the verdict of a filter column; a text is searched at most once.

    The search is slow on long texts, so it is spared for those that hold none of
    the signs or words in question, which plain substring tests find quickly.
    """
    value, capitals = F.col(text), F.col("_capitals")
    suspect = reduce(
        lambda a, b: a | b,
        [value.contains(sign) for sign in SUSPECT_SIGNS] + [capitals.contains(word) for word in SUSPECT_WORDS],
    )
    found = df.withColumn("_capitals", F.upper(text)).withColumn(
        "_first", F.when(suspect, _first_refused(value)).otherwise(F.lit(""))
    )
    return found.withColumn(output, filter_verdict(value, F.col("_first"))).drop("_first", "_capitals")


def all_names_ok(names: Column, dotted: bool = True) -> Column:
    """True when every name of an array column passes."""
    return F.forall(names, lambda name: name_verdict(name, dotted) == "ok")


def check_name(name: str, dotted: bool = True) -> str:
    """Driver-side guard for a name from a configuration."""
    if not name:
        raise ValueError("A name is empty")
    shape = DOTTED_NAME_PATTERN if dotted else NAME_PATTERN
    if not re.match(shape.replace(r"\z", r"\Z"), name):
        raise ValueError(f"Not a name: {name}")
    refused = re.search(REFUSED_PATTERN, name, re.IGNORECASE)
    if refused:
        raise ValueError(f"A name must not be {refused.group(0).upper()}")
    return name
