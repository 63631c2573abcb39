"""Text cleaning and display columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white space that is collapsed (Java's \s would add vertical tab). A single
# blank is left out of the pattern: it would be replaced by itself in every row.
SPACE_RUN = r"[ \t\n\f\r]{2,}|[\t\n\f\r]"


def trimmed(c: Column) -> Column:
    return F.trim(c.cast("string"))


def collapsed(c: Column) -> Column:
    """Trim, then turn each run of white space into one blank."""
    return spaced_once(trimmed(c))


def spaced_once(c: Column) -> Column:
    return F.regexp_replace(c, SPACE_RUN, " ")


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def key_present(c: Column) -> Column:
    return trimmed(c) != ""


def full_name(first: Column, last: Column) -> Column:
    nothing = F.lit("")
    return F.trim(
        F.concat(
            F.coalesce(trimmed(first), nothing), F.lit(" "), F.coalesce(trimmed(last), nothing)
        )
    )


def organisation_or_person(organisation: Column, first: Column, last: Column) -> Column:
    return F.coalesce(blank_to_null(trimmed(organisation)), blank_to_null(full_name(first, last)))


def first_word(name: Column) -> Column:
    return F.regexp_extract(name, "^([^ ]+)", 1)


def after_first_word(name: Column) -> Column:
    return blank_to_null(F.regexp_replace(name, "^([^ ]+) ?", ""))


def preview(c: Column, length: int = 200) -> Column:
    return F.coalesce(F.concat(F.substring(c, 1, length), F.lit("…")), F.lit(""))


def shortened(c: Column, length: int = 40) -> Column:
    """Cut to ``length`` characters, with an ellipsis only when something was cut."""
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("…"))).otherwise(c)


def matches(c: Column, needle: str, literal: bool = False) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` act as wildcards unless ``literal``."""
    text = F.lower(F.coalesce(c, F.lit("")))
    if literal:
        return F.contains(text, F.lower(F.lit(needle)))
    # A backslash is an ordinary character of the needle, not an escape.
    pattern = needle.lower().replace("\\", "\\\\")
    return text.like(f"%{pattern}%")
