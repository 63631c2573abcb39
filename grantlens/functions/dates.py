"""Date parsing that never fails a job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted forms. Spark's own cast would also accept a bare year or year-month,
# which must stay NULL; the separators / \ and blank mean the same as a dash.
# A time may follow after a blank or a T, hours and minutes at least; anything else is no date.
_TIME = r"[ T][0-9]{1,2}:[0-9]{1,2}.*"
_OTHER_SEPARATOR = rf"^([0-9]{{4}})[/ \\]([0-9]{{1,2}})[/ \\]([0-9]{{1,2}})(?:{_TIME})?$"
_NOT_A_FULL_DATE = rf"^(?![0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}(?:{_TIME})?$)[\s\S]*$"
_EDGES = " \t\n\x0b\f\r"


def safe_date(c: Column) -> Column:
    """The date a text stands for, or NULL.

    The input occurs once in the expression: it may be a long one, and it is copied
    into every filter that is pushed below the parsed column.
    """
    dashed = F.regexp_replace(F.trim(c.cast("string"), F.lit(_EDGES)), _OTHER_SEPARATOR, "$1-$2-$3")
    return F.regexp_replace(dashed, _NOT_A_FULL_DATE, "").try_cast("date")
