"""Time parsing. All instants assume the UTC session set by ``session.configure``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# "Sun Nov 05 11:30:58 -0600 2023" -> the parts without day name and offset
_RFC_SHAPE = r"^\w{3} (\w{3} \d{1,2} \d{2}:\d{2}:\d{2}) [+-]\d{4} (\d{4})$"


def parse_created_at(text: Column) -> Column:
    """ISO text to the true UTC instant; text that is no time gives NULL."""
    return F.try_to_timestamp(text)


def parse_rfc_wallclock(text: Column) -> Column:
    """``Sun Nov 05 11:30:58 -0600 2023`` to ``2023-11-05 11:30:58``: the local clock, no offset."""
    clock = F.regexp_replace(text, _RFC_SHAPE, "$1 $2")
    return F.date_format(
        F.try_to_timestamp(clock, F.lit("MMM d HH:mm:ss yyyy")), "yyyy-MM-dd HH:mm:ss"
    )


def month_of(instant: Column) -> Column:
    return F.date_trunc("month", instant)
