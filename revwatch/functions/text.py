"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the ends of a title, and of a JSON text.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
JSON_SPACES = " \t\r\n"

#: A user name of this form is a network address, so its edit is
#: anonymous (dotted quad, or 2 to 7 groups of up to four hex digits and a colon).
ADDRESS_PATTERN = (
    r"^(\d{1,3}\.){3}\d{1,3}$|^([0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}$"
)

#: Fixed value: how a name declares itself to be a bot.
BOT_PATTERN = "(?i)bot"


def normalize_title(title: Column) -> Column:
    """Lower case, underscores as spaces, double spaces halved once, ends trimmed."""
    spaced = F.replace(F.lower(title), F.lit("_"), F.lit(" "))
    return F.btrim(F.replace(spaced, F.lit("  "), F.lit(" ")), F.lit(SPACES))


def contains_either_way(left: Column, right: Column) -> Column:
    return F.contains(left, right) | F.contains(right, left)


def is_network_address(user_name: Column) -> Column:
    return user_name.rlike(ADDRESS_PATTERN)


def iso_timestamp(moment: Column) -> Column:
    """ISO text without a zone, microsecond precision."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
