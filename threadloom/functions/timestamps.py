"""Time stamps of the post dump, e.g. ``Tue Oct 31 22:10:47 +0000 2017``."""

from pyspark.sql import Column, functions as F

# Fixed value: the format after the weekday, which carries no information.
POST_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"


def post_time(created_at: Column) -> Column:
    """Parse the textual time; unreadable text gives null."""
    return F.try_to_timestamp(F.substr(created_at, F.lit(5)), F.lit(POST_TIME_FORMAT))


def time_order(created_at: Column) -> Column:
    """Sort key in true time: seconds since 1970, unreadable times first."""
    return F.coalesce(F.unix_timestamp(post_time(created_at)), F.lit(-1).cast("bigint"))


def text_order(created_at: Column) -> Column:
    """Sort key that compares the raw text, as a plain string sort would."""
    return F.coalesce(created_at, F.lit(""))


def sort_key(created_at: Column, order: str) -> Column:
    if order == "time":
        return time_order(created_at)
    if order == "lexical":
        return text_order(created_at)
    raise ValueError(f"order must be 'time' or 'lexical', not {order!r}")
