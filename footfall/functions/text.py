"""Text codecs: messages, row keys, result lines, percent text, behaviour labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.functions.timeparts import parse_time, time_text

# Fixed values of the data formats.
FIELD_MARK = "@"
RAW_LOG_MARK = "\x01"
PUBLISH, BROWSE = "0", "1"
LABELS = ("publish", "browse", "comment")


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def message(user_id: Column, behavior: Column, article_id: Column, ts: Column) -> Column:
    """``user@behavior@article@time``. Missing fields stay as empty places."""
    return message_of(user_id, behavior, article_id, time_text(ts))


def message_of(user_id: Column, behavior: Column, article_id: Column, time: Column) -> Column:
    """A message whose time is a text to send as it stands."""
    return F.concat_ws(FIELD_MARK, _text(user_id), _text(behavior), _text(article_id), _text(time))


def log_line(user_id: Column, behavior: Column, article_id: Column, time: Column) -> Column:
    """The fields of a raw log line, whatever signs they hold."""
    return F.concat_ws(RAW_LOG_MARK, _text(user_id), _text(behavior), _text(article_id), _text(time))


def message_fields(value: Column) -> dict[str, Column]:
    """Fields of a message by name; absent or unreadable ones are null."""
    parts = F.split(value, FIELD_MARK, -1)
    return {
        "ts": parse_time(F.get(parts, F.lit(3))),
        "user_id": F.get(parts, F.lit(0)),
        "article_id": F.get(parts, F.lit(2)),
        "behavior": F.get(parts, F.lit(1)),
    }


def row_key(ts: Column, user_id: Column) -> Column:
    """``time@user``."""
    return F.concat(time_text(ts), F.lit(FIELD_MARK), user_id.cast("string"))


def split_row_key(key: Column) -> tuple[Column, Column]:
    """Time and user of a row key."""
    return (
        parse_time(F.split_part(key, F.lit(FIELD_MARK), F.lit(1))),
        F.split_part(key, F.lit(FIELD_MARK), F.lit(2)),
    )


def as_number(text: Column) -> Column:
    """Whole number of a text."""
    return text.cast("bigint")


def behavior_label(code: Column) -> Column:
    """Label of a behaviour code; any code but publish and browse is a comment."""
    return (
        F.when(code == PUBLISH, F.lit(LABELS[0]))
        .when(code == BROWSE, F.lit(LABELS[1]))
        .otherwise(F.lit(LABELS[2]))
    )


def format_percent(num: Column, total: Column) -> Column:
    """Share of ``total`` as text such as ``33.33%``, ``12.5%`` or ``100%``.

    The share is worked out in 32-bit floats and rounded half-even to at most
    two decimals. Null where ``num`` is null or ``total`` is zero.
    """
    ratio = F.try_divide(num.cast("float"), total.cast("float")).cast("float")
    share = (ratio * F.lit(100).cast("float")).cast("double")
    digits = F.format_number(F.bround(share, 2), 2)
    return F.concat(F.regexp_replace(digits, r"\.?0{1,2}$", ""), F.lit("%"))


def line(*columns: Column) -> Column:
    """Comma-joined text; a null shows as ``null``."""
    return F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns))
