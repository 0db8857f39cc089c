"""Schemas of the tables the engine reads and writes.

Times are wall-clock values without a zone (``TIMESTAMP_NTZ``), as in the logs.
Identifiers are text in logs and messages; operators work on any id type.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, COUNT, TIME, DAY = T.StringType(), T.LongType(), T.TimestampNTZType(), T.DateType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RAW_LOG = _schema(user_id=TEXT, behavior=TEXT, article_id=TEXT, behavior_time=TEXT)

EVENTS = _schema(seq=COUNT, ts=TIME, user_id=TEXT, article_id=TEXT, behavior=TEXT)

ARTICLES = _schema(article_id=TEXT, type=TEXT, is_top=TEXT, status=TEXT, domain=TEXT)

USER_HOUR = _schema(hour=TIME, user_id=TEXT, domain=TEXT, num=COUNT)

ARTICLE_HOUR = _schema(hour=TIME, article_id=TEXT, domain=TEXT, behavior=TEXT, num=COUNT)

ARTICLE_DAY = _schema(day=DAY, article_id=TEXT, domain=TEXT, behavior=TEXT, num=COUNT)

DOMAIN_DAY = _schema(day=DAY, domain=TEXT, num=COUNT)

# One stored message. ``status`` is "ok" or "rejected"; ``value`` keeps the text
# of a rejected message. ``sent_at, part, pos`` tell the order of writing inside
# a batch, ``batch_id`` the order of a stream's batches, ``run`` that of streams.
INGESTED = _schema(
    ts=TIME, user_id=TEXT, article_id=TEXT, behavior=TEXT,
    sent_at=T.TimestampType(), part=T.IntegerType(), pos=COUNT, value=TEXT,
    day=DAY, status=TEXT, run=COUNT, batch_id=COUNT,
)

# A resolved event of a compacted day, with the place of its write.
COMPACTED = _schema(
    ts=TIME, user_id=TEXT, article_id=TEXT, run=COUNT, batch_id=COUNT,
    sent_at=T.TimestampType(), part=T.IntegerType(), pos=COUNT, behavior=TEXT, day=DAY,
)

# Articles of stored events that the dimension did not hold.
UNMATCHED = _schema(article_id=TEXT, day=DAY)

# A search result as handed to a caller: every field is text.
RESULT_ROW = _schema(time=TEXT, article_id=TEXT, domain=TEXT, behavior=TEXT, percent=TEXT, num=TEXT)
