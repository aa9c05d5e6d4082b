"""Small hand-written ledgers."""

import datetime as dt
from decimal import Decimal

from clientele import schemas
from clientele.sources.ledger import Ledger

AS_OF = dt.date(2024, 6, 15)


def at(day, second=0.0):
    """A moment on a day: a date, or its text."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return dt.datetime.combine(day, dt.time()) + dt.timedelta(seconds=second)


def line(key, document, amount, day="2024-01-10", order=None, item="I1", discount=0, second=0.0):
    return (key, document, order, item, Decimal(str(amount)), Decimal(str(discount)),
            at(day, second))


def document(key, user="a", day="2024-01-10", currency="DKK", order=None, second=0.0, changed=None):
    return (key, key if order is None else order, user, currency, at(day),
            at(changed or day, second))


def rate(day, currency="DKK", value=1.0):
    return (currency, dt.date.fromisoformat(day), value)


def ledger(spark, lines, documents, rates):
    return Ledger(spark.createDataFrame(lines, schemas.DOCUMENT_LINE),
                  spark.createDataFrame(documents, schemas.DOCUMENT),
                  spark.createDataFrame(rates, schemas.EXCHANGE_RATES))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
