"""Hand-made frames."""

from datetime import datetime

from tillroll.schema import TRANSACTIONS

RFM = "customer_id int, country string, recency int, frequency bigint, monetary double"


def line(invoice="1", stock="a", text="mug", quantity=1, when="2011-01-01", price=2.0, customer=1.0, country="UK"):
    return (invoice, stock, text, quantity, datetime.fromisoformat(when), price, customer, country)


def transactions(spark, lines):
    return spark.createDataFrame(lines, TRANSACTIONS)


def rfm_rows(spark, rows):
    return spark.createDataFrame(rows, RFM)


def as_set(df):
    return {tuple(r) for r in df.collect()}
