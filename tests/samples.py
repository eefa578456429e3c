"""Rows of the three source tables, with a default for every column."""

import datetime as dt
import decimal

from gustolake.sources import contracts as C

D = decimal.Decimal
TS = dt.datetime(2001, 7, 20, 12, 0, 0)


def item(order_id="1", lineitem_id="1", user_id="u1", restaurant_id="r1", created=TS, price="10.00",
         qty=1, category="Pizza", name="Margherita", loyalty=False, app="web", currency="USD", card=""):
    return (restaurant_id, created, order_id, user_id, card, loyalty, currency, lineitem_id, category, name,
            None if price is None else D(price), qty, app)


def option(order_id="1", lineitem_id="1", group="Tax", name="TAX", price="1.00", qty=1):
    return (order_id, lineitem_id, group, name, None if price is None else D(price), qty)


def items_df(spark, rows):
    return spark.createDataFrame(rows, C.ORDER_ITEMS_SOURCE)


def options_df(spark, rows):
    return spark.createDataFrame(rows, C.ORDER_ITEM_OPTIONS_SOURCE)


def empty_date_dim(spark):
    return spark.createDataFrame([], C.DATE_DIM_SOURCE)
