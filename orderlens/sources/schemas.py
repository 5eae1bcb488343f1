"""Contracts of the nine marketplace tables: columns, types and keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT = T.StringType()
WHOLE = T.IntegerType()
WHEN = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    "geolocation": _struct(
        geolocation_zip_code_prefix=TEXT,
        geolocation_lat=T.DecimalType(10, 8),
        geolocation_lng=T.DecimalType(11, 8),
        geolocation_city=TEXT,
        geolocation_state=TEXT,
    ),
    "customers": _struct(
        customer_id=TEXT,
        customer_unique_id=TEXT,
        customer_zip_code_prefix=TEXT,
        customer_city=TEXT,
        customer_state=TEXT,
    ),
    "sellers": _struct(
        seller_id=TEXT,
        seller_zip_code_prefix=TEXT,
        seller_city=TEXT,
        seller_state=TEXT,
    ),
    "products": _struct(
        product_id=TEXT,
        product_category_name=TEXT,
        product_name_lenght=WHOLE,
        product_description_lenght=WHOLE,
        product_photos_qty=WHOLE,
        product_weight_g=WHOLE,
        product_length_cm=WHOLE,
        product_height_cm=WHOLE,
        product_width_cm=WHOLE,
    ),
    "orders": _struct(
        order_id=TEXT,
        customer_id=TEXT,
        order_status=TEXT,
        order_purchase_timestamp=WHEN,
        order_approved_at=WHEN,
        order_delivered_carrier_date=WHEN,
        order_delivered_customer_date=WHEN,
        order_estimated_delivery_date=WHEN,
    ),
    "order_items": _struct(
        order_id=TEXT,
        order_item_id=WHOLE,
        product_id=TEXT,
        seller_id=TEXT,
        shipping_limit_date=WHEN,
        price=MONEY,
        freight_value=MONEY,
    ),
    "order_payments": _struct(
        order_id=TEXT,
        payment_sequential=WHOLE,
        payment_type=TEXT,
        payment_installments=WHOLE,
        payment_value=MONEY,
    ),
    "order_reviews": _struct(
        review_id=TEXT,
        order_id=TEXT,
        review_score=WHOLE,
        review_comment_title=TEXT,
        review_comment_message=TEXT,
        review_creation_date=WHEN,
        review_answer_timestamp=WHEN,
    ),
    "product_category_name_translation": _struct(
        product_category_name=TEXT,
        product_category_name_english=TEXT,
    ),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
}

# (child table, child column, parent table); parents are referenced by their primary key
FOREIGN_KEYS: tuple[tuple[str, str, str], ...] = (
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("order_payments", "order_id", "orders"),
    ("order_reviews", "order_id", "orders"),
)

# Free text with line breaks inside quotes; only these files have to be read unsplit.
MULTILINE_TABLES = frozenset({"order_reviews"})


def joined_late(rows: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A table made by a last inner join by ``join``, which adds columns and takes rows with further columns as well."""
    table = join(rows)
    table.before_last_join = rows, join
    return table


def join_first(table: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Inner join of ``table`` and ``other``; where the table was ``joined_late``, before its own last join.

    Rows that the last join brings together by a key are then together for what follows, instead of leaving for ``on`` and coming back.
    """
    rows, join = vars(table).get("before_last_join", (table, lambda joined: joined))
    return join(rows.join(other, on))


class Marketplace:
    """The nine source tables as DataFrames; a table is only opened when it is first used."""

    geolocation: DataFrame
    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    product_category_name_translation: DataFrame

    def __init__(self, open_table: Callable[[str], DataFrame]) -> None:
        self._open_table = open_table

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        table = self._open_table(name)
        setattr(self, name, table)
        return table

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    @staticmethod
    def names() -> list[str]:
        return list(SCHEMAS)
