"""The nine marketplace tables derived from a TPC-H-like star schema.

All formulas are whole-number arithmetic, so every engine gives the same rows. ``FIXTURES.md`` lists
them; ``checks/oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.schemas import SCHEMAS, Marketplace, joined_late

_ITEMS = SCHEMAS["order_items"].names
# Moves purchases onto 2016-2022 so that the calendar features are hit.
SHIFT_DAYS = 7670

_STATE = (
    "CASE WHEN {nk} < 6 THEN 'SP' WHEN {nk} < 8 THEN 'RJ' WHEN {nk} = 8 THEN 'MG' "
    "ELSE concat('N', cast({nk} AS string)) END"
)


def _plus_days(ts: str, days: str) -> str:
    return f"timestampadd(DAY, cast({days} AS int), {ts})"


def _plus_seconds(ts: str, seconds: str) -> str:
    return f"timestampadd(SECOND, cast({seconds} AS bigint), {ts})"


def _cents(column: str) -> str:
    return f"cast(round({column} * 100) AS bigint)"


def _money(cents: str) -> str:
    """Whole cents as DECIMAL(10,2). A double on the way would be printed and parsed again for every row."""
    return f"cast(cast({cents} AS decimal(12,0)) * 0.01BD AS decimal(10,2))"


_DELIVERED = _plus_seconds(_plus_days("base", "2 + (o_orderkey * 31) % 16"), "(o_orderkey * 104729) % 86400")
_ESTIMATED = _plus_days("base", "12 + (o_custkey * 13 + o_orderkey * 7) % 20")
_BOUGHT = _plus_seconds("base", "(o_orderkey * 7919) % 86400")


# Columns used of each star file.
_FILES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
    "l_tax double",
}


class _Star:
    """The star schema's files and, one method each, the tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder
        self._read = cache(self._read)
        self._read_spread = cache(self._read_spread)

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(_FILES[name]).parquet(f"{self._folder}/{name}.parquet")

    def _read_spread(self, name: str) -> DataFrame:
        """A file with fewer splits than the cluster has cores would be worked on by a few tasks only."""
        df, cores = self._read(name), self._spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < min(cores, 8) else df

    def _nation(self) -> DataFrame:
        return self._read("nation").selectExpr(
            "n_nationkey", "n_name", f"{_STATE.format(nk='n_nationkey')} AS state"
        )

    def _dated(self) -> DataFrame:
        return self._read_spread("orders").selectExpr(
            "o_orderkey", "o_custkey", "o_totalprice", f"{_plus_days('o_orderdate', str(SHIFT_DAYS))} AS base"
        )

    def geolocation(self) -> DataFrame:
        return (
            self._nation().withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(8))))
            .withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(2))))
            .selectExpr(
                "cast(n_nationkey * 10 + d AS string) AS geolocation_zip_code_prefix",
                "(-3000 + n_nationkey * 110 + d * 5 + p) / 100.0D AS geolocation_lat",
                "(-6000 + (n_nationkey * 7) % 20 * 100 + d * 3 + p) / 100.0D AS geolocation_lng",
                "n_name AS geolocation_city",
                "state AS geolocation_state",
            )
        )

    def customers(self) -> DataFrame:
        return (
            self._read("customer")
            .join(self._nation(), F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "cast(c_custkey AS string) AS customer_id",
                "cast(c_custkey - c_custkey % 2 AS string) AS customer_unique_id",
                "cast(c_nationkey * 10 + c_custkey % 10 AS string) AS customer_zip_code_prefix",
                "n_name AS customer_city",
                "state AS customer_state",
            )
        )

    def sellers(self) -> DataFrame:
        return (
            self._read("supplier")
            .join(self._nation(), F.col("s_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "cast(s_suppkey AS string) AS seller_id",
                "cast(s_nationkey * 10 + s_suppkey % 10 AS string) AS seller_zip_code_prefix",
                "n_name AS seller_city",
                "state AS seller_state",
            )
        )

    def products(self) -> DataFrame:
        return (
            self._read("part")
            .filter("p_partkey % 50 <> 49")
            .selectExpr(
                "cast(p_partkey AS string) AS product_id",
                "CASE WHEN p_partkey % 40 = 0 THEN '' ELSE replace(p_name, ' ', '_') END AS product_category_name",
                "cast(length(p_name) AS int) AS product_name_lenght",
                "cast(100 + (p_partkey * 7) % 900 AS int) AS product_description_lenght",
                "CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE cast(1 + p_partkey % 5 AS int) END AS product_photos_qty",
                "cast(p_size * 50 AS int) AS product_weight_g",
                "cast(10 + p_partkey % 30 AS int) AS product_length_cm",
                "cast(5 + p_partkey % 20 AS int) AS product_height_cm",
                "cast(8 + p_partkey % 15 AS int) AS product_width_cm",
            )
        )

    def orders(self) -> DataFrame:
        return self._dated().selectExpr("*", f"{_BOUGHT} AS bought").selectExpr(
            "cast(o_orderkey AS string) AS order_id",
            "cast(o_custkey AS string) AS customer_id",
            "CASE WHEN o_orderkey % 25 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status",
            "bought AS order_purchase_timestamp",
            "timestampadd(HOUR, 1, bought) AS order_approved_at",
            "timestampadd(DAY, 1, bought) AS order_delivered_carrier_date",
            f"CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {_DELIVERED} END AS order_delivered_customer_date",
            f"{_ESTIMATED} AS order_estimated_delivery_date",
        )

    def order_items(self) -> DataFrame:
        # Joined on the text that later joins and sums go by, so that items are shuffled by their order once.
        dated = self._dated().selectExpr("cast(o_orderkey AS string) AS order_id", "base")
        items = self._read_spread("lineitem").selectExpr(
            "cast(l_orderkey AS string) AS order_id",
            "l_linenumber AS order_item_id",
            "cast(l_partkey AS string) AS product_id",
            "cast(l_suppkey AS string) AS seller_id",
            "cast(2 + (l_partkey + l_linenumber) % 9 AS int) AS _days",
            f"{_money(_cents('l_extendedprice'))} AS price",
            # price times (tax + 2 %), rounded half up on whole cents
            f"{_money(f'({_cents("l_extendedprice")} * ({_cents("l_tax")} + 2) + 50) div 100')} AS freight_value",
        )

        def with_dates(rows: DataFrame) -> DataFrame:
            kept = [c for c in rows.columns if c not in (*_ITEMS, "_days")]
            listed = [f"{_plus_days('base', '_days')} AS {c}" if c == "shipping_limit_date" else c for c in _ITEMS]
            return rows.join(dated, "order_id").selectExpr(*listed, *kept)

        return joined_late(items, with_dates)

    def order_payments(self) -> DataFrame:
        return (
            self._dated().withColumn("n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.expr("1 + o_orderkey % 3"))))
            .selectExpr(
                "cast(o_orderkey AS string) AS order_id",
                "cast(n AS int) AS payment_sequential",
                "element_at(array('boleto','credit_card','debit_card','voucher'), cast(1 + (o_orderkey + n) % 4 AS int)) "
                "AS payment_type",
                "cast(1 + (o_orderkey * n) % 12 AS int) AS payment_installments",
                f"{_money(f'{_cents("o_totalprice")} div (1 + o_orderkey % 3)')} AS payment_value",
            )
        )

    def order_reviews(self) -> DataFrame:
        return (
            self._dated().withColumn(
                "second",
                F.explode(
                    F.expr(
                        "filter(array(0, 1), s -> (s = 0 AND o_orderkey % 7 <> 0) OR (s = 1 AND o_orderkey % 50 = 1))"
                    )
                ),
            )
            .selectExpr(
                "cast(o_orderkey * 2 + second AS string) AS review_id",
                "cast(o_orderkey AS string) AS order_id",
                "cast(1 + (o_orderkey * CASE WHEN second = 0 THEN 17 ELSE 11 END) % 5 AS int) AS review_score",
                "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('title ', cast(o_orderkey AS string)) END "
                "AS review_comment_title",
                "concat('said \"ok\", order ', cast(o_orderkey AS string), chr(10), 'second line') "
                "AS review_comment_message",
                f"{_ESTIMATED} AS review_creation_date",
                "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE "
                f"{_plus_days(_ESTIMATED, '1 + o_orderkey % 4')} END AS review_answer_timestamp",
            )
        )

    def product_category_name_translation(self) -> DataFrame:
        return (
            self._read("part")
            .selectExpr("replace(p_name, ' ', '_') AS product_category_name")
            .distinct()
            .selectExpr(
                "product_category_name",
                "replace(product_category_name, '_', ' ') AS product_category_name_english",
            )
        )


def marketplace_from_star(spark: SparkSession, folder: str) -> Marketplace:
    star = _Star(spark, folder)
    return Marketplace(lambda name: getattr(star, name)())
