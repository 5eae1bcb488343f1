"""Order-level facts: everything about an order that does not look at other orders."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.geo import great_circle_km
from orderlens.sources.schemas import Marketplace, join_first

DOUBLE = "double"
ALL_PARTS = frozenset({"items", "payments", "reviews", "customers", "sellers", "coordinates"})


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """One coordinate per zip prefix, so that joining on it cannot multiply rows."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code")).agg(
        F.avg(F.col("geolocation_lat").cast(DOUBLE)).alias("lat"),
        F.avg(F.col("geolocation_lng").cast(DOUBLE)).alias("lng"),
    )


def _money_sum(column: str) -> Column:
    """Exact sum of DECIMAL(10,2) amounts as a double. Whole cents add up in a long; a decimal sum would
    need more digits than fit one and fall back to slow big-number arithmetic."""
    return F.expr(f"sum(CAST(CAST({column} AS decimal(10,2)) * 100 AS bigint)) / 100D")


def item_summary(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Items of known products, one row per order. The 'main' seller and category are the largest text."""
    volume = (
        F.col("product_length_cm").cast("bigint") * F.col("product_height_cm") * F.col("product_width_cm")
    )
    zero = F.lit(0)
    # Only what is summed goes along with the items.
    listed = products.select(
        "product_id",
        "product_category_name",
        "product_weight_g",
        volume.alias("_volume"),
        F.coalesce("product_photos_qty", zero).alias("_photos"),
        F.coalesce("product_description_lenght", zero).alias("_description"),
    )
    return (
        join_first(order_items, listed, "product_id")
        .groupBy("order_id")
        .agg(
            F.count("order_item_id").alias("total_items"),
            _money_sum("price").alias("total_price"),
            _money_sum("freight_value").alias("total_freight"),
            F.max("seller_id").alias("seller_id"),
            F.max("product_category_name").alias("product_category"),
            F.sum("product_weight_g").alias("total_weight_g"),
            F.avg("_volume").alias("avg_product_volume_cm3"),
            F.avg("_photos").alias("avg_product_photos"),
            F.avg("_description").alias("avg_description_length"),
            F.datediff(F.max("shipping_limit_date"), F.min("shipping_limit_date")).alias("shipping_limit_spread"),
            F.max("shipping_limit_date").alias("max_shipping_limit_date"),
        )
    )


def payment_summary(order_payments: DataFrame) -> DataFrame:
    return order_payments.groupBy("order_id").agg(
        _money_sum("payment_value").alias("total_payment"),
        F.max("payment_installments").alias("max_installments"),
        F.max("payment_type").alias("primary_payment_type"),
    )


def late_label(delivered: Column, estimated: Column) -> Column:
    """1 only where delivery is known to be after the estimate; an unknown estimate is not late."""
    return F.when(delivered > estimated, 1).otherwise(0)


def base_orders(orders: DataFrame) -> DataFrame:
    """Orders that reached the customer, with the late label."""
    return orders.where(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    ).select(
        "order_id",
        "customer_id",
        "order_purchase_timestamp",
        late_label(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")).alias("is_late"),
        "order_estimated_delivery_date",
    )


def review_counts(order_reviews: DataFrame) -> DataFrame:
    return order_reviews.groupBy("order_id").agg(F.count(F.lit(1)).alias("review_count"))


def located(people: DataFrame, zip_column: str, centroids: DataFrame, prefix: str) -> DataFrame:
    """Attach the zip centroid of a customer or seller; unknown zips stay without coordinates."""
    side = centroids.select(
        F.col("zip_code").alias(zip_column),
        F.col("lat").alias(f"{prefix}_lat"),
        F.col("lng").alias(f"{prefix}_lng"),
    )
    return people.join(side, zip_column, "left")


def order_facts(t: Marketplace, parts: Collection[str] = ALL_PARTS, few_sellers: bool = False) -> DataFrame:
    """One row per delivered order; nothing is dropped where a part is missing.

    Orders without known items have a NULL ``seller_id``, orders of unknown customers a NULL
    ``customer_state`` and orders of unknown sellers a NULL ``seller_state``. Only the parts asked
    for are joined. The order-level parts share one partitioning (the order id); people are joined
    after they have their coordinates, so coordinates never meet the order rows. ``few_sellers`` says that the sellers
    were counted and may be broadcast: the wide rows then stay where their order id put them.
    """
    facts = base_orders(t.orders)
    centroids = zip_centroids(t.geolocation) if "coordinates" in parts else None
    if "customers" in parts:
        # First, while the rows are slim: this join may shuffle them by customer.
        customers = t.customers.select(
            "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"
        ).withColumn("has_customer", F.lit(True))
        if centroids is not None:
            customers = located(customers, "customer_zip_code_prefix", centroids, "customer")
        facts = facts.join(customers.drop("customer_zip_code_prefix"), "customer_id", "left")
    if "items" in parts:
        facts = facts.join(item_summary(t.order_items, t.products), "order_id", "left")
    if "payments" in parts:
        facts = facts.join(payment_summary(t.order_payments), "order_id", "left")
    if "reviews" in parts:
        facts = facts.join(review_counts(t.order_reviews), "order_id", "left").fillna(0, ["review_count"])
    if "sellers" in parts:
        sellers = t.sellers.select(
            "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"
        ).withColumn("has_seller", F.lit(True))
        if centroids is not None:
            sellers = located(sellers, "seller_zip_code_prefix", centroids, "seller")
        sellers = sellers.drop("seller_zip_code_prefix").withColumnRenamed("seller_id", "_seller")
        # Orders without a seller find none, but must not all meet in one task: their key is spread.
        spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("order_id"), F.lit(1024)).cast("string"))
        key = F.coalesce("seller_id", spread)
        facts = facts.join(F.broadcast(sellers) if few_sellers else sellers, key == F.col("_seller"), "left").drop("_seller")
    if centroids is not None and {"customers", "sellers"} <= set(parts):
        facts = facts.withColumn("distance_km", distance_km())
        facts = facts.drop("customer_lat", "customer_lng", "seller_lat", "seller_lng")
    return facts


def distance_km() -> Column:
    return great_circle_km(
        F.col("customer_lat"), F.col("customer_lng"), F.col("seller_lat"), F.col("seller_lng")
    )


def reviewed_orders(orders: DataFrame, order_reviews: DataFrame) -> DataFrame:
    """Left join of orders to their reviews: one row per review, or one row without a review.

    ``orders`` carries ``review_count``. Orders without reviews skip the join, so the join is an
    inner one, whose two sides adaptive execution may both split if an order has very many reviews.
    """
    reviews = order_reviews.select("order_id", "review_id", "review_score")
    with_review = orders.where("review_count > 0").join(reviews, "order_id")
    return with_review.unionByName(orders.where("review_count = 0"), allowMissingColumns=True)
