"""Sources, facts, histories, scalar functions and the analytical dataset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.oracle_dataset import KM, ROUNDED_ANALYTICAL
from checks.registry import register, rounded
from orderlens.functions.calendar import day_name, month_start, seconds_between, whole_days_between
from orderlens.functions.labels import feature_label, risk_sentence
from orderlens.operators.keycheck import key_report
from orderlens.plans import facts, history, incremental
from orderlens.plans.dataset import ANALYTICAL_COLUMNS, ANALYTICAL_SCHEMA, analytical_dataset
from orderlens.sources import sinks
from orderlens.sources.artifacts import append_run, read_settings, read_thresholds, write_settings, write_thresholds
from orderlens.sources.loader import coerce_timestamps, load_csv_table, reread_dataset
from orderlens.sources.marketplace import marketplace_from_star
from orderlens.sources.schemas import SCHEMAS
from orderlens.sources.staging import fresh_path, staged

TS = "order_purchase_timestamp"
MONEY = {"total_price": 2, "total_freight": 2, "total_payment": 2}

# ---------------------------------------------------------------- sources and sinks
_DUCK_NAME = {"orders": "shop_orders", "product_category_name_translation": "category_names"}
_LOADED = {
    "geolocation": "* REPLACE (CAST(geolocation_lat AS DECIMAL(10,8)) AS geolocation_lat, "
    "CAST(geolocation_lng AS DECIMAL(11,8)) AS geolocation_lng)",
    "products": "* REPLACE (coalesce(product_photos_qty, 0) AS product_photos_qty)",
}


def _register_csv_load(table: str) -> None:
    source = _DUCK_NAME.get(table, table)

    @register(f"s01_load_{table}", f"SELECT {_LOADED.get(table, '*')} FROM {source}", source)
    def _(spark, folder, table=table):
        path = fresh_path(spark, f"csv-{table}")
        sinks.write_dataset(marketplace_from_star(spark, folder).table(table), path, "csv")
        return load_csv_table(spark, path, table)


for _table in SCHEMAS:
    _register_csv_load(_table)


@register(
    "s02_empty_timestamps",
    """SELECT count(*) AS orders, count(*) FILTER (order_delivered_customer_date IS NULL) AS undelivered,
           (SELECT count(*) FROM order_reviews WHERE review_answer_timestamp IS NULL) AS unanswered FROM shop_orders""",
    "shop_orders",
    "order_reviews",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    paths = {n: fresh_path(spark, f"csv-{n}") for n in ("orders", "order_reviews")}
    for name, path in paths.items():
        sinks.write_dataset(t.table(name), path, "csv")
    orders, reviews = (load_csv_table(spark, p, n) for n, p in paths.items())
    unanswered = reviews.agg(F.count_if(F.col("review_answer_timestamp").isNull()).alias("unanswered"))
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("order_delivered_customer_date").isNull()).alias("undelivered"),
    ).select("*", unanswered.scalar().alias("unanswered"))


_KEYS = [
    ("customers", "customer_id", "customers"),
    ("sellers", "seller_id", "sellers"),
    ("products", "product_id", "products"),
    ("orders", "order_id", "shop_orders"),
    ("order_items", "order_id,order_item_id", "order_items"),
]
_LINKS = [
    ("orders", "customer_id", "customers", "shop_orders", "customers"),
    ("order_items", "order_id", "orders", "order_items", "shop_orders"),
    ("order_items", "product_id", "products", "order_items", "products"),
    ("order_items", "seller_id", "sellers", "order_items", "sellers"),
    ("order_payments", "order_id", "orders", "order_payments", "shop_orders"),
    ("order_reviews", "order_id", "orders", "order_reviews", "shop_orders"),
]


@register(
    "s04_key_report",
    "\nUNION ALL\n".join(
        [
            f"SELECT 'primary key' AS rule, '{t}' AS table_name, '{c}' AS columns, '' AS parent, "
            f"(SELECT count(*) FROM (SELECT {c} FROM {d} GROUP BY {c} HAVING count(*) > 1)) AS bad_keys, "
            f"(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM {d} GROUP BY {c} HAVING count(*) > 1))"
            " AS bad_rows"
            for t, c, d in _KEYS
        ]
        + [
            f"SELECT 'foreign key', '{t}', '{c}', '{p}', "
            f"(SELECT count(DISTINCT {c}) FROM {d} WHERE {c} NOT IN (SELECT {c} FROM {pd})), "
            f"(SELECT count(*) FROM {d} WHERE {c} NOT IN (SELECT {c} FROM {pd}))"
            for t, c, p, d, pd in _LINKS
        ]
    ),
    "customers",
    "sellers",
    "products",
    "shop_orders",
    "order_items",
    "order_payments",
    "order_reviews",
)
def _(spark, folder):
    return key_report(marketplace_from_star(spark, folder))


@register("s05_recreate_table", "SELECT * FROM sellers", "sellers")
def _(spark, folder):
    sellers = marketplace_from_star(spark, folder).sellers
    path = fresh_path(spark, "table-sellers")
    return sinks.recreate_table(sellers, "orderlens_sellers", path, bucket_by="seller_id")


@register(
    "s07_view_read",
    "SELECT order_id, is_late, total_items FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    sinks.refresh_view(analytical_dataset(t, ["order_id", "is_late", "total_items"]))
    return sinks.read_view(spark)


@register("s08_timestamp_coercion", "SELECT order_id, order_purchase_timestamp FROM shop_orders", "shop_orders")
def _(spark, folder):
    orders = marketplace_from_star(spark, folder).orders
    as_text = orders.selectExpr("order_id", f"CAST({TS} AS string) AS {TS}")
    return coerce_timestamps(as_text, (TS, "not_there"))


@register(
    "s09_dataset_csv_round_trip",
    "SELECT order_id, product_category, is_late, round(freight_ratio, 6) AS freight_ratio, order_purchase_timestamp "
    "FROM (SELECT * REPLACE (nullif(product_category, '') AS product_category) FROM plain_dataset)",
    "plain_dataset",
)
def _(spark, folder):
    columns = ["order_id", "product_category", "is_late", "freight_ratio", TS]
    df = analytical_dataset(marketplace_from_star(spark, folder), columns)
    df = df.withColumn("product_category", F.expr("nullif(product_category, '')"))
    path = fresh_path(spark, "dataset-csv")
    sinks.write_dataset(df, path, "csv")
    return rounded(reread_dataset(spark, path, df.schema, "csv"))


@register(
    "s10_dataset_parquet_round_trip",
    "SELECT order_id, total_items, round(total_price, 2) AS total_price FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "total_items", "total_price"])
    path = fresh_path(spark, "dataset-parquet")
    sinks.write_dataset(df, path)
    return rounded(reread_dataset(spark, path, df.schema), **MONEY)


@register(
    "s11_threshold_artifact",
    "SELECT 'total_price' AS column_name, round(max(total_price), 2) AS threshold FROM plain_dataset UNION ALL "
    "SELECT 'total_freight', round(max(total_freight), 2) FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["total_price", "total_freight"])
    top = df.agg(F.max("total_price").alias("total_price"), F.max("total_freight").alias("total_freight")).first()
    path = fresh_path(spark, "thresholds")
    write_thresholds(spark, top.asDict(), path)
    back = read_thresholds(spark, path)
    return spark.createDataFrame(
        [(k, round(v, 2)) for k, v in back.items()], "column_name string, threshold double"
    )


@register(
    "s13_load_profile",
    f"""SELECT count(*) AS row_count, CAST({len(ANALYTICAL_COLUMNS)} AS BIGINT) AS column_count,
        '{",".join(ANALYTICAL_COLUMNS)}' AS column_names FROM plain_dataset""",
    "plain_dataset",
)
def _(spark, folder):
    return sinks.load_profile(analytical_dataset(marketplace_from_star(spark, folder)))


@register(
    "s14_run_log",
    """SELECT 'load' AS run_name, 'metric' AS kind, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM plain_dataset
       UNION ALL SELECT 'load', 'metric', 'late', CAST(sum(is_late) AS VARCHAR) FROM plain_dataset
       UNION ALL SELECT 'load', 'param', 'model', 'none'""",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["is_late"])
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.sum("is_late").alias("late")).first()
    path = fresh_path(spark, "runs")
    append_run(spark, path, "load", {"model": "none"}, {})
    log = append_run(spark, path, "load", {}, {"rows": seen["rows"], "late": seen["late"]})
    return log.select("run_name", "kind", "name", "value")


@register(
    "s15_settings_artifact",
    """SELECT 'depth' AS name, CAST(max(total_items) AS VARCHAR) AS value FROM plain_dataset
       UNION ALL SELECT 'iterations', CAST(count(*) AS VARCHAR) FROM plain_dataset""",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["total_items"])
    seen = df.agg(F.max("total_items").alias("depth"), F.count(F.lit(1)).alias("iterations")).first()
    path = fresh_path(spark, "settings")
    write_settings(spark, seen.asDict(), path)
    return spark.createDataFrame(
        [(k, str(int(v))) for k, v in read_settings(spark, path).items()], "name string, value string"
    )


# ---------------------------------------------------------------- facts
@register(
    "r01_zip_centroids",
    "SELECT zip_code, round(lat, 6) AS lat, round(lng, 6) AS lng FROM centroids",
    "centroids",
)
def _(spark, folder):
    return rounded(facts.zip_centroids(marketplace_from_star(spark, folder).geolocation))


@register(
    "r02_item_summary",
    """SELECT * REPLACE (round(total_price, 2) AS total_price, round(total_freight, 2) AS total_freight,
           round(avg_product_volume_cm3, 6) AS avg_product_volume_cm3, round(avg_product_photos, 6) AS avg_product_photos,
           round(avg_description_length, 6) AS avg_description_length) FROM item_sums""",
    "item_sums",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    return rounded(facts.item_summary(t.order_items, t.products), **MONEY)


@register(
    "r03_payment_summary", "SELECT * REPLACE (round(total_payment, 2) AS total_payment) FROM pay_sums", "pay_sums"
)
def _(spark, folder):
    return rounded(facts.payment_summary(marketplace_from_star(spark, folder).order_payments), **MONEY)


@register(
    "r04_base_orders",
    """SELECT order_id, customer_id, ts AS order_purchase_timestamp, is_late, est AS order_estimated_delivery_date
       FROM delivered_orders""",
    "delivered_orders",
)
def _(spark, folder):
    return facts.base_orders(marketplace_from_star(spark, folder).orders)


@register(
    "r05_late_label",
    """SELECT order_id, CAST(CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END
           AS INTEGER) AS is_late FROM shop_orders""",
    "shop_orders",
)
def _(spark, folder):
    return marketplace_from_star(spark, folder).orders.select(
        "order_id",
        facts.late_label(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")).alias("is_late"),
    )


@register(
    "r06_inner_joins",
    "SELECT order_id, customer_id, seller_id, customer_state, seller_state, is_late FROM located_orders",
    "located_orders",
)
def _(spark, folder):
    df = facts.order_facts(marketplace_from_star(spark, folder), {"items", "customers", "sellers"})
    return df.where("has_customer AND has_seller").select(
        "order_id", "customer_id", "seller_id", "customer_state", "seller_state", "is_late"
    )


@register(
    "r07_left_join_payments",
    """SELECT b.order_id, round(total_payment, 2) AS total_payment, max_installments, primary_payment_type
       FROM delivered_orders b LEFT JOIN pay_sums USING (order_id)""",
    "delivered_orders",
    "pay_sums",
)
def _(spark, folder):
    df = facts.order_facts(marketplace_from_star(spark, folder), {"payments"})
    return rounded(df.select("order_id", "total_payment", "max_installments", "primary_payment_type"), **MONEY)


@register(
    "r08_history_columns",
    """SELECT order_id, round(seller_historical_delay_rate, 6) AS seller_historical_delay_rate,
           round(seller_recent_delay_rate, 6) AS seller_recent_delay_rate, seconds_since_last_seller_order,
           round(route_delay_rate, 6) AS route_delay_rate, customer_total_orders,
           seller_state_backlog, customer_state_backlog FROM analytical""",
    "analytical",
)
def _(spark, folder):
    columns = [
        "order_id", "seller_historical_delay_rate", "seller_recent_delay_rate", "seconds_since_last_seller_order",
        "route_delay_rate", "customer_total_orders", "seller_state_backlog", "customer_state_backlog",
    ]
    return rounded(analytical_dataset(marketplace_from_star(spark, folder), columns))


@register(
    "r09_role_playing_coordinates",
    "SELECT order_id, round(clat, 6) AS customer_lat, round(slat, 6) AS seller_lat FROM located_orders",
    "located_orders",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    points = facts.zip_centroids(t.geolocation)
    orders = facts.order_facts(t, {"items"}).select("order_id", "customer_id", "seller_id")
    customers = facts.located(t.customers, "customer_zip_code_prefix", points, "customer")
    sellers = facts.located(t.sellers, "seller_zip_code_prefix", points, "seller")
    joined = orders.join(customers, "customer_id").join(sellers, "seller_id")
    return rounded(joined.select("order_id", "customer_lat", "seller_lat"))


@register(
    "r10_review_fan_out",
    "SELECT order_id, seller_id, r.review_id, r.review_score FROM sold LEFT JOIN order_reviews r USING (order_id)",
    "sold",
    "order_reviews",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    orders = facts.order_facts(t, {"items", "reviews"}).where("seller_id IS NOT NULL")
    return facts.reviewed_orders(orders.select("order_id", "seller_id", "review_count"), t.order_reviews).drop(
        "review_count"
    )


@register(
    "r11_null_defaults",
    """SELECT order_id, round(coalesce(seller_historical_delay_rate, 0), 6) AS seller_historical_delay_rate,
           coalesce(seconds_since_last_seller_order, 2592000) AS seconds_since_last_seller_order
       FROM plain_dataset JOIN h_seller USING (order_id)""",
    "plain_dataset",
    "h_seller",
)
def _(spark, folder):
    columns = ["order_id", "seller_historical_delay_rate", "seconds_since_last_seller_order"]
    return rounded(analytical_dataset(marketplace_from_star(spark, folder), columns))


@register(
    "r12_same_state",
    "SELECT order_id, is_same_state FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    return analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "is_same_state"])


@register(
    "r13_freight_ratio",
    "SELECT order_id, round(freight_ratio, 6) AS freight_ratio FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "freight_ratio"]))


@register("r14_analytical_dataset", f"SELECT {ROUNDED_ANALYTICAL} FROM analytical", "analytical")
def analytical(spark, folder):
    return rounded(analytical_dataset(marketplace_from_star(spark, folder)), **MONEY)


@register(
    "r14_one_row_per_order",
    "SELECT order_id, is_late, count(*) OVER (PARTITION BY seller_id) AS seller_rows, order_id AS first_order "
    "FROM (SELECT DISTINCT order_id, is_late, seller_id FROM plain_dataset)",
    "plain_dataset",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    one = analytical_dataset(t, ["order_id", "is_late"], dedupe_reviews=True)
    sellers = facts.order_facts(t, {"items"}).select("order_id", "seller_id")
    rows = one.join(sellers, "order_id")
    volumes = rows.groupBy("seller_id").agg(F.count(F.lit(1)).alias("seller_rows"))
    return rows.join(volumes, "seller_id").select("order_id", "is_late", "seller_rows", F.col("order_id").alias("first_order"))


# ---------------------------------------------------------------- histories
def _stored_facts(t, parts, condition):
    """Order facts as the dataset build stores them, with their number of rows."""
    stored = staged(facts.order_facts(t, parts).where(condition), "order-facts")
    return stored, stored.count()


@register(
    "w01_seller_review_average",
    "SELECT order_id, review_id, seller_id, round(seller_avg_review_score, 6) AS seller_avg_review_score FROM h_review",
    "h_review",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    orders, _ = _stored_facts(t, {"items", "reviews"}, "seller_id IS NOT NULL")
    rows = orders.agg(F.sum(F.greatest("review_count", F.lit(1)))).first()[0]
    return rounded(history.seller_review_history(orders, t.order_reviews, at_most=rows).drop("review_count"))


def _register_seller_window(name: str, column: str) -> None:
    value = column if column.startswith("seconds") else f"round({column}, 6)"

    @register(name, f"SELECT order_id, seller_id, {value} AS {column} FROM h_seller", "h_seller")
    def _(spark, folder):
        orders, rows = _stored_facts(marketplace_from_star(spark, folder), {"items"}, "seller_id IS NOT NULL")
        df = orders.selectExpr("*", "0L AS review_count", "true AS has_customer", "true AS has_seller")
        return rounded(history.with_seller_history(df, at_most=rows).select("order_id", "seller_id", column))


_register_seller_window("w02_seller_delay_rate", "seller_historical_delay_rate")
_register_seller_window("w03_seconds_since_last_order", "seconds_since_last_seller_order")
_register_seller_window("w05_seller_recent_delay_rate", "seller_recent_delay_rate")


def _run_by_run(spark, folder, parts, condition, spec):
    """One run a year of purchases, each from the state that the one before left."""
    orders, _ = _stored_facts(marketplace_from_star(spark, folder), parts, condition)
    ends = orders.agg(F.year(F.min(history.TS)).alias("first"), F.year(F.max(history.TS)).alias("last")).first()
    home = fresh_path(spark, "history-state")
    runs = [incremental.advance_stored(orders.where(F.year(history.TS) == y), spec, home) for y in range(ends["first"], ends["last"] + 1)]
    return reduce(DataFrame.unionByName, runs)


@register(
    "w02_run_by_run",
    """SELECT order_id, seller_id, round(seller_historical_delay_rate, 6) AS seller_historical_delay_rate,
           round(seller_recent_delay_rate, 6) AS seller_recent_delay_rate, seconds_since_last_seller_order FROM h_seller""",
    "h_seller",
)
def _(spark, folder):
    rows = _run_by_run(spark, folder, {"items"}, "seller_id IS NOT NULL", incremental.SELLER)
    rates = rows.selectExpr(
        "order_id", "seller_id", "try_divide(CAST(_late AS double), _orders) AS seller_historical_delay_rate",
        "try_divide(CAST(_late5 AS double), _orders5) AS seller_recent_delay_rate", "_last", history.TS,
    )
    return rounded(rates.withColumn("seconds_since_last_seller_order", seconds_between("_last", history.TS)).drop("_last", history.TS))


@register("w04_run_by_run", "SELECT order_id, customer_total_orders FROM h_customer", "h_customer")
def _(spark, folder):
    rows = _run_by_run(spark, folder, {"customers"}, "has_customer", incremental.CUSTOMER)
    return rows.selectExpr("order_id", "_orders + 1 AS customer_total_orders")


@register("w04_customer_orders", "SELECT order_id, customer_total_orders FROM h_customer", "h_customer")
def _(spark, folder):
    orders, rows = _stored_facts(marketplace_from_star(spark, folder), {"customers"}, "has_customer")
    return history.with_customer_history(orders, at_most=rows).select("order_id", "customer_total_orders")


@register(
    "w06_seller_state_backlog",
    "SELECT order_id, seller_state, seller_state_backlog FROM h_seller_backlog",
    "h_seller_backlog",
)
def _(spark, folder):
    orders, rows = _stored_facts(marketplace_from_star(spark, folder), {"items", "sellers"}, "has_seller")
    df = history.with_seller_state_backlog(orders, at_most=rows)
    return df.select("order_id", "seller_state", "seller_state_backlog")


@register(
    "w07_customer_state_backlog",
    "SELECT order_id, customer_state, customer_state_backlog FROM h_customer_backlog",
    "h_customer_backlog",
)
def _(spark, folder):
    orders, rows = _stored_facts(marketplace_from_star(spark, folder), {"customers"}, "has_customer")
    df = history.with_customer_state_backlog(orders, at_most=rows)
    return df.select("order_id", "customer_state", "customer_state_backlog")


@register(
    "w08_route_delay_rate",
    "SELECT order_id, seller_state, customer_state, round(route_delay_rate, 6) AS route_delay_rate FROM h_route",
    "h_route",
)
def _(spark, folder):
    parts = {"items", "sellers", "customers"}
    orders, rows = _stored_facts(marketplace_from_star(spark, folder), parts, "has_customer AND has_seller")
    routed = history.with_route_history(orders, at_most=rows)
    return rounded(routed.select("order_id", "seller_state", "customer_state", "route_delay_rate"))


@register(
    "w09_seller_intensity",
    "SELECT order_id, round(seller_intensity_score, 6) AS seller_intensity_score FROM analytical",
    "analytical",
)
def _(spark, folder):
    return rounded(analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "seller_intensity_score"]))


# ---------------------------------------------------------------- scalar functions
@register(
    "f01_great_circle_km", f"SELECT order_id, round({KM}, 6) AS distance_km FROM located_orders", "located_orders"
)
def _(spark, folder):
    df = facts.order_facts(
        marketplace_from_star(spark, folder), {"items", "customers", "sellers", "coordinates"}
    )
    return rounded(df.where("has_customer AND has_seller").select("order_id", "distance_km"))


@register(
    "f02_purchase_clock",
    "SELECT order_id, purchase_day_of_week, purchase_hour, purchase_month FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    columns = ["order_id", "purchase_day_of_week", "purchase_hour", "purchase_month"]
    return analytical_dataset(marketplace_from_star(spark, folder), columns)


@register(
    "f03_calendar_days",
    "SELECT order_id, seller_shipping_buffer_days, shipping_limit_spread, lead_time_days_estimated FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    columns = ["order_id", "seller_shipping_buffer_days", "shipping_limit_spread", "lead_time_days_estimated"]
    return analytical_dataset(marketplace_from_star(spark, folder), columns)


@register(
    "f04_seconds_between",
    """SELECT order_id, date_diff('second', order_purchase_timestamp, order_delivered_customer_date) AS seconds
       FROM shop_orders""",
    "shop_orders",
)
def _(spark, folder):
    return marketplace_from_star(spark, folder).orders.select(
        "order_id", seconds_between(TS, "order_delivered_customer_date").alias("seconds")
    )


@register(
    "f05_conditionals",
    """SELECT product_id, coalesce(product_photos_qty, 0) AS photos, nullif(product_category_name, '') AS category,
           CAST(CASE WHEN product_photos_qty IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS has_photos FROM products""",
    "products",
)
def _(spark, folder):
    return marketplace_from_star(spark, folder).products.selectExpr(
        "product_id",
        "coalesce(product_photos_qty, 0) AS photos",
        "nullif(product_category_name, '') AS category",
        "CASE WHEN product_photos_qty IS NOT NULL THEN 1 ELSE 0 END AS has_photos",
    )


@register(
    "f06_log1p", "SELECT order_id, round(ln(1 + total_price), 6) AS log_price FROM plain_dataset", "plain_dataset"
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "total_price"])
    return rounded(df.select("order_id", F.log1p("total_price").alias("log_price")))


@register(
    "f07_whole_days",
    """SELECT order_id, CAST(floor(date_diff('second', order_estimated_delivery_date, order_delivered_customer_date)
           / 86400.0) AS BIGINT) AS days FROM shop_orders""",
    "shop_orders",
)
def _(spark, folder):
    return marketplace_from_star(spark, folder).orders.select(
        "order_id",
        whole_days_between("order_estimated_delivery_date", "order_delivered_customer_date").alias("days"),
    )


@register(
    "f08_month_start",
    "SELECT order_id, CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS month FROM shop_orders",
    "shop_orders",
)
def _(spark, folder):
    return marketplace_from_star(spark, folder).orders.select("order_id", month_start(TS).alias("month"))


@register(
    "f09_day_names",
    "SELECT order_id, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][purchase_day_of_week + 1] AS day_name FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "purchase_day_of_week"])
    return df.select("order_id", day_name("purchase_day_of_week").alias("day_name"))


@register(
    "f10_risk_sentences",
    """SELECT product_category_name AS feature, direction,
           CASE product_category_name WHEN '' THEN '' ELSE
             array_to_string(list_transform(string_split(product_category_name, '_'),
               lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS label,
           array_to_string(list_transform(string_split(product_category_name, '_'),
               lambda w: upper(w[1]) || lower(w[2:])), ' ') ||
           CASE WHEN direction = 'increasing' THEN ': This is contributing to a higher risk of delay.'
                WHEN contains(product_category_name, 'buffer') OR contains(product_category_name, 'velocity')
                THEN ': This factor is in an optimal state for on-time delivery.'
                ELSE ': This is significantly helping to keep the delivery on time.' END AS sentence
       FROM (SELECT DISTINCT product_category_name FROM products),
            (SELECT unnest(['increasing', 'decreasing']) AS direction)""",
    "products",
)
def _(spark, folder):
    names = marketplace_from_star(spark, folder).products.select("product_category_name").distinct()
    both = names.selectExpr(
        "product_category_name AS feature", "explode(array('increasing', 'decreasing')) AS direction"
    )
    return both.select(
        "feature",
        "direction",
        feature_label("feature").alias("label"),
        risk_sentence("feature", "direction").alias("sentence"),
    )


@register(
    "f11_four_digits",
    "SELECT order_id, round(freight_ratio, 4) AS ratio FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "freight_ratio"])
    return df.selectExpr("order_id", "round(freight_ratio, 4) AS ratio")
