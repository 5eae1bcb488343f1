"""Oracle expressions for facts, histories, the analytical dataset and features."""

from __future__ import annotations

from checks.oracle_tables import define

define(
    "centroids",
    """SELECT geolocation_zip_code_prefix AS zip_code, avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng
       FROM geolocation GROUP BY 1""",
    "geolocation",
)
define(
    "item_sums",
    """SELECT i.order_id, count(i.order_item_id) AS total_items,
           CAST(sum(i.price) AS DOUBLE) AS total_price, CAST(sum(i.freight_value) AS DOUBLE) AS total_freight,
           max(i.seller_id) AS seller_id, max(p.product_category_name) AS product_category,
           CAST(sum(p.product_weight_g) AS BIGINT) AS total_weight_g,
           avg(p.product_length_cm::BIGINT * p.product_height_cm * p.product_width_cm) AS avg_product_volume_cm3,
           avg(coalesce(p.product_photos_qty, 0)) AS avg_product_photos,
           avg(coalesce(p.product_description_lenght, 0)) AS avg_description_length,
           date_diff('day', min(i.shipping_limit_date)::DATE, max(i.shipping_limit_date)::DATE)::INTEGER
               AS shipping_limit_spread,
           max(i.shipping_limit_date) AS max_shipping_limit_date
       FROM order_items i JOIN products p ON p.product_id = i.product_id GROUP BY i.order_id""",
    "order_items",
    "products",
)
define(
    "pay_sums",
    """SELECT order_id, CAST(sum(payment_value) AS DOUBLE) AS total_payment,
           max(payment_installments) AS max_installments, max(payment_type) AS primary_payment_type
       FROM order_payments GROUP BY order_id""",
    "order_payments",
)
define(
    "delivered_orders",
    """SELECT order_id, customer_id, order_purchase_timestamp AS ts,
           CAST(CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS INTEGER)
               AS is_late,
           order_estimated_delivery_date AS est
       FROM shop_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL""",
    "shop_orders",
)
define(
    "sold",
    "SELECT b.order_id, b.ts, b.is_late, i.seller_id FROM delivered_orders b JOIN item_sums i USING (order_id)",
    "delivered_orders",
    "item_sums",
)
define(
    "sold_states",
    "SELECT x.*, s.seller_state FROM sold x JOIN sellers s USING (seller_id)",
    "sold",
    "sellers",
)
define(
    "bought",
    """SELECT b.order_id, b.ts, b.is_late, c.customer_unique_id, c.customer_state
       FROM delivered_orders b JOIN customers c USING (customer_id)""",
    "delivered_orders",
    "customers",
)
_PAST = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
define(
    "h_review",
    f"""SELECT x.order_id, coalesce(r.review_id, '') AS review_id, x.seller_id,
           avg(r.review_score) OVER (PARTITION BY x.seller_id ORDER BY x.ts, x.order_id, coalesce(r.review_id, '') {_PAST})
               AS seller_avg_review_score
       FROM sold x LEFT JOIN order_reviews r USING (order_id)""",
    "sold",
    "order_reviews",
)
define(
    "h_seller",
    f"""SELECT order_id, seller_id,
           avg(is_late) OVER (w {_PAST}) AS seller_historical_delay_rate,
           avg(is_late) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS seller_recent_delay_rate,
           date_diff('second', lag(ts) OVER w, ts) AS seconds_since_last_seller_order
       FROM sold WINDOW w AS (PARTITION BY seller_id ORDER BY ts, order_id)""",
    "sold",
)
define(
    "h_customer",
    f"""SELECT order_id, count(*) OVER (PARTITION BY customer_unique_id ORDER BY ts, order_id {_PAST}) + 1
           AS customer_total_orders FROM bought""",
    "bought",
)
define(
    "h_seller_backlog",
    """SELECT order_id, seller_state, count(*) OVER (PARTITION BY seller_state ORDER BY ts
           RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 SECOND PRECEDING) AS seller_state_backlog
       FROM sold_states""",
    "sold_states",
)
define(
    "h_customer_backlog",
    """SELECT order_id, customer_state, count(*) OVER (PARTITION BY customer_state ORDER BY ts
           RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 SECOND PRECEDING) AS customer_state_backlog
       FROM bought""",
    "bought",
)
define(
    "h_route",
    f"""SELECT order_id, seller_state, customer_state,
           avg(is_late) OVER (PARTITION BY seller_state, customer_state ORDER BY ts, order_id {_PAST})
               AS route_delay_rate
       FROM sold_states JOIN bought USING (order_id, ts, is_late)""",
    "sold_states",
    "bought",
)
define(
    "located_orders",
    """SELECT b.*, c.customer_city, c.customer_state, s.seller_city, s.seller_state, i.* EXCLUDE (order_id),
           gc.lat AS clat, gc.lng AS clng, gs.lat AS slat, gs.lng AS slng
       FROM delivered_orders b JOIN customers c USING (customer_id) JOIN item_sums i USING (order_id)
       JOIN sellers s USING (seller_id)
       LEFT JOIN centroids gc ON gc.zip_code = c.customer_zip_code_prefix
       LEFT JOIN centroids gs ON gs.zip_code = s.seller_zip_code_prefix""",
    "delivered_orders",
    "customers",
    "item_sums",
    "sellers",
    "centroids",
)
# NULL stays NULL here: DuckDB's least() would skip it.
_ROOT = """sqrt(pow(sin(radians(clat - slat) / 2), 2)
    + cos(radians(clat)) * cos(radians(slat)) * pow(sin(radians(clng - slng) / 2), 2))"""
KM = f"12742 * asin(CASE WHEN {_ROOT} > 1 THEN 1.0 ELSE {_ROOT} END)"

# The dataset without histories: one row per order and review.
define(
    "plain_dataset",
    f"""SELECT o.order_id, o.customer_id, o.customer_city, o.customer_state, o.seller_city, o.seller_state,
           CAST(CASE WHEN o.customer_state = o.seller_state THEN 1 ELSE 0 END AS INTEGER) AS is_same_state,
           {KM} AS distance_km, o.is_late, o.ts AS order_purchase_timestamp,
           CAST(isodow(o.ts) - 1 AS INTEGER) AS purchase_day_of_week, CAST(hour(o.ts) AS INTEGER) AS purchase_hour,
           CAST(month(o.ts) AS INTEGER) AS purchase_month,
           o.total_items, o.total_price, o.total_freight, o.total_weight_g, o.avg_product_volume_cm3,
           o.total_freight / nullif(o.total_price, 0) AS freight_ratio, o.product_category,
           p.total_payment, p.max_installments, p.primary_payment_type, o.avg_product_photos, o.avg_description_length,
           date_diff('day', o.ts::DATE, o.max_shipping_limit_date::DATE)::INTEGER AS seller_shipping_buffer_days,
           o.shipping_limit_spread,
           date_diff('day', o.ts::DATE, o.est::DATE)::INTEGER AS lead_time_days_estimated,
           o.seller_id, coalesce(r.review_id, '') AS review_id
       FROM located_orders o LEFT JOIN pay_sums p USING (order_id) LEFT JOIN order_reviews r USING (order_id)""",
    "located_orders",
    "pay_sums",
    "order_reviews",
)
define(
    "analytical",
    """SELECT d.* EXCLUDE (seller_id, review_id),
           coalesce(hs.seller_historical_delay_rate, 0) AS seller_historical_delay_rate,
           coalesce(hr.seller_avg_review_score, 0) AS seller_avg_review_score,
           coalesce(sb.seller_state_backlog, 0) AS seller_state_backlog,
           coalesce(cb.customer_state_backlog, 0) AS customer_state_backlog,
           coalesce(hc.customer_total_orders, 1) AS customer_total_orders,
           coalesce(hs.seller_recent_delay_rate, 0) AS seller_recent_delay_rate,
           coalesce(hs.seconds_since_last_seller_order, 2592000) AS seconds_since_last_seller_order,
           coalesce(sb.seller_state_backlog, 0)::DOUBLE / count(*) OVER (PARTITION BY d.seller_id) AS seller_intensity_score,
           coalesce(rd.route_delay_rate, 0) AS route_delay_rate
       FROM plain_dataset d
       LEFT JOIN h_seller hs USING (order_id)
       LEFT JOIN h_review hr ON hr.order_id = d.order_id AND hr.review_id = d.review_id
       LEFT JOIN h_seller_backlog sb ON sb.order_id = d.order_id
       LEFT JOIN h_customer_backlog cb ON cb.order_id = d.order_id
       LEFT JOIN h_customer hc ON hc.order_id = d.order_id
       LEFT JOIN h_route rd ON rd.order_id = d.order_id""",
    "plain_dataset",
    "h_seller",
    "h_review",
    "h_seller_backlog",
    "h_customer_backlog",
    "h_customer",
    "h_route",
)
ROUNDED_ANALYTICAL = """* REPLACE (
    round(distance_km, 6) AS distance_km, round(freight_ratio, 6) AS freight_ratio,
    round(avg_product_volume_cm3, 6) AS avg_product_volume_cm3, round(avg_product_photos, 6) AS avg_product_photos,
    round(avg_description_length, 6) AS avg_description_length,
    round(seller_historical_delay_rate, 6) AS seller_historical_delay_rate,
    round(seller_avg_review_score, 6) AS seller_avg_review_score,
    round(seller_recent_delay_rate, 6) AS seller_recent_delay_rate,
    round(seller_intensity_score, 6) AS seller_intensity_score, round(route_delay_rate, 6) AS route_delay_rate,
    round(total_price, 2) AS total_price, round(total_freight, 2) AS total_freight,
    round(total_payment, 2) AS total_payment)"""
