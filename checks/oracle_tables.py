"""Common table expressions (DuckDB SQL) that every oracle builds on.

``with_tables(final, *names)`` prepends exactly the expressions the final statement needs.
"""

from __future__ import annotations

_STATE = "CASE WHEN {nk} < 6 THEN 'SP' WHEN {nk} < 8 THEN 'RJ' WHEN {nk} = 8 THEN 'MG' ELSE 'N' || {nk} END"


def _days(ts: str, n: str) -> str:
    return f"({ts} + to_days(CAST({n} AS INTEGER)))"


def _seconds(ts: str, n: str) -> str:
    return f"({ts} + to_seconds(CAST({n} AS BIGINT)))"


def _cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def _money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2))"


_EST = _days("base", "12 + (o_custkey * 13 + o_orderkey * 7) % 20")
_DELIVERED = _seconds(_days("base", "2 + (o_orderkey * 31) % 16"), "(o_orderkey * 104729) % 86400")

# name -> (needed names, body)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "nations": ((), f"SELECT n_nationkey, n_name, {_STATE.format(nk='n_nationkey')} AS state FROM nation"),
    "geolocation": (
        ("nations",),
        """SELECT CAST(n_nationkey * 10 + d AS VARCHAR) AS geolocation_zip_code_prefix,
               (-3000 + n_nationkey * 110 + d * 5 + p) / 100.0::DOUBLE AS geolocation_lat,
               (-6000 + (n_nationkey * 7) % 20 * 100 + d * 3 + p) / 100.0::DOUBLE AS geolocation_lng,
               n_name AS geolocation_city, state AS geolocation_state
           FROM nations, (SELECT unnest(range(0, 9))::INTEGER AS d), (SELECT unnest(range(0, 3))::INTEGER AS p)""",
    ),
    "customers": (
        ("nations",),
        """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
               CAST(c_custkey - c_custkey % 2 AS VARCHAR) AS customer_unique_id,
               CAST(c_nationkey * 10 + c_custkey % 10 AS VARCHAR) AS customer_zip_code_prefix,
               n_name AS customer_city, state AS customer_state
           FROM customer JOIN nations ON c_nationkey = n_nationkey""",
    ),
    "sellers": (
        ("nations",),
        """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               CAST(s_nationkey * 10 + s_suppkey % 10 AS VARCHAR) AS seller_zip_code_prefix,
               n_name AS seller_city, state AS seller_state
           FROM supplier JOIN nations ON s_nationkey = n_nationkey""",
    ),
    "products": (
        (),
        """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               CASE WHEN p_partkey % 40 = 0 THEN '' ELSE replace(p_name, ' ', '_') END AS product_category_name,
               CAST(length(p_name) AS INTEGER) AS product_name_lenght,
               CAST(100 + (p_partkey * 7) % 900 AS INTEGER) AS product_description_lenght,
               CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE CAST(1 + p_partkey % 5 AS INTEGER) END AS product_photos_qty,
               CAST(p_size * 50 AS INTEGER) AS product_weight_g,
               CAST(10 + p_partkey % 30 AS INTEGER) AS product_length_cm,
               CAST(5 + p_partkey % 20 AS INTEGER) AS product_height_cm,
               CAST(8 + p_partkey % 15 AS INTEGER) AS product_width_cm
           FROM part WHERE p_partkey % 50 <> 49""",
    ),
    "dated": (
        (),
        "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate + to_days(7670) AS base FROM orders",
    ),
    "shop_orders": (
        ("dated",),
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               CASE WHEN o_orderkey % 25 = 0 THEN 'canceled' ELSE 'delivered' END AS order_status,
               {_seconds('base', '(o_orderkey * 7919) % 86400')} AS order_purchase_timestamp,
               {_seconds('base', '(o_orderkey * 7919) % 86400')} + INTERVAL 1 HOUR AS order_approved_at,
               {_seconds('base', '(o_orderkey * 7919) % 86400')} + INTERVAL 1 DAY AS order_delivered_carrier_date,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {_DELIVERED} END AS order_delivered_customer_date,
               {_EST} AS order_estimated_delivery_date
           FROM dated""",
    ),
    "order_items": (
        ("dated",),
        f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               {_days('base', '2 + (l_partkey + l_linenumber) % 9')} AS shipping_limit_date,
               {_money(_cents('l_extendedprice'))} AS price,
               {_money(f'({_cents("l_extendedprice")} * ({_cents("l_tax")} + 2) + 50) // 100')} AS freight_value
           FROM lineitem JOIN dated ON l_orderkey = o_orderkey""",
    ),
    "order_payments": (
        ("dated",),
        f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(n AS INTEGER) AS payment_sequential,
               CASE (o_orderkey + n) % 4 WHEN 0 THEN 'boleto' WHEN 1 THEN 'credit_card'
                    WHEN 2 THEN 'debit_card' ELSE 'voucher' END AS payment_type,
               CAST(1 + (o_orderkey * n) % 12 AS INTEGER) AS payment_installments,
               {_money(f'{_cents("o_totalprice")} // (1 + o_orderkey % 3)')} AS payment_value
           FROM dated, (SELECT unnest(range(1, 4)) AS n) WHERE n <= 1 + o_orderkey % 3""",
    ),
    "order_reviews": (
        ("dated",),
        f"""SELECT CAST(o_orderkey * 2 + s AS VARCHAR) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
               CAST(1 + (o_orderkey * CASE WHEN s = 0 THEN 17 ELSE 11 END) % 5 AS INTEGER) AS review_score,
               CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'title ' || o_orderkey END AS review_comment_title,
               'said "ok", order ' || o_orderkey || chr(10) || 'second line' AS review_comment_message,
               {_EST} AS review_creation_date,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {_days(_EST, '1 + o_orderkey % 4')} END
                   AS review_answer_timestamp
           FROM dated, (SELECT unnest(range(0, 2)) AS s)
           WHERE (s = 0 AND o_orderkey % 7 <> 0) OR (s = 1 AND o_orderkey % 50 = 1)""",
    ),
    "category_names": (
        (),
        """SELECT DISTINCT replace(p_name, ' ', '_') AS product_category_name,
               p_name AS product_category_name_english FROM part""",
    ),
}


def define(name: str, body: str, *needs: str) -> None:
    if name in TABLES:
        raise ValueError(f"{name} is defined twice")
    TABLES[name] = (needs, body)


def with_tables(final: str, *names: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in TABLES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in ordered) + "\n" + final
