"""Building blocks of the SQL answers (DuckDB)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from marketloom import lookups
from marketloom.bindings import ctes, messy, star


# --- expressions ------------------------------------------------------------------------------

def pct(n: str, d: str) -> str:
    """100 n / d for counts, rounded half up to two places in whole numbers."""
    return f"CAST((20000 * CAST({n} AS BIGINT) + ({d})) // NULLIF(2 * ({d}), 0) AS DOUBLE) / 100"


def mean2(total: str, n: str) -> str:
    """total / n for whole numbers, rounded half up to two places."""
    return f"CAST((200 * CAST({total} AS BIGINT) + ({n})) // NULLIF(2 * ({n}), 0) AS DOUBLE) / 100"


def money_pct(a: str, b: str) -> str:
    return f"ROUND(100 * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 2)"


def money_mean(a: str, n: str) -> str:
    return f"ROUND(CAST({a} AS DOUBLE) / NULLIF({n}, 0), 0)"


def dbl(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


def big(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


def literal(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def label_case(column: str, labels: Mapping[str, Sequence[str]], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN LOWER(TRIM({column})) IN ({', '.join(map(literal, forms))}) THEN {literal(label)}"
                    for label, forms in labels.items())
    return f"CASE {arms} ELSE {default} END"


def mixed_ts(column: str) -> str:
    return (f"CASE WHEN {column} LIKE '__/__/____ __:__' THEN TRY_STRPTIME({column}, '%d/%m/%Y %H:%M') "
            f"ELSE TRY_STRPTIME({column}, '%Y-%m-%d %H:%M:%S') END")


def mixed_date(column: str) -> str:
    return (f"CAST(CASE WHEN {column} LIKE '__/__/____' THEN TRY_STRPTIME({column}, '%d/%m/%Y') "
            f"ELSE TRY_STRPTIME({column}, '%Y-%m-%d') END AS DATE)")


def iso_date(column: str) -> str:
    return f"CAST(TRY_STRPTIME(TRIM({column}), '%Y-%m-%d') AS DATE)"


# --- whole answers ----------------------------------------------------------------------------

def answer(select: str, *parts: str | Iterable[str]) -> str:
    flat: list[str] = []
    for part in parts:
        flat += [part] if isinstance(part, str) else list(part)
    return "WITH " + ",\n".join(dict.fromkeys(flat)) + "\n" + select


def on_star(select: str, *names: str, extra: Iterable[str] = ()) -> str:
    return answer(select, ctes(star.TABLES, names), extra)


def on_raw(select: str, *names: str, extra: Iterable[str] = ()) -> str:
    return answer(select, ctes(messy.TABLES, names), extra)


# --- the fact and the dimension ---------------------------------------------------------------

AS_OF = f"DATE '{star.RULES.as_of.isoformat()}'"
_FACT = """fact_base AS (
    SELECT o.*, DATE_TRUNC('month', o.order_date)::DATE AS order_month, s.items_count, s.units, s.gmv, s.cogs,
           s.list_value - s.gmv AS discount_value, COALESCE(b.n, 0) AS returned_items,
           COALESCE(b.refunds, 0) AS refunded_value,
           CASE o.order_status WHEN 'Delivered' THEN s.gmv - COALESCE(b.refunds, 0) ELSE 0 END AS net_revenue,
           DATE_DIFF('day', o.order_date, o.promised_date) AS promised_days,
           o.order_status = 'Delivered' AND o.delivered_at IS NOT NULL AS arrived,
           o.order_status = 'Returned to Origin' AS is_rto
    FROM clean_orders o
    JOIN (SELECT i.order_id, COUNT(*) AS items_count, SUM(i.quantity) AS units, SUM(i.quantity * i.unit_price) AS gmv,
                 SUM(i.quantity * p.unit_cost) AS cogs, SUM(i.quantity * p.list_price) AS list_value
          FROM order_items i JOIN products p USING (product_id) GROUP BY ALL) s USING (order_id)
    LEFT JOIN (SELECT order_id, COUNT(*) AS n, SUM(refund_amount) AS refunds FROM returns GROUP BY ALL) b USING (order_id))""", \
    """fact AS (
    SELECT * EXCLUDE (arrived),
           CASE WHEN arrived THEN DATE_DIFF('day', order_date, delivered_at::DATE) END AS delivery_days,
           CASE WHEN arrived THEN COALESCE(delivered_at::DATE > promised_date, FALSE) END AS is_late,
           ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ordered_at, order_id) AS customer_order_seq,
           order_status IN ('Delivered', 'Returned to Origin') AS shipped
    FROM fact_base)"""
FACT = (*ctes(star.TABLES, star.ORDER_TABLES), *_FACT)

CODES = ", ".join(map(literal, star.RULES.mega_sale_codes))
DIM = (*FACT, *ctes(star.TABLES, ["customers"]), f"""history AS (
    SELECT customer_id, MAX(order_date) FILTER (customer_order_seq = 1) AS first_order_date,
           MAX(order_month) FILTER (customer_order_seq = 1) AS cohort_month,
           MAX(promo_code) FILTER (customer_order_seq = 1) AS first_promo_code,
           MAX(order_status) FILTER (customer_order_seq = 1) AS first_order_status,
           MAX(payment_group) FILTER (customer_order_seq = 1) AS first_payment_group,
           BOOL_OR(is_late) FILTER (customer_order_seq = 1) AS first_order_late,
           MAX(order_date) FILTER (customer_order_seq = 2) AS second_order_date,
           COUNT(*) AS orders, COUNT(*) FILTER (order_status = 'Delivered') AS delivered_orders,
           SUM(net_revenue) AS net_revenue, MAX(order_date) AS last_order_date
    FROM fact GROUP BY customer_id)""", f"""dim AS (
    SELECT c.customer_id, c.signup_date, c.city, c.province, c.city_tier, c.acquisition_channel, c.device_type,
           h.first_order_date, h.cohort_month, h.first_promo_code,
           COALESCE(h.first_promo_code IN ({CODES}), FALSE) AS acquired_in_mega_sale,
           h.first_order_status, h.first_payment_group, h.first_order_late, h.second_order_date,
           CASE WHEN {AS_OF} - h.first_order_date >= 90
                THEN COALESCE(h.second_order_date - h.first_order_date <= 90, FALSE) END AS repeat_within_90d,
           COALESCE(h.orders, 0) AS orders, COALESCE(h.delivered_orders, 0) AS delivered_orders,
           COALESCE(h.net_revenue, 0) AS net_revenue, h.last_order_date
    FROM customers c LEFT JOIN history h USING (customer_id))""")


def on_fact(select: str, *extra: str) -> str:
    return answer(select, FACT, extra)


def on_dim(select: str, *extra: str) -> str:
    return answer(select, DIM, extra)


# --- the clean layer --------------------------------------------------------------------------

CITY_MAP = "city_map(raw_key, city, province, city_tier) AS (VALUES " + ", ".join(
    f"({literal(s)}, {literal(city)}, {literal(province)}, {tier})"
    for city, (province, tier, spellings) in lookups.CITIES.items() for s in spellings) + ")"

ID_MAP = f"""id_map AS (
    SELECT customer_id AS raw_customer_id, FIRST_VALUE(customer_id) OVER (
               PARTITION BY LOWER(TRIM(email)) ORDER BY {iso_date('signup_date')} NULLS LAST, customer_id) AS customer_id
    FROM raw_customers WHERE customer_id NOT ILIKE 'test%' AND email IS NOT NULL)"""

# A person is an email address; the account that speaks for it is the one with the least (day, id).
CLEAN_CUSTOMERS = f"""clean_customers AS (
    WITH accounts AS (
        SELECT *, {iso_date('signup_date')} AS day FROM raw_customers WHERE NOT STARTS_WITH(LOWER(customer_id), 'test')),
    persons AS (
        SELECT TRIM(LOWER(email)) AS address, ARG_MIN(accounts, (COALESCE(day, DATE '9999-12-31'), customer_id)) AS a
        FROM accounts GROUP BY address HAVING address IS NOT NULL)
    SELECT a.customer_id AS customer_id, address AS email, a.day AS signup_date, city_map.city, province, city_tier,
           {label_case('a.acquisition_channel', lookups.CHANNELS, 'TRIM(a.acquisition_channel)')} AS acquisition_channel,
           a.device_type AS device_type
    FROM persons LEFT JOIN city_map ON raw_key = TRIM(LOWER(a.city)))"""

CLEAN_PRODUCTS = f"""clean_products AS (
    SELECT product_id, product_name,
           {label_case("REGEXP_REPLACE(category, ' and ', ' & ', 'gi')", lookups.CATEGORIES)} AS category,
           subcategory, brand, seller_id, TRY_CAST(list_price AS DECIMAL(14,2)) AS list_price,
           TRY_CAST(unit_cost AS DECIMAL(14,2)) AS unit_cost
    FROM raw_products)"""

PARSED_ORDERS = f"""parsed_orders AS (
    SELECT order_id, customer_id, {mixed_ts('order_datetime')} AS ordered_at, LOWER(TRIM(shipping_city)) AS city_key,
           {label_case('payment_method', lookups.PAYMENT_METHODS)} AS payment_method,
           {label_case('payment_method', lookups.PAYMENT_GROUPS, "'Prepaid'")} AS payment_group,
           NULLIF(NULLIF(UPPER(TRIM(promo_code)), ''), 'NONE') AS promo_code, courier,
           {mixed_date('promised_delivery_date')} AS promised_date, {mixed_ts('delivered_at')} AS delivered_raw,
           {label_case('order_status', lookups.ORDER_STATUSES)} AS order_status,
           TRY_CAST(REPLACE(REPLACE(shipping_fee, 'Rs.', ''), ' ', '') AS BIGINT) AS shipping_fee
    FROM (SELECT DISTINCT * FROM raw_orders) WHERE customer_id NOT ILIKE 'test%')"""

CLEAN_ORDERS = """clean_orders AS (
    SELECT p.order_id, COALESCE(i.customer_id, p.customer_id) AS customer_id, p.ordered_at,
           p.ordered_at::DATE AS order_date, COALESCE(m.city, c.city) AS city,
           COALESCE(m.province, c.province) AS province, COALESCE(m.city_tier, c.city_tier) AS city_tier,
           p.payment_method, p.payment_group, p.promo_code, p.courier, p.promised_date,
           CASE WHEN p.delivered_raw < p.ordered_at THEN NULL ELSE p.delivered_raw END AS delivered_at,
           COALESCE(p.delivered_raw < p.ordered_at, FALSE) AS delivered_before_ordered,
           p.order_status, p.shipping_fee,
           COALESCE(p.ordered_at < TIMESTAMP '1998-01-01 00:00:00', FALSE) AS from_legacy_system
    FROM parsed_orders p LEFT JOIN id_map i ON i.raw_customer_id = p.customer_id
    LEFT JOIN clean_customers c ON c.customer_id = i.customer_id
    LEFT JOIN city_map m ON m.raw_key = p.city_key)"""

CLEAN_ITEMS = """clean_items AS (
    SELECT order_item_id, order_id, product_id, quantity, discount_pct,
           CAST(CASE WHEN price > 50 * list_price THEN price / 100 WHEN price > 5 * list_price THEN price / 10
                     ELSE price END + 0.0000001 AS DECIMAL(14,2)) AS unit_price,
           COALESCE(price > 5 * list_price, FALSE) AS price_corrected
    FROM (SELECT i.order_item_id, i.order_id, i.product_id, TRY_CAST(i.quantity AS BIGINT) AS quantity,
                 TRY_CAST(i.unit_price AS DECIMAL(14,2)) AS price, TRY_CAST(i.discount_pct AS BIGINT) AS discount_pct,
                 p.list_price
          FROM raw_order_items i JOIN clean_products p USING (product_id))
    WHERE quantity > 0 AND order_id IN (SELECT order_id FROM clean_orders))"""

CLEAN_RETURNS = f"""clean_returns AS (
    SELECT * REPLACE (TRIM(return_reason) AS return_reason, {iso_date('return_requested_date')} AS return_requested_date,
                      TRY_CAST(refund_amount AS DECIMAL(14,2)) AS refund_amount)
    FROM (SELECT COLUMNS(* EXCLUDE (order_id)) FROM raw_returns) NATURAL JOIN (SELECT order_item_id, order_id FROM clean_items))"""

CLEAN_SESSIONS = """clean_sessions AS (
    SELECT *, IFNULL(session_duration_sec < 3, FALSE) AS is_bot
    FROM (SELECT * REPLACE (TRY_STRPTIME(session_start, '%Y-%m-%d %H:%M:%S') AS session_start,
                            TRIM(LOWER(experiment_group)) AS experiment_group,
                            TRY_CAST(session_duration_sec AS BIGINT) AS session_duration_sec,
                            TRY_CAST(completed_order AS BIGINT) AS completed_order,
                            TRY_CAST(order_value AS DECIMAL(14,2)) AS order_value) FROM raw_sessions)
    GROUP BY ALL)"""

_RAW = ("raw_customers", "raw_products", "raw_orders", "raw_order_items", "raw_returns", "raw_sessions")
UP_TO_CUSTOMERS = (*ctes(messy.TABLES, ["raw_customers"]), CITY_MAP, ID_MAP, CLEAN_CUSTOMERS)
UP_TO_ORDERS = (*UP_TO_CUSTOMERS, *ctes(messy.TABLES, ["raw_orders"]), PARSED_ORDERS, CLEAN_ORDERS)
UP_TO_ITEMS = (*UP_TO_ORDERS, *ctes(messy.TABLES, ["raw_products", "raw_order_items"]), CLEAN_PRODUCTS, CLEAN_ITEMS)
ALL_CLEAN = (*UP_TO_ITEMS, *ctes(messy.TABLES, ["raw_returns", "raw_sessions"]), CLEAN_RETURNS, CLEAN_SESSIONS)


def typed(columns: str) -> str:
    """Select list; ``name:d`` casts to double, ``name:b`` to bigint."""
    casts = {"d": dbl, "b": big}
    out = []
    for c in columns.split():
        name, _, kind = c.partition(":")
        out.append(f"{casts[kind](name)} AS {name}" if kind else name)
    return ", ".join(out)
