"""DuckDB SQL for the test-table bindings (written independently of the Spark code).

Each entry is a SELECT over the driver's pre-registered views; ``with_bindings(sql, names)``
prefixes a query with the CTEs it uses.
"""

from __future__ import annotations

import re

from cohortflow import rules as R
from cohortflow.sources.testbed import (B_MERCHANT_PREFIX, CHILD_PRODUCT, COUNTRY, CREDIT_TYPES, OTHER_PLACE,
                                        PLACE_NAMES, TAG_NAMES)

LINES = "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"
TS_ORDER = "l.l_shipdate + to_hours(CAST(l.l_linenumber * 3 + l.l_orderkey % 3 AS BIGINT))"
PRICE = "CAST(l.l_extendedprice AS DECIMAL(12,2))"
DISC = "CAST(l.l_discount AS DECIMAL(4,2))"
TAX = "CAST(l.l_tax AS DECIMAL(4,2))"
G = "0.000244140625"


def _le(bits: str) -> str:
    be = f"lpad(hex({bits}), 16, '0')"
    return "(" + " || ".join(f"substr({be}, {15 - 2 * i}, 2)" for i in range(8)) + ")"


def _ewkb(lat_k: str, lon_k: str) -> str:
    lat_bits = f"(CAST({1027 * 2**52 + 9 * 2**48} AS BIGINT) + CAST({lat_k} AS BIGINT) * CAST({2**36} AS BIGINT))"
    lon_bits = f"(CAST({1028 * 2**52 + 23 * 2**47} AS BIGINT) + CAST({lon_k} AS BIGINT) * CAST({2**35} AS BIGINT))"
    return f"('0101000020E6100000' || {_le(lon_bits)} || {_le(lat_bits)})"


_name_case = "CASE event_id % 12 " + " ".join(
    f"WHEN {i} THEN {'NULL' if n is None else repr(n)}" for i, n in enumerate(PLACE_NAMES)) + " END"
_tag_values = ", ".join(
    f"({i}, '{n}', '{'dietary' if i in (20, 21) else 'cuisine'}')" for i, n in enumerate(TAG_NAMES))

B = {
    "b_orders": f"""
SELECT o.o_custkey AS customer_id, l.l_orderkey AS order_id, l.l_linenumber AS line_no,
       CAST(1 + (l.l_orderkey % 5) % 3 AS INTEGER) AS city_id, l.l_suppkey AS merchant_id,
       CASE WHEN s.s_suppkey % 4 = 0 THEN '{B_MERCHANT_PREFIX}' || s.s_name ELSE s.s_name END AS merchant_name,
       'Brand#' || CAST(l.l_suppkey % 7 AS VARCHAR) AS brand_name,
       CASE WHEN l.l_returnflag = 'N' THEN 'food' ELSE 'shops' END AS order_type,
       CASE WHEN l.l_linestatus = 'F' AND l.l_orderkey % 3 = 0 THEN 'DELIVERED'
            WHEN l.l_linestatus = 'F' THEN 'delivered' ELSE 'cancelled' END AS order_status,
       {TS_ORDER} AS order_received_timestamp,
       CAST(l.l_shipdate AS DATE) AS day,
       CASE WHEN l.l_discount >= 0.05 THEN 'SAVE' || CAST(l.l_orderkey % 5 AS VARCHAR) END AS promo_code,
       CASE WHEN l.l_discount >= 0.08 THEN 'percent' WHEN l.l_discount >= 0.05 THEN 'flat' END AS promo_type,
       l.l_discount AS promo_applied_value,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS basket_amount,
       CAST({PRICE} * {DISC} AS DECIMAL(18,4)) AS promo_amount,
       CAST({PRICE} * CAST(1 - {DISC} AS DECIMAL(4,2)) * CAST(1 + {TAX} AS DECIMAL(4,2)) AS DECIMAL(18,6)) AS net_basket_amount_with_tax,
       CAST({PRICE} * CAST(1 - {DISC} AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS net_revenue,
       CAST(l.l_linenumber AS DECIMAL(18,2)) AS delivery_fee,
       CAST({PRICE} * CAST(1 + {TAX} AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS gmv,
       CAST(CASE WHEN l.l_orderkey % 7 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS member_discount
FROM {LINES} JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "b_merchants": "SELECT s_suppkey AS merchant_id, s_name AS merchant_name FROM supplier WHERE s_nationkey < 12",
    "b_customers": "SELECT c_custkey AS customer_id, c_nationkey < 20 AS is_resident FROM customer",
    "b_value_lines": f"""
SELECT o.o_custkey AS customer_id, l.l_orderkey AS order_id, {TS_ORDER} AS order_received_timestamp,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gtv,
       CAST({PRICE} * CAST(0.5 AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS cogs,
       CAST({PRICE} * {TAX} AS DECIMAL(18,4)) AS partner_share
FROM {LINES}""",
    "b_order_level": """
SELECT o_custkey AS customer_id, o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS day,
       CAST(o_totalprice AS DECIMAL(18,2)) AS gmv,
       CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.2 AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS net_revenue,
       CAST(-(o_orderkey % 10) AS DECIMAL(18,2)) AS delivery_costs,
       CAST(-(o_custkey % 3) AS DECIMAL(18,2)) AS wastage
FROM orders""",
    "b_trips": f"""
SELECT CAST(l.l_shipdate AS DATE) AS day, CAST(o.o_custkey AS VARCHAR) AS customer_id,
       l.l_orderkey * 10 + l.l_linenumber AS booking_id, l.l_orderkey * 10 + l.l_linenumber AS trip_id,
       CASE WHEN l.l_partkey % 50 = 0 THEN NULL ELSE l.l_suppkey END AS captain_id,
       CASE WHEN l.l_partkey % 13 = 0 THEN 2 ELSE 1 END AS service_area_id,
       CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 4 ELSE 3 END AS trip_outcome,
       CASE WHEN l.l_quantity < 3 THEN 0 ELSE 1 END AS is_valid,
       CASE WHEN l.l_orderkey % 101 = 0 THEN 0.0::DOUBLE ELSE 25.0::DOUBLE + (l.l_partkey % 83) * 0.003::DOUBLE END
           AS pick_up_latitude,
       55.0::DOUBLE + (l.l_suppkey % 89) * 0.003::DOUBLE AS pick_up_longitude,
       25.0::DOUBLE + (l.l_orderkey % 97) * 0.002::DOUBLE AS drop_off_latitude,
       55.0::DOUBLE + (o.o_custkey % 89) * 0.002::DOUBLE AS drop_off_longitude,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Ride Hailing' WHEN '2-HIGH' THEN 'JV' WHEN '3-MEDIUM' THEN 'Hala'
            WHEN '4-NOT SPECIFIED' THEN 'ride-hailing' ELSE 'Delivery' END AS business_type,
       CASE WHEN p.p_size = 1 THEN 'TEST ride' WHEN p.p_size % 10 = 3 THEN '{CHILD_PRODUCT}'
            WHEN p.p_size % 10 = 7 THEN 'School Rides' ELSE p.p_type END AS cct,
       CAST(p.p_partkey AS INTEGER) AS cct_id,
       CASE WHEN o.o_custkey % 17 = 0 THEN '{OTHER_PLACE}' ELSE '{COUNTRY}' END AS country,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS revenue,
       CAST({PRICE} * {DISC} AS DECIMAL(18,4)) AS cogs,
       l.l_shipdate + to_hours(CAST((l.l_orderkey * 7 + l.l_linenumber * 5) % 24 AS BIGINT)) AS booking_date,
       'app' AS booking_platform,
       l.l_quantity / 2.0 AS distance_travelled,
       l.l_quantity * 0.75 AS duration_time,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS trip_price,
       CASE WHEN o.o_orderkey % 3 = 0 THEN ' Card ' WHEN o.o_orderkey % 3 = 1 THEN 'CASH' ELSE 'Wallet' END
           AS customer_payment_selection,
       CASE WHEN l.l_discount >= 0.06 THEN 'RIDE' || CAST(l.l_linenumber AS VARCHAR)
            WHEN l.l_discount = 0.0 THEN NULL ELSE '' END AS booking_promo_code
FROM {LINES} JOIN part p ON l.l_partkey = p.p_partkey""",
    "b_credits": f"""
SELECT l_orderkey * 10 + l_linenumber AS booking_id, CAST(l_shipdate AS DATE) AS day,
       CASE WHEN l_returnflag = 'N' THEN 'Voucher' WHEN l_partkey % 3 = 0 THEN 'Marketing Credits' ELSE 'Refund' END AS credit_title,
       CASE l_suppkey % 4 WHEN 0 THEN '{CREDIT_TYPES[0]}' WHEN 1 THEN '{CREDIT_TYPES[1]}' WHEN 2 THEN 'cashback'
            ELSE '{CREDIT_TYPES[2]}' END AS credit_type
FROM lineitem""",
    "b_first_orders": f"""
SELECT CAST(o.o_custkey AS VARCHAR) AS userid, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS first_order_date,
       CASE p.p_type WHEN 'PROMO' THEN '{R.A_SERVICES[0]}' WHEN 'SMALL' THEN '{R.B_SERVICES[0]}'
            WHEN 'LARGE' THEN '{R.BASE_SERVICES[1]}' ELSE '{R.BASE_SERVICES[0]}' END AS service,
       CASE WHEN l.l_suppkey % 10 = 0 OR p.p_size <= 25 THEN '{OTHER_PLACE}' ELSE '{R.HOME_CITY}' END AS city
FROM {LINES} JOIN part p ON l.l_partkey = p.p_partkey""",
    "b_subscription_events": """
SELECT 'CPLS-' || CAST(o_custkey AS VARCHAR) AS userid,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Regular' WHEN '2-HIGH' THEN 'Free Trial'
            WHEN '3-MEDIUM' THEN 'Trial_No_Commitment' WHEN '4-NOT SPECIFIED' THEN 'Monthly' ELSE 'annual' END
           AS subscriptiontype,
       CAST(o_orderkey % 70 AS VARCHAR) AS planid,
       CASE WHEN o_orderkey % 11 = 0 THEN 'INV-FREE-RENEWAL-' || CAST(o_orderkey AS VARCHAR)
            WHEN o_orderkey % 13 = 0 THEN 'inv_freeXrenewal' ELSE 'inv-' || CAST(o_orderkey AS VARCHAR) END AS invoiceid,
       CASE WHEN o_orderstatus = 'F' THEN 'Subscription_Started' ELSE 'subscription_renewed' END AS eventtype,
       CAST((o_custkey % 3) * 10 + 1 AS VARCHAR) AS serviceareaid,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS startedat,
       CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS VARCHAR) AS expiresat,
       CAST(o_orderdate AS DATE) AS day, o_orderkey AS event_seq
FROM orders""",
    "b_profile": """
SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, n.n_name AS nationality,
       CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS nationality_score,
       r.r_name AS region, r.r_name || '-' || CAST(n.n_nationkey % 3 AS VARCHAR) AS sub_region,
       c.c_acctbal > 5000 AS is_loyal, c.c_nationkey < 20 AS is_resident, c.c_nationkey % 4 AS services_used_60d
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "b_active_subs": "SELECT CAST(user_id AS VARCHAR) AS customer_id, CAST(ts AS DATE) AS day FROM events",
    "b_demographics": """
SELECT CAST(user_id AS VARCHAR) AS customer_id, CAST(ts AS DATE) AS day, ts AS updated_at, event_id,
       CASE event_type WHEN 'click' THEN ' Male' WHEN 'view' THEN 'FEMALE ' WHEN 'signup' THEN 'unknown'
            WHEN 'purchase' THEN 'female' END AS sex_prediction,
       CASE WHEN value > 300 THEN 'Tourist ' WHEN value > 100 THEN 'resident' END AS tourist_flag,
       CASE WHEN value > 250 THEN ' GB' WHEN value > 150 THEN 'In ' WHEN value > 120 THEN 'ae' END
           AS tourist_country_simcard
FROM events""",
    "b_bookings": f"""
SELECT CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS customer_id, event_id AS booking_id,
       25.0::DOUBLE + (event_id % 97) * {G}::DOUBLE AS dropoff_lat,
       55.0::DOUBLE + (event_id % 89) * {G}::DOUBLE AS dropoff_long,
       ts AS booking_creation_date, 1 AS service_area_id,
       CASE WHEN event_type = 'purchase' THEN 6 ELSE 2 END AS booking_status,
       value > 2 AS is_trip_ended, event_id % 17 = 0 AS is_cancelled_customer,
       event_id % 19 = 0 AS is_cancelled_captain, TRUE AS is_assigned, event_id % 50 AS captain_id,
       'Ride Hailing' AS business_type
FROM events""",
    "b_place_locations": """
SELECT CAST(user_id AS VARCHAR) AS user_id, event_id AS id, ts AS created_at,
       ts + to_days(CAST(event_id % 5 AS INTEGER)) AS last_updated
FROM events WHERE event_type = 'signup'
UNION ALL
SELECT CAST(user_id AS VARCHAR), event_id, ts, ts - INTERVAL 1 DAY
FROM events WHERE event_type = 'signup' AND event_id % 3 = 0""",
    "b_place_coordinates": f"""
SELECT event_id AS location_bookmark_id, {_ewkb('event_id % 97', 'event_id % 89')} AS lng_lat, ts AS last_updated
FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_id, {_ewkb('(event_id + 50) % 97', 'event_id % 89')}, ts - INTERVAL 2 DAY
FROM events WHERE event_type = 'signup' AND event_id % 4 = 0""",
    "b_place_details": f"""
SELECT event_id AS location_bookmark_id, {_name_case} AS saved_name,
       CASE WHEN event_id % 7 = 0 THEN 'Apartment' ELSE 'Building' END AS address_type,
       CASE WHEN event_id % 5 = 0 THEN 'Office Tower' WHEN event_id % 9 = 0 THEN 'villa' ELSE 'Commercial' END
           AS building_type,
       CASE WHEN event_id % 8 = 0 THEN NULL ELSE 'Place ' || CAST(event_id % 10 AS VARCHAR) END AS place_name,
       ts AS last_updated
FROM events WHERE event_type = 'signup'
UNION ALL
SELECT event_id, 'Old Name', 'Building', 'Commercial', 'Old Place', ts - INTERVAL 1 DAY
FROM events WHERE event_type = 'signup' AND event_id % 3 = 1""",
    "b_tags": f"SELECT CAST(id AS BIGINT) AS id, name, type FROM (VALUES {_tag_values}) AS t(id, name, type)",
    "b_merchant_tags": """
SELECT s_suppkey AS merchant_id, s_suppkey % 15 AS tag_id,
       CASE WHEN s_nationkey % 5 = 0 THEN 'INACTIVE' ELSE 'Active' END AS status FROM supplier
UNION ALL
SELECT s_suppkey, 15 + (s_suppkey + 7) % 15, 'active' FROM supplier""",
    "b_daily_user": """
SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "b_platform_status": f"""
SELECT user_id AS customer_id, CASE WHEN n > 2 THEN 'active' ELSE 'dormant' END AS monthly_status,
       CAST(n * 3 + user_id % 40 AS INTEGER) AS all_time_tx,
       CASE WHEN user_id % 11 = 0 THEN NULL ELSE day - CAST(user_id % 130 - 3 AS INTEGER) END AS last_tx_date,
       day, 'city' AS granularity, CASE WHEN user_id % 6 = 0 THEN '{OTHER_PLACE}' ELSE '{R.HOME_CITY}' END AS city
FROM b_daily_user""",
    "b_service_status": f"""
SELECT user_id AS customer_id, CASE WHEN n > 2 THEN 'active' ELSE 'dormant' END AS monthly_status,
       day - CAST(user_id % 40 AS INTEGER) AS last_order_date, CAST(n AS INTEGER) AS delivered_orders, day,
       'city' AS granularity, '{R.HOME_CITY}' AS city, CASE WHEN user_id % 2 = 0 THEN 'food' ELSE 'shops' END AS domain,
       'service' AS level
FROM b_daily_user""",
}

_DEPS = {"b_platform_status": ["b_daily_user"], "b_service_status": ["b_daily_user"]}


def with_bindings(sql: str) -> str:
    """Prefix ``sql`` with the binding CTEs it references (``b_*`` names), in dependency order."""
    used: list[str] = []

    def add(name: str) -> None:
        for d in _DEPS.get(name, []):
            add(d)
        if name not in used:
            used.append(name)

    for name in re.findall(r"\bb_[a-z_]+\b", sql):
        if name in B:
            add(name)
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS ({B[n]})" for n in used)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
