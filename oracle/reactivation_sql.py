"""DuckDB oracle SQL for the reactivation jobs (P1-P4) and their operators."""

from __future__ import annotations

from datetime import date, timedelta

from cohortflow import rules as R


def _q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


MEMBER_CASE = f"""CASE WHEN lower(subscriptiontype) IN ({_q(R.PAID_SUBSCRIPTION_TYPES)}) THEN 'paid'
                WHEN planid IN ({_q(R.PAID_PLAN_IDS)}) THEN 'paid'
                WHEN lower(invoiceid) LIKE '{R.FREE_RENEWAL_PATTERN}' THEN 'paid'
                WHEN lower(subscriptiontype) LIKE '{R.TRIAL_COMMITMENT_PATTERN}' THEN 'trial_without_commitment'
                WHEN lower(subscriptiontype) LIKE '{R.TRIAL_PATTERN}' THEN 'trial' END"""

COHORT = """CASE WHEN lifetime_orders = 0 THEN '0' WHEN lifetime_orders = 1 THEN '1'
     WHEN lifetime_orders BETWEEN 2 AND 4 THEN '2-4' WHEN lifetime_orders BETWEEN 5 AND 10 THEN '5-10'
     WHEN lifetime_orders > 10 THEN '10+' END"""
RBAND = """CASE WHEN recency_days <= 45 THEN '30-45' WHEN recency_days <= 60 THEN '45-60'
     WHEN recency_days <= 90 THEN '60-90' WHEN recency_days <= 120 THEN '90-120' ELSE '120+' END"""


def history_ctes(anchor: str, since: str, keys_cte: str | None = None) -> str:
    restrict = f"AND o.customer_id IN (SELECT customer_id FROM {keys_cte})" if keys_cte else ""
    return f"""
hist AS (
  SELECT o.customer_id, o.order_id, o.order_received_timestamp, o.day, m.merchant_name
  FROM b_orders o JOIN b_merchants m ON o.merchant_id = m.merchant_id
  WHERE lower(o.order_status) = 'delivered' AND o.day >= DATE '{since}' AND o.day < DATE '{anchor}'
    AND o.city_id IN (1, 2) AND o.order_type = 'shops' {restrict}),
stats AS (
  SELECT customer_id, min(day) AS first_order_date, max(day) AS last_order_date,
         count(DISTINCT order_id) AS lifetime_orders, date_diff('day', max(day), DATE '{anchor}') AS recency_days
  FROM hist GROUP BY customer_id),
lastm AS (
  SELECT customer_id, merchant_name AS last_merchant FROM (
    SELECT customer_id, merchant_name, row_number() OVER (PARTITION BY customer_id
      ORDER BY order_received_timestamp DESC NULLS LAST, order_id DESC NULLS LAST, merchant_name DESC NULLS LAST) AS rn
    FROM hist) WHERE rn = 1),
life AS (
  SELECT s.customer_id, recency_days, first_order_date, last_order_date, {COHORT} AS order_cohort,
         {RBAND} AS recency_band, lifetime_orders, last_merchant
  FROM stats s LEFT JOIN lastm USING (customer_id))"""


def value_ctes(anchor: str, rides_since: str) -> str:
    return f"""
rides_u AS (
  SELECT DISTINCT day, CAST(customer_id AS BIGINT) AS customer_id, trip_id, revenue, cogs FROM b_trips
  WHERE day >= DATE '{rides_since}' AND day < DATE '{anchor}' AND lower(business_type) IN ('ride hailing', 'jv')
    AND trip_outcome = 3 AND lower(country) IN ('{R.VALUE_COUNTRY}')),
rides AS (
  SELECT customer_id, max(day) AS last_ride_date, count(DISTINCT trip_id) AS n_rides,
         count(DISTINCT CASE WHEN date_diff('day', day, DATE '{anchor}') <= 30 THEN trip_id END) AS n_rides_30,
         sum(revenue) AS ride_gmv, sum(revenue - cogs) AS ride_gp,
         CAST(sum(revenue - cogs) AS DOUBLE) / nullif(count(DISTINCT trip_id), 0) AS ride_gppo
  FROM rides_u GROUP BY customer_id),
food AS (
  SELECT customer_id, count(DISTINCT order_id) AS n_food_orders,
         count(DISTINCT CASE WHEN date_sub('day', order_received_timestamp, CAST(DATE '{anchor}' AS TIMESTAMP)) <= 30
                             THEN order_id END) AS n_food_orders_30,
         max(order_received_timestamp) AS last_food_order_ts, sum(gtv) AS food_gmv,
         sum(gtv - cogs - partner_share) AS food_gp,
         CAST(sum(gtv - cogs - partner_share) AS DOUBLE) / nullif(count(DISTINCT order_id), 0) AS food_gppo
  FROM b_value_lines WHERE order_received_timestamp < CAST(DATE '{anchor}' AS TIMESTAMP) GROUP BY customer_id),
shop AS (
  SELECT customer_id, count(DISTINCT order_id) AS n_shop_orders, sum(gmv) AS shop_gmv,
         sum(net_revenue + delivery_costs + wastage) AS shop_gp,
         CAST(sum(net_revenue + delivery_costs + wastage) AS DOUBLE) / nullif(count(DISTINCT order_id), 0) AS shop_gppo
  FROM b_order_level WHERE day < DATE '{anchor}' GROUP BY customer_id),
mem AS (
  SELECT customer_id, 1 AS member_flag, member_type FROM (
    SELECT CAST(substr(userid, 6) AS BIGINT) AS customer_id,
           {MEMBER_CASE} AS member_type,
           row_number() OVER (PARTITION BY CAST(substr(userid, 6) AS BIGINT) ORDER BY day DESC, event_seq DESC) AS rn
    FROM b_subscription_events
    WHERE lower(eventtype) = '{R.MEMBERSHIP_EVENT}' AND CAST(expiresat AS DATE) >= DATE '{anchor}'
      AND CAST(startedat AS DATE) < DATE '{anchor}' AND serviceareaid IN ({_q(R.MEMBERSHIP_AREAS)})) WHERE rn = 1),
prof AS (SELECT CAST(customer_id AS BIGINT) AS customer_id, nationality, region, sub_region, is_loyal FROM b_profile)"""


def value_select(anchor: str) -> str:
    return f"""
  coalesce(f.n_food_orders_30, 0) AS n_food_orders_30, CAST(coalesce(f.food_gmv, 0) AS DOUBLE) AS food_gmv,
  coalesce(r.n_rides_30, 0) AS n_rides_30, CAST(coalesce(r.ride_gmv, 0) AS DOUBLE) AS ride_gmv,
  coalesce(date_sub('day', f.last_food_order_ts, CAST(DATE '{anchor}' AS TIMESTAMP)), 365) AS food_recency,
  coalesce(date_diff('day', r.last_ride_date, DATE '{anchor}'), 365) AS ride_recency,
  coalesce(r.n_rides, 0) AS n_rides, CAST(coalesce(r.ride_gp, 0) AS DOUBLE) AS ride_gp,
  coalesce(r.ride_gppo, 0) AS ride_gppo,
  coalesce(f.n_food_orders, 0) AS n_food_orders, CAST(coalesce(f.food_gp, 0) AS DOUBLE) AS food_gp,
  coalesce(f.food_gppo, 0) AS food_gppo,
  coalesce(q.n_shop_orders, 0) AS n_shop_orders, CAST(coalesce(q.shop_gp, 0) AS DOUBLE) AS shop_gp,
  coalesce(q.shop_gppo, 0) AS shop_gppo, CAST(coalesce(q.shop_gmv, 0) AS DOUBLE) AS shop_gmv,
  CAST(coalesce(r.ride_gmv, 0) + coalesce(f.food_gmv, 0) + coalesce(q.shop_gmv, 0) AS DOUBLE) AS total_gmv,
  CAST(coalesce(r.ride_gp, 0) + coalesce(f.food_gp, 0) + coalesce(q.shop_gp, 0) AS DOUBLE)
     / nullif(coalesce(r.n_rides, 0) + coalesce(f.n_food_orders, 0) + coalesce(q.n_shop_orders, 0), 0) AS blended_gppo,
  c.is_resident"""


VALUE_JOINS = """
  LEFT JOIN rides r ON r.customer_id = s.customer_id LEFT JOIN food f ON f.customer_id = s.customer_id
  LEFT JOIN shop q ON q.customer_id = s.customer_id LEFT JOIN b_customers c ON c.customer_id = s.customer_id"""


def lapsed_base(anchor="2000-01-01", since="1997-01-01", min_recency=30, min_orders=5) -> str:
    return f"""WITH {history_ctes(anchor, since)}
SELECT DATE '{anchor}' AS day, l.customer_id, recency_days, first_order_date, last_order_date, order_cohort,
       recency_band, lifetime_orders, last_merchant, c.is_resident
FROM life l LEFT JOIN b_customers c ON l.customer_id = c.customer_id
WHERE recency_days > {min_recency} AND c.is_resident = TRUE AND lifetime_orders >= {min_orders}"""


def reactivation_targets(anchor="2000-01-01", since="1997-01-01", rides_since="1995-01-01", min_recency=30,
                         min_orders=5) -> str:
    return f"""WITH {history_ctes(anchor, since)}, {value_ctes(anchor, rides_since)},
feat AS (
  SELECT DATE '{anchor}' AS day, s.*, {value_select(anchor)}
  FROM life s {VALUE_JOINS}
  WHERE s.recency_days > {min_recency})
SELECT s.* EXCLUDE (blended_gppo), coalesce(m.member_flag, 0) AS member_flag, m.member_type,
       p.nationality, p.region, p.sub_region, p.is_loyal
FROM feat s LEFT JOIN mem m ON m.customer_id = s.customer_id LEFT JOIN prof p ON p.customer_id = s.customer_id
WHERE s.is_resident = TRUE AND s.n_shop_orders >= {min_orders}"""


def reactivation_features(anchor="2000-01-21", end="2000-04-21", since="1997-01-01", rides_since="1995-01-01",
                          outcome_cities="1", with_city=True, with_blended=False) -> str:
    city = "t.city_id," if with_city else ""
    blended = "f.blended_gppo," if with_blended else ""
    return f"""WITH today AS (
  SELECT o.customer_id, o.city_id, o.promo_code, o.basket_amount, o.promo_amount, o.net_basket_amount_with_tax,
         row_number() OVER (PARTITION BY o.customer_id
                            ORDER BY o.order_received_timestamp ASC NULLS LAST, o.order_id, o.line_no) AS day_order_rn
  FROM b_orders o JOIN b_merchants m ON o.merchant_id = m.merchant_id
  WHERE lower(o.order_status) = 'delivered' AND o.day = DATE '{anchor}' AND o.city_id IN (1, 2)
    AND o.order_type = 'shops'),
after AS (
  SELECT o.customer_id, count(DISTINCT o.order_id) AS n_orders_after, sum(o.basket_amount) AS basket_after,
         sum(o.promo_amount) AS promo_after, sum(o.net_basket_amount_with_tax) AS spend_after
  FROM b_orders o JOIN b_merchants m ON o.merchant_id = m.merchant_id
  WHERE lower(o.order_status) = 'delivered' AND o.day > DATE '{anchor}' AND o.day <= DATE '{end}'
    AND o.city_id IN ({outcome_cities}) AND o.order_type = 'shops'
  GROUP BY o.customer_id),
{history_ctes(anchor, since)}, {value_ctes(anchor, rides_since)},
feat AS (SELECT s.*, {value_select(anchor)} FROM life s {VALUE_JOINS})
SELECT t.customer_id, {city} t.day_order_rn, t.promo_code, CAST(t.basket_amount AS DOUBLE) AS basket_amount,
       CAST(t.promo_amount AS DOUBLE) AS promo_amount,
       CAST(t.net_basket_amount_with_tax AS DOUBLE) AS net_basket_amount_with_tax,
       a.n_orders_after, CAST(a.basket_after AS DOUBLE) AS basket_after, CAST(a.promo_after AS DOUBLE) AS promo_after,
       CAST(a.spend_after AS DOUBLE) AS spend_after,
       f.recency_days AS shop_recency, f.food_recency, f.ride_recency, f.first_order_date, f.last_order_date,
       f.lifetime_orders, f.last_merchant, f.n_rides, f.n_rides_30, f.ride_gmv, f.ride_gp, f.ride_gppo,
       f.n_food_orders, f.n_food_orders_30, f.food_gmv, f.food_gp, f.food_gppo,
       f.n_shop_orders, f.shop_gp, f.shop_gppo, f.shop_gmv, f.total_gmv, {blended}
       f.is_resident, coalesce(m.member_flag, 0) AS member_flag, m.member_type,
       p.nationality, p.region, p.sub_region, p.is_loyal
FROM today t LEFT JOIN after a ON a.customer_id = t.customer_id LEFT JOIN feat f ON f.customer_id = t.customer_id
LEFT JOIN mem m ON m.customer_id = t.customer_id LEFT JOIN prof p ON p.customer_id = t.customer_id"""


def many_anchors(days=("1999-05-12", "1999-05-13", "2000-01-21", "2000-06-26", "2001-09-17"), outcome_days=91) -> str:
    one = lambda d: f"SELECT DATE '{d}' AS anchor, * FROM ({reactivation_features(d, str(date.fromisoformat(d) + timedelta(outcome_days)))})"
    return " UNION ALL ".join(map(one, days))


SQL = {
    "job_lapsed_base": lapsed_base(),
    "job_reactivation_targets": reactivation_targets(),
    "job_reactivation_features": reactivation_features(),
    "job_reactivation_features_blended": reactivation_features(outcome_cities="1, 2", with_city=False,
                                                               with_blended=True),
    "job_reactivation_features_many": many_anchors(),
    "job_reactivation_features_stored": reactivation_features(),
}
