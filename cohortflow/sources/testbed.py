"""Bindings of the driver's test tables to the domain tables the jobs read.

The driver ships TPC-H-style tables (``lineitem orders customer supplier part nation region``)
and an ``events`` table. Each function below derives one domain table from them with column
expressions only (lazy; Spark prunes columns and pushes filters into the Parquet scans). The
same definitions are written independently as DuckDB SQL in ``oracle/bindings.py``.

Money is DECIMAL (exact sums); derived amounts keep enough scale to stay exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.params import ObservationWindow, as_date
from cohortflow.session import session_key
from cohortflow.sources.tables import read_table as _read_table

_READ_CACHE: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's tables are read-only, so one DataFrame per (session, table) is reused
    (saves a file listing and footer read per use)."""
    key = (session_key(spark), sf_dir, name)
    df = _READ_CACHE.get(key)
    if df is None:
        df = _READ_CACHE[key] = _read_table(spark, sf_dir, name)
    return df


# Fixture windows (dates of the driver's data: orders 1995-2001, events January 2024).
REACTIVATION_W = ObservationWindow.of("1997-01-01", "2000-01-01", "2000-04-01", history_start="1997-01-01",
                                      end_date="2000-03-31")
ANCHOR_DAY_W = ObservationWindow.of("1997-01-01", "2000-01-21", "2000-04-22", history_start="1997-01-01",
                                    end_date="2000-04-21")
ANCHOR_DAYS = [as_date(d) for d in ("1999-05-12", "1999-05-13", "2000-01-21", "2000-06-26", "2001-09-17")]  # outcomes overlap, lie apart and run out
CROSS_SELL_W = ObservationWindow.of("1995-01-01", "1996-01-01", "1997-01-01")
COHORT_WINDOWS = [ObservationWindow.of(*w) for w in (("1995-01-01", "1996-01-01", "1997-01-01"), ("1995-03-01", "1996-03-01", "1996-09-01"),
                                                     ("1996-01-01", "1996-02-01", "1996-03-01"), ("1998-06-15", "1999-01-01", "1999-01-02"))]
EVENTS_W = ObservationWindow.of("2024-01-01", "2024-01-21", "2024-01-31")

STEP_2_12 = 2.0 ** -12  # grid step of saved places / bookings, exact in binary

# Fixture strings are built from the rule data (with case / blank variants the rules must absorb).
B_MERCHANT_PREFIX = R.B_BRAND_WORD.capitalize() + " Mart "
CHILD_PRODUCT = R.CHILD_PRODUCTS[2].title()
COUNTRY = R.VALUE_COUNTRY.title()
CREDIT_TYPES = (R.MEMBERSHIP_CREDIT_TYPES[0].capitalize(), R.MEMBERSHIP_CREDIT_TYPES[4], R.MEMBERSHIP_CREDIT_TYPES[6].upper())
OTHER_PLACE = "Elsewhere"


def _dec(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


def _hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of the delivery services (both order tables upstream): one row per line."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = _lines(spark, sf_dir).join(s, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    price = _dec(F.col("l_extendedprice"), 12, 2)
    disc = _dec(F.col("l_discount"), 4, 2)
    tax = _dec(F.col("l_tax"), 4, 2)
    ts = _hours(F.col("l_shipdate"), (F.col("l_linenumber") * 3 + F.col("l_orderkey") % 3).cast("int"))
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        (F.lit(1) + (F.col("l_orderkey") % 5) % 3).cast("int").alias("city_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit(B_MERCHANT_PREFIX), F.col("s_name")))
         .otherwise(F.col("s_name")).alias("merchant_name"),
        F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 7).cast("string")).alias("brand_name"),
        F.when(F.col("l_returnflag") == "N", F.lit("food")).otherwise(F.lit("shops")).alias("order_type"),
        F.when((F.col("l_linestatus") == "F") & (F.col("l_orderkey") % 3 == 0), F.lit("DELIVERED"))
         .when(F.col("l_linestatus") == "F", F.lit("delivered"))
         .otherwise(F.lit("cancelled")).alias("order_status"),
        ts.alias("order_received_timestamp"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.when(F.col("l_discount") >= 0.05, F.concat(F.lit("SAVE"), (F.col("l_orderkey") % 5).cast("string"))).alias("promo_code"),
        F.when(F.col("l_discount") >= 0.08, F.lit("percent")).when(F.col("l_discount") >= 0.05, F.lit("flat")).alias("promo_type"),
        F.col("l_discount").alias("promo_applied_value"),
        _dec(F.col("l_extendedprice"), 14, 2).alias("basket_amount"),
        _dec(price * disc, 14, 4).alias("promo_amount"),
        _dec(price * _dec(F.lit(1) - disc, 4, 2) * _dec(F.lit(1) + tax, 4, 2), 16, 6).alias("net_basket_amount_with_tax"),
        _dec(price * _dec(F.lit(1) - disc, 4, 2), 14, 4).alias("net_revenue"),
        _dec(F.col("l_linenumber"), 14, 2).alias("delivery_fee"),
        _dec(price * _dec(F.lit(1) + tax, 4, 2), 14, 4).alias("gmv"),
        _dec(F.when(F.col("l_orderkey") % 7 == 0, F.lit(5)).otherwise(F.lit(0)), 14, 2).alias("member_discount"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant allow-list of the lapsed service."""
    s = read_table(spark, sf_dir, "supplier")
    return s.where(F.col("s_nationkey") < 12).select(F.col("s_suppkey").alias("merchant_id"),
                                                      F.col("s_name").alias("merchant_name"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension with the residency flag."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), (F.col("c_nationkey") < 20).alias("is_resident"))


def value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item level gross value of the second service."""
    price = _dec(F.col("l_extendedprice"), 12, 2)
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_orderkey").alias("order_id"),
        _hours(F.col("l_shipdate"), (F.col("l_linenumber") * 3 + F.col("l_orderkey") % 3).cast("int")).alias("order_received_timestamp"),
        _dec(F.col("l_extendedprice"), 14, 2).alias("gtv"),
        _dec(price * _dec(F.lit(0.5), 4, 2), 14, 4).alias("cogs"),
        _dec(price * _dec(F.col("l_tax"), 4, 2), 14, 4).alias("partner_share"),
    )


def order_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level net revenue table of the lapsed service."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        _dec(F.col("o_totalprice"), 14, 2).alias("gmv"),
        _dec(_dec(F.col("o_totalprice"), 14, 2) * _dec(F.lit(0.2), 4, 2), 14, 4).alias("net_revenue"),
        _dec(-(F.col("o_orderkey") % 10), 14, 2).alias("delivery_costs"),
        _dec(-(F.col("o_custkey") % 3), 14, 2).alias("wastage"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride trips (text customer ids, as upstream)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    j = _lines(spark, sf_dir).join(p, F.col("l_partkey") == F.col("p_partkey"), "inner")
    price = _dec(F.col("l_extendedprice"), 12, 2)
    hours = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5) % 24).cast("int")
    return j.select(
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("trip_id"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("long")).otherwise(F.col("l_suppkey")).alias("captain_id"),
        F.when(F.col("l_partkey") % 13 == 0, F.lit(2)).otherwise(F.lit(1)).alias("service_area_id"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1), F.lit(4)).otherwise(F.lit(3)).alias("trip_outcome"),
        F.when(F.col("l_quantity") < 3, F.lit(0)).otherwise(F.lit(1)).alias("is_valid"),
        F.when(F.col("l_orderkey") % 101 == 0, F.lit(0.0))
         .otherwise(F.lit(25.0) + (F.col("l_partkey") % 83) * F.lit(0.003)).alias("pick_up_latitude"),
        (F.lit(55.0) + (F.col("l_suppkey") % 89) * F.lit(0.003)).alias("pick_up_longitude"),
        (F.lit(25.0) + (F.col("l_orderkey") % 97) * F.lit(0.002)).alias("drop_off_latitude"),
        (F.lit(55.0) + (F.col("o_custkey") % 89) * F.lit(0.002)).alias("drop_off_longitude"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Ride Hailing"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("JV"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Hala"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("ride-hailing"))
         .otherwise(F.lit("Delivery")).alias("business_type"),
        F.when(F.col("p_size") == 1, F.lit("TEST ride"))
         .when(F.col("p_size") % 10 == 3, F.lit(CHILD_PRODUCT))
         .when(F.col("p_size") % 10 == 7, F.lit("School Rides"))
         .otherwise(F.col("p_type")).alias("cct"),
        F.col("p_partkey").cast("int").alias("cct_id"),
        F.when(F.col("o_custkey") % 17 == 0, F.lit(OTHER_PLACE)).otherwise(F.lit(COUNTRY)).alias("country"),
        _dec(F.col("l_extendedprice"), 14, 2).alias("revenue"),
        _dec(price * _dec(F.col("l_discount"), 4, 2), 14, 4).alias("cogs"),
        _hours(F.col("l_shipdate"), hours).alias("booking_date"),
        F.lit("app").alias("booking_platform"),
        (F.col("l_quantity") / F.lit(2.0)).alias("distance_travelled"),
        (F.col("l_quantity") * F.lit(0.75)).alias("duration_time"),
        _dec(F.col("l_extendedprice"), 14, 2).alias("trip_price"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(" Card "))
         .when(F.col("o_orderkey") % 3 == 1, F.lit("CASH")).otherwise(F.lit("Wallet")).alias("customer_payment_selection"),
        F.when(F.col("l_discount") >= 0.06, F.concat(F.lit("RIDE"), F.col("l_linenumber").cast("string")))
         .when(F.col("l_discount") == 0.0, F.lit(None).cast("string"))
         .otherwise(F.lit("")).alias("booking_promo_code"),
    )


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wallet credit rows per booking (duplicates per booking exist)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.when(F.col("l_returnflag") == "N", F.lit("Voucher"))
         .when(F.col("l_partkey") % 3 == 0, F.lit("Marketing Credits")).otherwise(F.lit("Refund")).alias("credit_title"),
        F.when(F.col("l_suppkey") % 4 == 0, F.lit(CREDIT_TYPES[0]))
         .when(F.col("l_suppkey") % 4 == 1, F.lit(CREDIT_TYPES[1]))
         .when(F.col("l_suppkey") % 4 == 2, F.lit("cashback"))
         .otherwise(F.lit(CREDIT_TYPES[2])).alias("credit_type"),
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-order-date rows per user and service (several rows per user; the job takes the min)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    j = _lines(spark, sf_dir).join(p, F.col("l_partkey") == F.col("p_partkey"), "inner")
    return j.select(
        F.col("o_custkey").cast("string").alias("userid"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("first_order_date"),
        F.when(F.col("p_type") == "PROMO", F.lit(R.A_SERVICES[0]))
         .when(F.col("p_type") == "SMALL", F.lit(R.B_SERVICES[0]))
         .when(F.col("p_type") == "LARGE", F.lit(R.BASE_SERVICES[1]))
         .otherwise(F.lit(R.BASE_SERVICES[0])).alias("service"),
        F.when((F.col("l_suppkey") % 10 == 0) | (F.col("p_size") <= 25), F.lit(OTHER_PLACE)).otherwise(F.lit(R.HOME_CITY)).alias("city"),
    )


def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership change log (text user ids with a 5-character prefix)."""
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.select(
        F.concat(F.lit("CPLS-"), F.col("o_custkey").cast("string")).alias("userid"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Regular"))
         .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Free Trial"))
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Trial_No_Commitment"))
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("Monthly"))
         .otherwise(F.lit("annual")).alias("subscriptiontype"),
        (F.col("o_orderkey") % 70).cast("string").alias("planid"),
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("INV-FREE-RENEWAL-"), F.col("o_orderkey").cast("string")))
         .when(F.col("o_orderkey") % 13 == 0, F.lit("inv_freeXrenewal"))
         .otherwise(F.concat(F.lit("inv-"), F.col("o_orderkey").cast("string"))).alias("invoiceid"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Subscription_Started"))
         .otherwise(F.lit("subscription_renewed")).alias("eventtype"),
        ((F.col("o_custkey") % 3) * 10 + 1).cast("string").alias("serviceareaid"),
        d.cast("string").alias("startedat"),
        F.date_add(d, (F.col("o_orderkey") % 400).cast("int")).cast("string").alias("expiresat"),
        d.alias("day"),
        F.col("o_orderkey").alias("event_seq"),
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer profile dimension (text ids)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("nationality"),
        _dec(F.col("c_acctbal"), 12, 2).cast("string").alias("nationality_score"),
        F.col("r_name").alias("region"),
        F.concat(F.col("r_name"), F.lit("-"), (F.col("n_nationkey") % 3).cast("string")).alias("sub_region"),
        (F.col("c_acctbal") > 5000).alias("is_loyal"),
        (F.col("c_nationkey") < 20).alias("is_resident"),
        (F.col("c_nationkey") % 4).alias("services_used_60d"),
    )


def active_subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily active-membership rows."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("customer_id"), F.col("ts").cast("date").alias("day"))


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily predicted demographics (dirty text: blanks, case, unknown values)."""
    e = read_table(spark, sf_dir, "events")
    v = F.col("value")
    return e.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").cast("date").alias("day"),
        F.col("ts").alias("updated_at"),
        F.col("event_id"),
        F.when(F.col("event_type") == "click", F.lit(" Male"))
         .when(F.col("event_type") == "view", F.lit("FEMALE "))
         .when(F.col("event_type") == "signup", F.lit("unknown"))
         .when(F.col("event_type") == "purchase", F.lit("female")).alias("sex_prediction"),
        F.when(v > 300, F.lit("Tourist ")).when(v > 100, F.lit("resident")).alias("tourist_flag"),
        F.when(v > 250, F.lit(" GB")).when(v > 150, F.lit("In ")).when(v > 120, F.lit("ae")).alias("tourist_country_simcard"),
    )


def _grid(col_mod: Column, base: float) -> Column:
    return F.lit(base) + col_mod * F.lit(STEP_2_12)


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride bookings with drop-off coordinates."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("ts").cast("date").alias("day"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_id").alias("booking_id"),
        _grid(F.col("event_id") % 97, 25.0).alias("dropoff_lat"),
        _grid(F.col("event_id") % 89, 55.0).alias("dropoff_long"),
        F.col("ts").alias("booking_creation_date"),
        F.lit(1).alias("service_area_id"),
        F.when(F.col("event_type") == "purchase", F.lit(6)).otherwise(F.lit(2)).alias("booking_status"),
        (F.col("value") > 2).alias("is_trip_ended"),
        (F.col("event_id") % 17 == 0).alias("is_cancelled_customer"),
        (F.col("event_id") % 19 == 0).alias("is_cancelled_captain"),
        F.lit(True).alias("is_assigned"),
        (F.col("event_id") % 50).alias("captain_id"),
        F.lit("Ride Hailing").alias("business_type"),
    )


def _signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")


def place_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved places (versions by last_updated; every third place has an older version)."""
    s = _signups(spark, sf_dir)
    cur = s.select(F.col("user_id").cast("string").alias("user_id"), F.col("event_id").alias("id"),
                   F.col("ts").alias("created_at"),
                   F.timestamp_add("DAY", (F.col("event_id") % 5).cast("int"), F.col("ts")).alias("last_updated"))
    old = s.where(F.col("event_id") % 3 == 0).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"), F.timestamp_add("DAY", F.lit(-1), F.col("ts")).alias("last_updated"))
    return cur.unionByName(old)


def _le_hex(bits: Column) -> Column:
    be = F.lpad(F.hex(bits), 16, "0")
    return F.concat(*[F.substring(be, 15 - 2 * i, 2) for i in range(8)])


def _ewkb(lat_k: Column, lon_k: Column) -> Column:
    """Hex EWKB (SRID 4326) of lat = 25 + k*2^-12, lon = 55 + j*2^-12, built from IEEE bits."""
    lat_bits = F.lit(1027 * 2**52 + 9 * 2**48).cast("long") + lat_k.cast("long") * F.lit(2**36).cast("long")
    lon_bits = F.lit(1028 * 2**52 + 23 * 2**47).cast("long") + lon_k.cast("long") * F.lit(2**35).cast("long")
    return F.concat(F.lit("0101000020E6100000"), _le_hex(lon_bits), _le_hex(lat_bits))


def place_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved-place coordinates as hex EWKB; every fourth place has an older, different position."""
    s = _signups(spark, sf_dir)
    cur = s.select(F.col("event_id").alias("location_bookmark_id"),
                   _ewkb(F.col("event_id") % 97, F.col("event_id") % 89).alias("lng_lat"),
                   F.col("ts").alias("last_updated"))
    old = s.where(F.col("event_id") % 4 == 0).select(
        F.col("event_id").alias("location_bookmark_id"),
        _ewkb((F.col("event_id") + 50) % 97, F.col("event_id") % 89).alias("lng_lat"),
        F.timestamp_add("DAY", F.lit(-2), F.col("ts")).alias("last_updated"))
    return cur.unionByName(old)


PLACE_NAMES = ["Home", "Work", "Gym Downtown", "My University", "Airport T3", "City Mall", "Hilton Hotel",
               "Dental Clinic", "Villa 12", "Office HQ", "Mom", None]


def place_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved-place names and types; every third place (id % 3 == 1) has an older name."""
    s = _signups(spark, sf_dir)
    k = F.col("event_id") % 12
    name = None
    for i, nm in enumerate(PLACE_NAMES):
        val = F.lit(nm).cast("string")
        name = F.when(k == i, val) if name is None else name.when(k == i, val)
    cur = s.select(
        F.col("event_id").alias("location_bookmark_id"),
        name.alias("saved_name"),
        F.when(F.col("event_id") % 7 == 0, F.lit("Apartment")).otherwise(F.lit("Building")).alias("address_type"),
        F.when(F.col("event_id") % 5 == 0, F.lit("Office Tower"))
         .when(F.col("event_id") % 9 == 0, F.lit("villa")).otherwise(F.lit("Commercial")).alias("building_type"),
        F.when(F.col("event_id") % 8 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Place "), (F.col("event_id") % 10).cast("string"))).alias("place_name"),
        F.col("ts").alias("last_updated"),
    )
    old = s.where(F.col("event_id") % 3 == 1).select(
        F.col("event_id").alias("location_bookmark_id"), F.lit("Old Name").alias("saved_name"),
        F.lit("Building").alias("address_type"), F.lit("Commercial").alias("building_type"),
        F.lit("Old Place").alias("place_name"), F.timestamp_add("DAY", F.lit(-1), F.col("ts")).alias("last_updated"))
    return cur.unionByName(old)


# Cuisine tag dimension: a fixed lookup (like the taxonomy), mixed case and one trailing blank.
TAG_NAMES = ["Sushi", "Pizza", "Smoothies ", "SMOOTHIES", "Lebanese", "Burger", "Indian", "Coffee", "Desserts",
             "Seafood", "Uzbek", "Mexican", "Italian", "French", "American", "Moroccan", "Healthy", "Cafe",
             "Fusion", "Poké", "Vegan", "Halal", "Kunafa", "Thai", "Greek", "Wings", "Tea", "BBQ & Grill",
             "Street Food", "Shawarma"]
DIETARY_TAG_IDS = (20, 21)


def tags(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    rows = [(i, n, "dietary" if i in DIETARY_TAG_IDS else "cuisine") for i, n in enumerate(TAG_NAMES)]
    structs = [F.struct(F.lit(i).cast("long").alias("id"), F.lit(n).alias("name"), F.lit(t).alias("type"))
               for i, n, t in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def merchant_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant-to-tag bridge: two tags per merchant, some inactive."""
    s = read_table(spark, sf_dir, "supplier")
    a = s.select(F.col("s_suppkey").alias("merchant_id"), (F.col("s_suppkey") % 15).alias("tag_id"),
                 F.when(F.col("s_nationkey") % 5 == 0, F.lit("INACTIVE")).otherwise(F.lit("Active")).alias("status"))
    b = s.select(F.col("s_suppkey").alias("merchant_id"), (F.lit(15) + (F.col("s_suppkey") + 7) % 15).alias("tag_id"),
                 F.lit("active").alias("status"))
    return a.unionByName(b)


def _daily_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id"), F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def platform_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily platform-wide customer status snapshot."""
    d = _daily_user(spark, sf_dir)
    return d.select(
        F.col("user_id").alias("customer_id"),
        F.when(F.col("n") > 2, F.lit("active")).otherwise(F.lit("dormant")).alias("monthly_status"),
        (F.col("n") * 3 + F.col("user_id") % 40).cast("int").alias("all_time_tx"),
        F.when(F.col("user_id") % 11 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_sub(F.col("day"), (F.col("user_id") % 130).cast("int") - 3)).alias("last_tx_date"),
        F.col("day"),
        F.lit("city").alias("granularity"),
        F.when(F.col("user_id") % 6 == 0, F.lit(OTHER_PLACE)).otherwise(F.lit(R.HOME_CITY)).alias("city"),
    )


def service_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily second-service status snapshot (one row per level; duplicates across domains)."""
    d = _daily_user(spark, sf_dir)
    return d.select(
        F.col("user_id").alias("customer_id"),
        F.when(F.col("n") > 2, F.lit("active")).otherwise(F.lit("dormant")).alias("monthly_status"),
        F.date_sub(F.col("day"), (F.col("user_id") % 40).cast("int")).alias("last_order_date"),
        F.col("n").cast("int").alias("delivered_orders"),
        F.col("day"),
        F.lit("city").alias("granularity"),
        F.lit(R.HOME_CITY).alias("city"),
        F.when(F.col("user_id") % 2 == 0, F.lit("food")).otherwise(F.lit("shops")).alias("domain"),
        F.lit("service").alias("level"),
    )


@dataclass(frozen=True)
class Sources:
    """All bindings for one scale-factor directory (lazy DataFrames)."""

    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name):
        fn = globals().get(name)
        if fn is None or name.startswith("_") or not callable(fn):
            raise AttributeError(name)
        key = (session_key(self.spark), self.sf_dir, "binding", name)
        df = _READ_CACHE.get(key)
        if df is None:  # bindings are pure functions of the read-only tables: build each once
            df = _READ_CACHE[key] = fn(self.spark, self.sf_dir)
        return df
