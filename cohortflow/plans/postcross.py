"""Post-crossing orders (P16, P17): what newly crossed customers ordered in the outcome window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import rules as R
from cohortflow.functions.measures import days_since
from cohortflow.operators.filters import delivered, name_contains
from cohortflow.operators.joins import join_bridge, restrict_to
from cohortflow.operators.scans import scan_window
from cohortflow.operators.windows import rank_within
from cohortflow.params import ObservationWindow

ORDER_COLS = ["customer_id", "order_id", "promo_amount", "basket_amount", "net_revenue", "net_basket_amount_with_tax",
              "delivery_fee", "gmv", "member_discount", "promo_code", "promo_type", "promo_applied_value",
              "order_received_timestamp", "merchant_name", "brand_name"]
MONEY_COLS = ["promo_amount", "basket_amount", "net_revenue", "net_basket_amount_with_tax", "delivery_fee", "gmv",
              "member_discount"]


def literal_frame(spark: SparkSession, rows, names) -> DataFrame:
    """A small fixed lookup as a DataFrame built in the JVM (inline of literal structs; no Python
    worker, unlike createDataFrame from a list)."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def taxonomy_frame(spark: SparkSession, taxonomy=None) -> DataFrame:
    """C9 rule data as a DataFrame (name, group); a fixed ~150-row lookup."""
    return literal_frame(spark, R.taxonomy_rows(taxonomy), ["tax_name", "cuisine_group"])


def map_taxonomy(df: DataFrame, col: str, tax: DataFrame, out: str = "cuisine_group",
                 default: str = R.CUISINE_DEFAULT) -> DataFrame:
    """Left join on ``lower(name)`` (untrimmed, T26), default group for the rest."""
    j = df.join(tax, F.lower(df[col]) == tax["tax_name"], "left")
    return j.withColumn(out, F.coalesce(F.col("cuisine_group"), F.lit(default))).drop("tax_name", *(
        ["cuisine_group"] if out != "cuisine_group" else []))


def _window_orders(orders: DataFrame, base: DataFrame, W: ObservationWindow) -> DataFrame:
    """Orders in ``[anchor, target_end)`` of the crossed cohort."""
    o = scan_window(orders, "day", W.anchor, W.target_end)
    return restrict_to(o, base, "customer_id")


def _finish(o: DataFrame, W: ObservationWindow, days_col: str, extra=()) -> DataFrame:
    ranked = rank_within(o, "customer_id", ["order_received_timestamp"], out="order_rank", dense=True)
    return ranked.select(days_since(W.anchor, "order_received_timestamp").alias(days_col),
                         *[F.col(c).cast("double").alias(c) if c in MONEY_COLS else F.col(c) for c in ORDER_COLS],
                         *extra, "order_rank")


def post_cross_tagged(orders: DataFrame, base: DataFrame, merchant_tags: DataFrame, tags: DataFrame,
                      W: ObservationWindow, spark: SparkSession, taxonomy=None) -> DataFrame:
    """Delivered service-A orders of newly crossed customers, one row per active cuisine tag,
    with order rank (dense, so repeated rows of one order share it) and cuisine group."""
    o = delivered(_window_orders(orders, base, W), statuses=(R.DELIVERED_STATUS,), case_insensitive=False,
                  city_col=None, order_type=R.A_ORDER_TYPE).select(*ORDER_COLS, "merchant_id")
    j = join_bridge(o, merchant_tags, tags, fact_key="merchant_id", bridge_fact_key="merchant_id",
                    bridge_dim_key="tag_id", dim_key="id", bridge_filter=F.lower("status") == R.TAG_STATUS_ACTIVE,
                    dim_filter=F.col("type") == R.TAG_TYPE_CUISINE)
    j = j.select(*ORDER_COLS, F.col("name").alias("cuisine"), F.col("id").alias("cuisine_id"))
    j = map_taxonomy(j, "cuisine", taxonomy_frame(spark, taxonomy))
    return _finish(j, W, "days_since_first_order", extra=["cuisine", "cuisine_id", "cuisine_group"])


def post_cross_orders(orders: DataFrame, base: DataFrame, W: ObservationWindow, word: str = R.B_BRAND_WORD,
                      order_type: str = R.B_ORDER_TYPE) -> DataFrame:
    """Service-B orders (merchant name contains ``word``, any status) of newly crossed customers."""
    o = _window_orders(orders, base, W).where(F.col("order_type") == order_type)
    o = name_contains(o, "merchant_name", word).select(*ORDER_COLS)
    return _finish(o, W, "days_since_first_order")
