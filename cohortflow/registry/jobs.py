"""Composed jobs registered over the test bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortflow import rules as R
from cohortflow.params import TripThresholds
from cohortflow.plans import crosssell as X
from cohortflow.plans import feature_store as FS
from cohortflow.plans import locations as L
from cohortflow.plans import many_anchors as MA
from cohortflow.plans import places as PL
from cohortflow.plans import postcross as PC
from cohortflow.plans import reactivation as P
from cohortflow.plans import trips as TR
from cohortflow.registry import register
from cohortflow.session import cut_lineage, ensure_checkpoint_dir
from cohortflow.sources import testbed as T
from cohortflow.sources.testbed import Sources


def _react(spark, sf_dir) -> P.ReactivationSources:
    return P.ReactivationSources.from_testbed(Sources(spark, sf_dir))


@register("job_lapsed_base")
def job_lapsed_base(spark, sf_dir):
    return P.lapsed_base(_react(spark, sf_dir), T.REACTIVATION_W, min_recency=30, min_orders=5)


@register("job_reactivation_targets")
def job_reactivation_targets(spark, sf_dir):
    return P.reactivation_targets(_react(spark, sf_dir), T.REACTIVATION_W, min_recency=30, min_orders=5,
                                  rides_since="1995-01-01")


@register("job_reactivation_features")
def job_reactivation_features(spark, sf_dir):
    return P.reactivation_features(_react(spark, sf_dir), T.ANCHOR_DAY_W, outcome_cities=R.OUTCOME_CITIES,
                                   rides_since="1995-01-01")


@register("job_reactivation_features_blended")
def job_reactivation_features_blended(spark, sf_dir):
    return P.reactivation_features(_react(spark, sf_dir), T.ANCHOR_DAY_W, outcome_cities=R.OUTCOME_CITIES_ALL,
                                   with_city=False, with_blended=True, rides_since="1995-01-01")


@register("job_reactivation_features_many")
def job_reactivation_features_many(spark, sf_dir):
    return MA.reactivation_features(_react(spark, sf_dir), T.ANCHOR_DAYS, T.ANCHOR_DAY_W.history_start, outcome_days=91,
                                    rides_since="1995-01-01")


@register("job_reactivation_features_stored")
def job_reactivation_features_stored(spark, sf_dir):
    """P1 from feature tables in buckets: the joins shuffle nothing."""
    store = FS.FeatureStore(spark, ensure_checkpoint_dir(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    FS.store_reactivation(store, _react(spark, sf_dir), T.ANCHOR_DAY_W, rides_since="1995-01-01")
    return FS.reactivation_from(store, T.ANCHOR_DAY_W)


# ---- cross-sell family -------------------------------------------------------------------

TRIP_THRESHOLDS = TripThresholds(fav_cct_min_trip_cnt=3, fav_commute_time_min_trip_cnt=2, fav_payment_min_trip_cnt=3,
                                 min_share_pct=20.0, promo_percent_threshold=50.0)
MEMBERSHIP_DAYS = 18
PLACE_MIN_COUNT = 2


def cohort(spark, sf_dir):
    """P5 adoption cohort: the customer base of the cross-sell features."""
    s = Sources(spark, sf_dir)
    return X.adoption_cohort(s.trips, s.first_orders, T.CROSS_SELL_W)


def stored_cohort(spark, sf_dir):
    """The cohort materialised once, as ``anchor_run`` does: its key set cuts the histories and its rows join the result."""
    return cut_lineage(cohort(spark, sf_dir))


@register("job_adoption_cohort")
def job_adoption_cohort(spark, sf_dir):
    return cohort(spark, sf_dir)


def crossed_base(spark, sf_dir, service: str):
    s = Sources(spark, sf_dir)
    return X.crossed_on(s.trips, s.first_orders, T.CROSS_SELL_W, service)


@register("job_crossed_on_a")
def job_crossed_on_a(spark, sf_dir):
    return crossed_base(spark, sf_dir, "a")


@register("job_crossed_on_b")
def job_crossed_on_b(spark, sf_dir):
    return crossed_base(spark, sf_dir, "b")


@register("job_base_stamped")
def job_base_stamped(spark, sf_dir):
    return X.stamp_anchor(cohort(spark, sf_dir), T.CROSS_SELL_W)


@register("job_cohorts_many")
def job_cohorts_many(spark, sf_dir):
    """P5-P8 for several anchors from one table of first dates and day bitmaps."""
    s = Sources(spark, sf_dir)
    return X.cohorts(*X.cohort_table(s.trips, s.first_orders), T.COHORT_WINDOWS)


@register("job_trip_features")
def job_trip_features(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return TR.trip_features(s.trips, cohort(spark, sf_dir), s.credits, T.CROSS_SELL_W, TRIP_THRESHOLDS)


@register("job_membership_status")
def job_membership_status(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return X.membership_status(cohort(spark, sf_dir), s.active_subs, T.EVENTS_W, MEMBERSHIP_DAYS)


@register("job_commute_place")
def job_commute_place(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return PL.commute_place(s.bookings, s.place_locations, s.place_coordinates, s.place_details,
                            stored_cohort(spark, sf_dir), T.EVENTS_W, PLACE_MIN_COUNT)


@register("job_last_known_features")
def job_last_known_features(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return X.last_known_features(s.demographics, stored_cohort(spark, sf_dir), T.EVENTS_W)


@register("job_profile_features")
def job_profile_features(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return X.profile_features(s.profile, cohort(spark, sf_dir))


@register("job_dropoff_points")
def job_dropoff_points(spark, sf_dir):
    return L.point_counts(Sources(spark, sf_dir).trips, stored_cohort(spark, sf_dir), T.CROSS_SELL_W, "dropoff")


@register("job_pickup_points")
def job_pickup_points(spark, sf_dir):
    return L.point_counts(Sources(spark, sf_dir).trips, stored_cohort(spark, sf_dir), T.CROSS_SELL_W, "pickup")


@register("job_dominant_cell")
def job_dominant_cell(spark, sf_dir):
    return L.dominant_cell(job_dropoff_points(spark, sf_dir))


def _area_frame(spark, sf_dir, line="food"):
    trips, base = Sources(spark, sf_dir).trips, stored_cohort(spark, sf_dir)
    drop = L.dominant_cell(L.point_counts(trips, base, T.CROSS_SELL_W, "dropoff"))
    pick = L.dominant_cell(L.point_counts(trips, base, T.CROSS_SELL_W, "pickup"))
    return L.area_frame(base, drop, pick, f"{line}_first_order_date")


@register("job_area_scores_dropoff")
def job_area_scores_dropoff(spark, sf_dir):
    W = T.CROSS_SELL_W
    return L.area_scores(_area_frame(spark, sf_dir), area="cell_dropoff", first_col="food_first_order_date",
                         start=W.source_start, end=W.anchor)


@register("job_area_scores_pickup")
def job_area_scores_pickup(spark, sf_dir):
    W = T.CROSS_SELL_W
    return L.area_scores(_area_frame(spark, sf_dir), area="cell_pickup", first_col="food_first_order_date",
                         start=W.source_start, end=W.anchor)


@register("job_area_scores_shop_dropoff")
def job_area_scores_shop_dropoff(spark, sf_dir):
    W = T.CROSS_SELL_W
    return L.area_scores(_area_frame(spark, sf_dir, "shop"), area="cell_dropoff", first_col="shop_first_order_date",
                         start=W.source_start, end=W.anchor)


@register("job_post_cross_tagged")
def job_post_cross_tagged(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return PC.post_cross_tagged(s.orders, crossed_base(spark, sf_dir, "a"), s.merchant_tags, s.tags, T.CROSS_SELL_W,
                                spark)


@register("job_post_cross_orders")
def job_post_cross_orders(spark, sf_dir):
    s = Sources(spark, sf_dir)
    return PC.post_cross_orders(s.orders, crossed_base(spark, sf_dir, "b"), T.CROSS_SELL_W, word=R.B_BRAND_WORD)
