"""Run the jobs for one anchor on your own tables.

    python -m cohortflow.cli reactivation --tables tables.json --anchor 2024-01-21 \
        --history-start 2021-11-01 --end 2024-04-20 --out /shared/out
    python -m cohortflow.cli cross-sell --tables tables.json --anchor 2024-01-21 \
        --source-start 2023-10-01 --target-end 2024-02-21 --out /shared/out
    python -m cohortflow.cli post-cross --tables tables.json --anchor 2024-01-21 \
        --source-start 2023-10-01 --target-end 2024-02-21 --out /shared/out

``tables.json`` maps the domain table names of README "Bringing your own tables" to Parquet
paths (or table names with ``"table:"`` prefix). Results are written as Parquet partitioned by
anchor with dynamic overwrite, so rerunning an anchor replaces only that anchor's partitions.
``reactivation`` with ``--through`` runs every day from the anchor to that day in one plan (features only; the outcome
of each has as many days as that of the anchor). ``--count-rejects`` adds a table ``rejected_ids`` with the
missing ids and those that cannot be cast, by source.
The session comes from ``SparkSession.builder.getOrCreate()`` (cluster settings apply).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from cohortflow import rules as R


def _load(spark: SparkSession, ref: str) -> DataFrame:
    return spark.table(ref[len("table:"):]) if ref.startswith("table:") else spark.read.parquet(ref)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="cohortflow")
    ap.add_argument("job", choices=["reactivation", "cross-sell", "post-cross"])
    ap.add_argument("--tables", required=True, help="JSON file: domain table name -> Parquet path / table:<name>")
    ap.add_argument("--anchor", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--history-start", help="first day of the order history (reactivation)")
    ap.add_argument("--end", help="inclusive outcome end (reactivation)")
    ap.add_argument("--source-start", help="first day of the observation window (cross-sell)")
    ap.add_argument("--target-end", help="exclusive outcome end (cross-sell)")
    ap.add_argument("--rides-since", help="first day of the ride history; without it all rides before the anchor count")
    ap.add_argument("--blended", action="store_true", help="add the blended margin, drop the city (P2)")
    ap.add_argument("--outcome-cities", type=lambda x: tuple(int(c) if c.isdigit() else c for c in x.split(",")))
    ap.add_argument("--lapse-days", type=int, default=R.LAPSE_MIN_DAYS)
    ap.add_argument("--min-orders", type=int, default=R.GRADUATED_MIN_ORDERS)
    ap.add_argument("--base", choices=["adoption", "crossed_a", "crossed_b"], default="adoption")
    ap.add_argument("--lines", default="food,shop", help="lines of the area scores")
    ap.add_argument("--membership-days", type=int, default=18)
    ap.add_argument("--place-min-count", type=int, default=1)
    ap.add_argument("--count-rejects", action="store_true", help="write how many ids of each source are missing or cannot be cast")
    ap.add_argument("--through", help="last anchor of a run over many days (reactivation)")
    ap.add_argument("--thresholds", type=json.loads, default={}, help='JSON of trip thresholds, e.g. {"min_share_pct": 10}')
    ap.add_argument("--cell-edge-km", type=float, default=R.HEX_EDGE_KM, help="edge of the hexagons of home cells")
    ap.add_argument("--brand-word", default=R.B_BRAND_WORD, help="word in the merchant names of service B (post-cross)")
    args = ap.parse_args(argv)
    needed = {"reactivation": ("history_start", "end"), "cross-sell": ("source_start", "target_end"),
              "post-cross": ("source_start", "target_end")}[args.job]
    if missing := [f"--{n.replace('_', '-')}" for n in needed if getattr(args, n) is None]:
        ap.error(f"{args.job} needs {', '.join(missing)}")

    from cohortflow.functions.geo import hex_cell
    from cohortflow.params import ObservationWindow, TripThresholds, as_date
    from cohortflow.plans import anchor_run, reactivation as P
    from cohortflow.session import drop_intermediates
    from cohortflow.sources.rejects import ID_COLUMNS, rejected_ids

    spark = SparkSession.builder.appName(f"cohortflow-{args.job}").getOrCreate()
    with open(args.tables) as fh:
        tables = {name: _load(spark, ref) for name, ref in json.load(fh).items()}

    try:
        if args.count_rejects:
            ids = rejected_ids({n: (tables[n], *of) for n, of in ID_COLUMNS[args.job].items()})
            anchor_run.write_tables({"rejected_ids": ids}, args.out, args.anchor)
        if args.job == "reactivation":
            W = ObservationWindow.of(args.history_start, args.anchor, args.end, history_start=args.history_start,
                                     end_date=args.end)
            src = P.ReactivationSources(tables["orders"], tables["merchants"], tables["customers"], tables["value_lines"],
                                        tables["order_level"], tables["trips"], tables["subscription_events"],
                                        tables["profile"])
            cities = args.outcome_cities or (R.OUTCOME_CITIES_ALL if args.blended else R.OUTCOME_CITIES)
            if args.through:
                from cohortflow.plans import many_anchors as MA
                from cohortflow.sources.sinks import write_by

                last = as_date(args.through)
                days = [W.anchor + dt.timedelta(days=k) for k in range((last - W.anchor).days + 1)]
                write_by(MA.reactivation_features(src, days, W.history_start, (W.end_date - W.anchor).days, cities, not args.blended, args.blended,
                                                  args.rides_since), f"{args.out.rstrip('/')}/reactivation_features", "anchor")
                return
            out = {
                "reactivation_features": P.reactivation_features(
                    src, W, cities, with_city=not args.blended, with_blended=args.blended, rides_since=args.rides_since),
                "reactivation_targets": P.reactivation_targets(src, W, args.lapse_days, args.min_orders,
                                                               rides_since=args.rides_since),
                "lapsed_base": P.lapsed_base(src, W, args.lapse_days, args.min_orders),
            }
        else:
            W = ObservationWindow.of(args.source_start, args.anchor, args.target_end)
            src = anchor_run.CrossSellSources(**{f: tables.get(f) for f in anchor_run.CrossSellSources.__dataclass_fields__})
            if args.job == "cross-sell":
                out = anchor_run.cross_sell_tables(src, W, base=args.base, lines=tuple(args.lines.split(",")),
                                                   membership_days=args.membership_days, place_min_count=args.place_min_count,
                                                   thresholds=TripThresholds(**args.thresholds),
                                                   cell_expr=hex_cell("latitude", "longitude", args.cell_edge_km))
            else:
                out = anchor_run.post_cross_tables(src, tables["orders"], tables["merchant_tags"], tables["tags"], W, word=args.brand_word)
        anchor_run.write_tables(out, args.out, W.anchor)
    finally:
        drop_intermediates(spark)


if __name__ == "__main__":
    main()
