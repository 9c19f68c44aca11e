"""spark-submit entry points for the two runs.

    spark-submit vitrine/jobs.py bronze --listing-pages db.listing_pages \\
        --menu-pages db.menu_pages --run-ts '2025-04-07 06:00:00'
    spark-submit vitrine/jobs.py silver --run-ts '2025-04-07 06:00:00'

Inputs are table names or Parquet paths. The session comes from the
cluster; only ``configure`` is applied to it.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, source: str) -> DataFrame:
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def main(argv: list[str] | None = None) -> dict:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from vitrine.plans import bronze, silver
    from vitrine.session import TIME_ZONE, configure
    from vitrine.sources.tables import session_setting

    parser = argparse.ArgumentParser(prog="vitrine")
    sub = parser.add_subparsers(dest="run", required=True)
    b = sub.add_parser("bronze", help="load product cards and seller categories")
    b.add_argument("--listing-pages", required=True, help="page_id, url, html, seller, category")
    b.add_argument("--menu-pages", help="page_id, url, html, seller; without it only the configured categories count")
    b.add_argument("--sources", help="table/path of sources; default: the configured three shops")
    b.add_argument("--run-ts", required=True)
    b.add_argument("--limit", type=int, default=0, help="cards per category page; 0 = all")
    b.add_argument("--id-start", choices=["table", "latest_partition"], default="table",
                   help="where the stored maximum product id is read")
    b.add_argument("--report", action="store_true", help="print cards found and failed per seller")
    s = sub.add_parser("silver", help="build catalog, last version and categories")
    s.add_argument("--run-ts", required=True)
    s.add_argument("--ignore-delay", action="store_true")
    s.add_argument("--load-type", choices=["full", "incremental"])
    s.add_argument("--id-mode", choices=["stable", "random"], default="stable")
    s.add_argument("--dense", action="store_true")
    s.add_argument("--catalog-mode", choices=["full", "incremental"], default="full",
                   help="incremental: merge the loads after the stored state instead of reading all loads")
    s.add_argument("--changed-since", help="oldest load date rewritten since the last incremental catalog")
    for p in (b, s):
        p.add_argument("--time-zone", default=TIME_ZONE, help="zone of the load dates")
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.getOrCreate())
    with session_setting(spark, "spark.sql.session.timeZone", args.time_zone):
        if args.run == "silver":
            return silver.run_silver(spark, args.run_ts, args.ignore_delay, args.load_type, args.id_mode, args.dense,
                                     catalog_mode=args.catalog_mode, changed_since=args.changed_since)
        sources = _read(spark, args.sources) if args.sources else bronze.default_sources(spark)
        listing = _read(spark, args.listing_pages)
        links = bronze.no_links(spark)
        if args.menu_pages:
            links = bronze.links_from_menu_pages(bronze.chosen_menu_pages(_read(spark, args.menu_pages), sources))
        done = bronze.run_bronze(spark, listing, sources, links, args.run_ts, args.limit or None, id_start=args.id_start)
        if args.report:
            for row in done["cards"]:
                print(row)
        return done


if __name__ == "__main__":
    print(main())
