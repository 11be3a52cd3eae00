"""Command line: land, publish, refresh and summarise a lake.

    python -m unilake land    --lake DIR (--sf-dir DIR | --source NAME=FOLDER ...)
    python -m unilake build   --lake DIR (--sf-dir DIR | --source NAME=FOLDER ...)
    python -m unilake refresh --lake DIR [--stream] [--model NAME ...]
    python -m unilake check   --lake DIR [--model NAME ...]
    python -m unilake summary --lake DIR
    python -m unilake vacuum  --lake DIR [--keep N]

``--lake`` defaults to ``<spark.checkpoint.dir>/lake``.  ``--sf-dir`` lands
the raw-shaped sources derived from a folder of driver tables;
``--source`` lands every dataset under a folder as one source's tables.
"""

from __future__ import annotations

import argparse
import logging
import sys

from unilake.session import build_session


def _lake(spark, path, namespace):
    from unilake.sources.landing import Lake
    return Lake(spark, path, namespace=namespace)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="unilake")
    ap.add_argument("command", choices=["land", "build", "refresh", "check", "summary", "vacuum"])
    ap.add_argument("--keep", type=int, default=2, help="vacuum: epochs / loads to keep")
    ap.add_argument("--lake")
    ap.add_argument("--namespace", default="", help="prefix of the lake's schemas in the catalog")
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--sf-dir")
    ap.add_argument("--source", action="append", default=[], metavar="NAME=FOLDER")
    ap.add_argument("--model", action="append", default=[])
    ap.add_argument("--stream", action="store_true", help="keep refreshing (target lag trigger)")
    ap.add_argument("--lenient-dates", action="store_true",
                    help="malformed date text becomes NULL (counted) instead of failing")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")

    spark = build_session(args.master)
    lake = _lake(spark, args.lake, args.namespace)
    from unilake.operators import quality
    from unilake.plans.layers import Publisher
    from unilake.plans.models import UNIFIED
    models = args.model or list(UNIFIED)

    sources: dict = {}
    if args.sf_dir:
        from unilake.sources.adapters import source_registry
        sources.update(source_registry(spark, args.sf_dir))
    for item in args.source:
        name, folder = item.split("=", 1)
        sources[name] = folder
    if args.command in ("land", "build") and not sources:
        ap.error(f"{args.command} needs --sf-dir or --source")

    if args.command == "land":
        landed = lake.land_many(sources)
        for table, rows in landed.items():
            print(f"landed {rows:>12,} in {table}")
    elif args.command == "build":
        from unilake.plans.run import build_all
        try:
            build_all(lake, sources, models, lenient_dates=args.lenient_dates).show(truncate=False)
        except quality.QualityGateError as exc:
            print(f"build stopped: {exc}", file=sys.stderr)
            spark.stop()
            return 1
    elif args.command == "refresh":
        from unilake.plans.layers import register_staging_views
        from unilake.streaming.refresh import snapshot_refresh, start_stream_refresh
        register_staging_views(lake, persistent=True)
        if args.stream:
            q = start_stream_refresh(lake, models, lenient_dates=args.lenient_dates)
            q.awaitTermination()
        else:
            pub = Publisher(lake, lenient_dates=args.lenient_dates)
            for m in models:
                res = snapshot_refresh(pub, m)
                print(f"{m}: epoch {res.epoch} versions {res.versions} rebuilt {res.rebuilt}"
                      + (f" date rejects {res.date_rejects}" if res.date_rejects else ""))
    elif args.command == "check":
        pub = Publisher(lake)
        for m in models:
            rep = pub.check(UNIFIED[m], pub.pointer(UNIFIED[m]).versions)
            rep.show(truncate=False)
            quality.gate(rep)
    elif args.command == "vacuum":
        pub = Publisher(lake)
        gone = [p for m in models for p in pub.vacuum(m, keep_epochs=args.keep)]
        gone += lake.vacuum_raw(keep_loads=args.keep)
        merged = lake.compact_audit()
        print(f"deleted {len(gone)} folders; merged {merged} audit files")
        for p in gone:
            print(f"  {p}")
    else:
        from unilake.operators.report import tolerant_summary
        pub = Publisher(lake)
        tables = [("raw", n, (lambda n=n: lake.read_raw(n))) for n in sorted(lake.current_loads())]
        tables += [("intermediate", m, (lambda m=m: pub.read(m))) for m in models]
        tolerant_summary(spark, tables).show(truncate=False)
        for m in models:
            try:
                print(f"{m}, smallest keys:")
                pub.read(m).orderBy(UNIFIED[m].key_name).limit(5).show(truncate=False)
            except Exception as exc:  # noqa: BLE001 - a readout, not a gate
                logging.warning("could not read %s: %s", m, exc)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
