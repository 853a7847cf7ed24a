"""Command line for an external scheduler: ``spark-submit -m newslake concat PATTERN... OUTPUT``."""

import argparse

from newslake.plans import jobs
from newslake.session import build_session
from newslake.sources import lake, published


def main(argv=None):
    parser = argparse.ArgumentParser(prog="newslake")
    commands = parser.add_subparsers(dest="command", required=True)
    concat = commands.add_parser("concat", help="union batches, drop copies, append JSON lines")
    concat.add_argument("inputs", nargs="+")
    concat.add_argument("output")
    concat.add_argument("--dedup", choices=["per_input", "global"], default="per_input")
    migrate = commands.add_parser("migrate", help="publish every batch below a folder")
    migrate.add_argument("root")
    migrate.add_argument("output")
    migrate.add_argument("--format", help="append to a store of this format instead of a run of the published table")
    migrate.add_argument("--mode", choices=["FAILFAST", "PERMISSIVE"], default="FAILFAST")
    migrate.add_argument("--run", help="a name, so that the migration can be started again; default: after the root")
    compact = commands.add_parser("compact", help="lay small runs of a lake or published table out anew in few files")
    compact.add_argument("kind", choices=["lake", "published"])
    compact.add_argument("root")
    runs = {
        "incremental": ("one run from listing and page tables to the published table", ["listing", "pages", "root", "published"]),
        "pages": ("the same from raw listing pages", ["listing_pages", "pages", "root", "published"]),
        "full": ("full run from listing and page tables", ["listing", "pages", "root"]),
        "api": ("full run from search answers", ["answers", "source", "root"]),
    }
    for name, (about, arguments) in runs.items():
        run = commands.add_parser(name, help=about)
        for argument in arguments:
            run.add_argument(argument)
        if name in ("incremental", "pages"):
            run.add_argument("stamp", type=int)
            run.add_argument("--max-news", type=int, help="take no more rows of a source and category; default: all")
            run.add_argument("--recent", type=int, help="stop at the first so many of the last batch only; default: any")
            run.add_argument("--on-no-match", choices=["rule", "keep", "drop"], default="rule")
        else:
            run.add_argument("--run", help="a name, so that the run can be started again")
    args = parser.parse_args(argv)

    spark = build_session(f"newslake {args.command}")
    if args.command == "concat":
        jobs.concat(spark, args.inputs, args.output, args.dedup)
    elif args.command == "migrate":
        jobs.migrate_all(spark, args.root, args.output, args.mode, args.run, args.format)
        jobs.migrate_counts(spark, args.root).filter("path IS NULL OR problem IS NOT NULL").show(1000, False)
    elif args.command == "compact":
        (lake if args.kind == "lake" else published).compact(spark, args.root)
    elif args.command in ("incremental", "pages"):
        job = jobs.run_incremental if args.command == "incremental" else jobs.run_from_pages
        listing = spark.read.parquet(args.listing if args.command == "incremental" else args.listing_pages)
        job(spark, listing, spark.read.parquet(args.pages), args.root, args.published, args.stamp, max_news=args.max_news,
            recent=args.recent, on_no_match=args.on_no_match)
    elif args.command == "full":
        jobs.run_full(spark, spark.read.parquet(args.listing), spark.read.parquet(args.pages), args.root, run=args.run)
    else:
        jobs.run_api_full(spark, spark.read.parquet(args.answers), args.source, args.root, run=args.run)


if __name__ == "__main__":
    main()
