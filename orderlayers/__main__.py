"""Command line: python -m orderlayers <command> …; run through spark-submit on a cluster."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.storagelevel import StorageLevel

from orderlayers import plans, sources, streaming
from orderlayers import schema as S
from orderlayers.plans.sample import SAMPLE_ROWS
from orderlayers.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="orderlayers")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    for name, text in (
        ("load", "ingest files, then run ELT"),
        ("ingest", "append files to the raw layer"),
        ("stream", "append files not seen yet, in micro-batches"),
    ):
        sub = command(name, text, "path", "base")
        sub.add_argument("--run-id")
        sub.add_argument("--by-header", action="store_true")
        if name == "ingest":
            sub.add_argument("--gaps", action="store_true", help="unique row numbers, one scan")
            sub.add_argument("--multi-line", action="store_true", help="fields may span lines")
    elt = command("elt", "raw layer to validated and quarantine layers", "base")
    elt.add_argument("--run-id")
    elt.add_argument("--only-runs", nargs="+")
    elt.add_argument("--only-new", action="store_true", help="runs not merged before")
    elt.add_argument("--keep", action="store_true", help="keep classified rows for both layers")
    drop = command("drop-old", "delete layer versions no reader needs", "base")
    drop.add_argument("--keep", type=int, default=1, help="versions that stay")
    sample = command("sample", "first rows of a file as a smaller one", "path", "output")
    sample.add_argument("--rows", type=int, default=SAMPLE_ROWS)
    command("inventory", "files, sizes and ingest mode", "path")
    command("preview", "a few rows of each layer", "base")
    command("report", "the latest run", "base")
    command("reset", "empty all layers", "base")
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session()
    run_id = getattr(args, "run_id", None) or time.strftime("run_%Y%m%d_%H%M%S")
    if args.command == "load":
        options = {"by_header": args.by_header}
        result = plans.load_orders(spark, args.path, args.base, run_id, **options)
    elif args.command == "ingest":
        result = plans.ingest_files(
            spark, args.path, args.base, run_id, args.by_header, not args.gaps, args.multi_line
        )
    elif args.command == "stream":
        result = streaming.ingest_stream(spark, args.path, args.base, run_id, args.by_header)
    elif args.command == "elt":
        storage = StorageLevel.MEMORY_AND_DISK if args.keep else None
        result = plans.run_elt(spark, args.base, run_id, args.only_runs, storage, only_new=args.only_new)
    elif args.command == "drop-old":
        result = {
            layer: sources.drop_old_versions(spark, args.base, layer, args.keep)
            for layer in (S.VALIDATED, S.QUARANTINE)
        }
    elif args.command == "sample":
        result = plans.write_sample(spark, args.path, args.output, args.rows)
    elif args.command == "reset":
        result = plans.reset_layers(spark, args.base)
    elif args.command == "preview":
        for layer, rows in plans.preview_layers(spark, args.base).items():
            print(layer)
            rows.show(truncate=False)
        return
    else:
        if args.command == "report":
            rows = sources.latest_report(sources.read_reports(spark, args.base))
        else:
            rows = sources.file_inventory(spark, args.path)
        rows.show(truncate=False)
        return
    if result is not None:
        print(json.dumps(result, ensure_ascii=False, indent=2))


if __name__ == "__main__":
    main()
