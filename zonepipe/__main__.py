"""Command line: ``python -m zonepipe run|stream|generate`` (or through spark-submit)."""

from __future__ import annotations

import argparse

from zonepipe.contract import Contract
from zonepipe.operators.synth import synth_actives, synth_viewership
from zonepipe.plans.dataset import run_dataset
from zonepipe.sources.session import job_session
from zonepipe.sources.zones import land
from zonepipe.streaming.ingest import stream_ingest


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="zonepipe", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=about)
        sub.add_argument("dataset")
        sub.add_argument("--config", required=True, help="path of the contract file")
        return sub

    run = job("run", "one batch run: ingest, check, transform, stage, check, lookup")
    run.add_argument("--as-of", required=True, help="date lookup versions of this run begin on")
    run.add_argument("--version", required=True, type=int, help="increasing run number")
    run.add_argument("--arrival", help="landed folder or file to ingest; all if not given")
    run.add_argument("--strict", action="store_true", help="fail on values that do not cast")

    run.add_argument("--pepper-file", help="text file whose content goes into every mask")

    stream = job("stream", "process what has landed since the last call")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--max-files", help="files per micro-batch")
    stream.add_argument("--strict", action="store_true")
    stream.add_argument("--pepper-file", help="text file whose content goes into every mask")

    generate = job("generate", "land synthetic rows")
    generate.add_argument("--rows", type=int, default=1000)
    generate.add_argument("--seed", type=int, default=0)
    generate.add_argument("--stamp", required=True, help="arrival suffix, e.g. 20240131_000000")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = job_session(f"zonepipe-{args.job}-{args.dataset}")
    contract = Contract.load(spark, args.config, args.dataset)
    pepper = None
    if getattr(args, "pepper_file", None):
        pepper = spark.read.text(args.pepper_file, wholetext=True).first()[0].strip()
    if args.job == "run":
        report = run_dataset(
            spark, contract, args.as_of, args.version, args.arrival, strict=args.strict, pepper=pepper
        )
        for check in report.checks:
            print(*check, sep="\t")
        print(report.lookup)
    elif args.job == "stream":
        options = {"maxFilesPerTrigger": args.max_files} if args.max_files else None
        stream_ingest(
            spark, contract, args.checkpoint, options=options, strict=args.strict, pepper=pepper
        ).awaitTermination()
    else:
        makers = {"actives": synth_actives, "viewership": synth_viewership}
        rows = makers[contract.dataset](spark.range(args.rows), "id", args.seed)
        print(land(rows, contract, args.stamp))


if __name__ == "__main__":
    main()
