"""The job: names a source system and three paths, and runs.

    spark-submit --py-files customer_canon.zip customer_canon/plans/job.py \\
        --source_system ERP_B --input_path s3a://... --processed_path s3a://... --rejected_path s3a://...
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark import StorageLevel
from pyspark.sql import SparkSession

from customer_canon.plans.run import FAILED, RunReport, run
from customer_canon.rules import DF_PARITY, STRICT
from customer_canon.sinks.files import canonical_projection, raw_rejects
from customer_canon.sources.providers import provider_for

RULES = {"strict": STRICT, "parity": DF_PARITY}


@dataclass(frozen=True)
class JobArgs:
    source_system: str
    input_path: str
    processed_path: str
    rejected_path: str

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> JobArgs:
        """Picks the job's own options; a missing one is a KeyError."""
        return cls(**{field.name: options[field.name] for field in fields(cls)})


def run_job(spark: SparkSession, args: JobArgs, **options: object) -> RunReport:
    """``run`` for a source system given by name; ValueError if it is not known."""
    return run(
        spark,
        args.input_path,
        args.processed_path,
        args.rejected_path,
        provider_for(args.source_system),
        **options,
    )


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Bring one customer extract into canonical form.")
    for field in fields(JobArgs):
        parser.add_argument(f"--{field.name}", required=True)
    parser.add_argument("--ledger_path", help="folder that collects one JSON row per run")
    parser.add_argument("--multi_line", action="store_true", help="cells may contain line breaks")
    parser.add_argument(
        "--source_layout", action="store_true", help="write rejects as source records, customers without source ids"
    )
    parser.add_argument("--rules", choices=sorted(RULES), default="strict", help="how rows are routed")
    parser.add_argument("--cache", action="store_true", help="parse the input once and keep its rows for both outputs")
    parser.add_argument("--rows_per_file", type=int, help="most rows of a processed file")
    parser.add_argument("--reject_files", type=int, help="number of reject files")
    parser.add_argument("--no_raw", action="store_true", help="leave source records out of the rejects")
    options = vars(parser.parse_args(argv))
    if options["no_raw"] and options["source_layout"]:
        parser.error("--source_layout needs the source records")

    spark = SparkSession.builder.appName(f"customer-canon {options['source_system']}").getOrCreate()
    report = run_job(
        spark,
        JobArgs.from_options(options),
        ledger_path=options["ledger_path"],
        multi_line=options["multi_line"],
        rules=RULES[options["rules"]],
        cache=StorageLevel.MEMORY_AND_DISK if options["cache"] else None,
        rows_per_file=options["rows_per_file"],
        reject_files=options["reject_files"],
        keep_raw=not options["no_raw"],
        processed_layout=canonical_projection if options["source_layout"] else None,
        rejected_layout=raw_rejects if options["source_layout"] else None,
    )
    print(report)
    return 1 if report.status == FAILED else 0


if __name__ == "__main__":
    raise SystemExit(main())
