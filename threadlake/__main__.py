"""One daily job from the command line: ``spark-submit -m``-style, or ``python -m threadlake``.

    python -m threadlake {ingest|process|transform|report|day} 2026-02-07 s3a://bucket/lake
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Mapping

from threadlake.plans import jobs
from threadlake.session import build_session
from threadlake.sources.layout import Lake


def run(spark, job: str, date: str, lake: Lake, config: jobs.JobConfig) -> Mapping[str, object]:
    """The job named ``job`` for one day; its counts."""
    if job == "ingest":
        items, ranked = jobs.read_source(spark, lake, date, config)
        return jobs.ingest_day(spark, lake, date, items, ranked, config)
    if job == "report":
        return jobs.report_day(spark, lake, date)
    return {"process": jobs.process_day, "transform": jobs.transform_day, "day": jobs.run_day}[job](
        spark, lake, date, config
    )


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("threadlake", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=("ingest", "process", "transform", "report", "day"))
    parser.add_argument("date", help="YYYY-MM-DD")
    parser.add_argument("lake", help="root folder of the tables")
    parser.add_argument("--cascade-orphans", action="store_true")
    parser.add_argument("--bad-input", choices=("row", "file"), default="row")
    given = parser.parse_args(arguments)
    spark = build_session(f"threadlake-{given.job}")
    config = jobs.JobConfig(cascade_orphans=given.cascade_orphans, bad_input=given.bad_input)
    stats = run(spark, given.job, given.date, Lake(given.lake), config)
    print(json.dumps(stats, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
