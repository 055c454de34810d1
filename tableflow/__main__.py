"""Run jobs from the command line: ``python -m tableflow <kind> <file>``, or this file with
``spark-submit --py-files``.

The file holds JSON: a job or a list of jobs for ``export`` and ``create``, one job for ``import``, and the
named arguments of the job for all other kinds.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tableflow.plans.csvload import csv_load, csv_load_with_rejects
from tableflow.plans.dbimport import import_job
from tableflow.plans.export import ExportSettings, create_target, export_jobs
from tableflow.plans.kvload import backup_export_job, shard_export_job, upsert_job
from tableflow.plans.migrate import migrate, migrate_changed
from tableflow.plans.report import report_job
from tableflow.spec import JobSpec, PartitionSpec

KINDS = {"csv-load": csv_load, "csv-load-rejects": csv_load_with_rejects, "migrate": migrate,
         "migrate-changed": migrate_changed, "kv-export": shard_export_job,
         "kv-records": backup_export_job, "kv-upsert": upsert_job, "report": report_job}


def run(spark: SparkSession, kind: str, text: str, settings: ExportSettings,
        at_once: int = 1) -> None:
    if kind == "export":
        for result in export_jobs(spark, JobSpec.list_from_json(text), settings, at_once=at_once):
            for loss in result.losses or []:
                print(f"{result.job.target_table} {loss.name}: {loss.lost} of {loss.present} lost")
    elif kind == "create":
        for job in JobSpec.list_from_json(text):
            create_target(spark, job, settings)
    elif kind == "import":
        import_job(spark, JobSpec.from_dict(json.loads(text)))
    else:
        arguments = json.loads(text)
        if "spec" in arguments:
            arguments["spec"] = PartitionSpec.parse(arguments["spec"])
        found = KINDS[kind](spark, **arguments)
        if kind == "csv-load-rejects":
            print("{} lines loaded, {} rejected".format(*found))
        elif kind == "migrate-changed":
            for state, count in found.groupBy("state").count().orderBy("state").collect():
                print(f"{count} partitions {state}")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tableflow")
    parser.add_argument("kind", choices=["create", "export", "import", *KINDS])
    parser.add_argument("file", help="JSON file with the job or its arguments")
    parser.add_argument("--create", action="store_true", help="create export targets first")
    parser.add_argument("--provider", default="parquet", help="table format of created targets")
    parser.add_argument("--catalog", action="append", default=[], metavar="FROM=TO",
                        help="map the first part of export target names to a catalog")
    parser.add_argument("--static", action="append", default=[], metavar="PART",
                        help="overwrite export targets with this first part statically")
    parser.add_argument("--count-losses", action="store_true",
                        help="say what the casts of an export lost")
    parser.add_argument("--max-lost", type=int, metavar="N",
                        help="fail export jobs whose casts lose more values of a column")
    parser.add_argument("--at-once", type=int, default=1, metavar="N",
                        help="export jobs that run at the same time")
    parser.add_argument("--escaped", action="store_true",
                        help="function parameters are written as SQL literals")
    options = parser.parse_args(argv)
    settings = ExportSettings(
        create=options.create, provider=options.provider, escaped=options.escaped,
        catalogs=dict(pair.split("=", 1) for pair in options.catalog),
        static_targets=frozenset(options.static), count_losses=options.count_losses,
        max_lost=options.max_lost)
    with open(options.file, encoding="utf-8") as file:
        text = file.read()
    run(SparkSession.builder.appName(f"tableflow {options.kind}").getOrCreate(), options.kind,
        text, settings, options.at_once)


if __name__ == "__main__":
    main()
