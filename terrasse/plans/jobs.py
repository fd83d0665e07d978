"""Command line: run one plan from table paths to a table path.

    spark-submit -m ... / python -m terrasse.plans.jobs person_registry --input person_events=... --output ...
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasse.plans import curate, health, persons
from terrasse.settings import build_session, drop_stages
from terrasse.sinks.writers import overwrite_table
from terrasse.sources.readers import read_config, read_table
from terrasse.streaming import events as streaming


@dataclass(frozen=True)
class Job:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    optional: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    arguments: tuple[str, ...] = ()


# Tables partitioned by period or type, not by place: one folder per place would mean many small files.
JOBS = {
    "person_registry": Job(persons.person_registry, ("person_events",), ("family_events",), ("is_current",)),
    "family_relations": Job(persons.family_relations, ("family_events",), (), ("relation_type",)),
    "residence_history": Job(persons.residence_history, ("person_events",), ("municipalities",), ("is_current",)),
    "municipality_migration": Job(persons.municipality_migration, ("residence",)),
    "population_stats": Job(persons.population_stats, ("registry",), (), ("reference_year",), ("as_of_year",)),
    "cohort_demographics": Job(persons.cohort_demographics, ("registry", "residence"), (), ("birth_decade",)),
    "marital_status_trends": Job(persons.marital_status_trends, ("registry",), (), ("reference_year",)),
    "migration_flows": Job(persons.migration_flows, ("residence",), (), ("reference_year",)),
    "household_structure": Job(persons.household_structure, ("registry", "relations")),
    "death_facts": Job(health.death_facts, ("deaths", "codes")),
    "contributing_causes": Job(health.contributing_causes, ("deaths", "codes")),
    "department_metrics": Job(curate.department_metrics, ("silver",)),
}


def run(spark: SparkSession, name: str, inputs: dict[str, str], output: str, **arguments) -> None:
    """Read the inputs, build the plan and replace the output table."""
    job = JOBS[name]
    missing = [i for i in job.inputs if i not in inputs] + [a for a in job.arguments if a not in arguments]
    if missing:
        raise ValueError(f"{name} needs {', '.join(missing)}")
    frames = {i: read_table(spark, inputs[i]) for i in (*job.inputs, *job.optional) if i in inputs}
    df = job.build(**frames, **{a: arguments[a] for a in job.arguments})
    overwrite_table(df.withColumn("_updated_at", F.current_timestamp()), output, job.partition_by)
    drop_stages(spark)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "curate", "files_to_bronze", "broker_to_bronze"])
    parser.add_argument("--input", action="append", default=[], metavar="NAME=PATH")
    parser.add_argument("--output")
    parser.add_argument("--config")
    parser.add_argument("--as-of-year", type=int)
    parser.add_argument("--checkpoint")
    parser.add_argument("--servers")
    parser.add_argument("--topics", default="")
    parser.add_argument("--group", default="")
    parser.add_argument("--starting-offsets", default="latest")
    args = parser.parse_args(argv)
    inputs = dict(i.split("=", 1) for i in args.input)
    spark = build_session(f"terrasse:{args.job}")
    if args.job == "curate":
        curate.bronze_to_silver(spark, read_config(spark, args.config))
    elif args.job == "files_to_bronze":
        streaming.files_to_bronze(spark, inputs["source"], args.output, args.checkpoint).awaitTermination()
    elif args.job == "broker_to_bronze":
        topics = [t.strip() for t in args.topics.split(",") if t.strip()]
        streaming.broker_to_bronze(
            spark, args.servers, topics, args.group, args.output, args.checkpoint, args.starting_offsets
        ).awaitTermination()
    else:
        given = {} if args.as_of_year is None else {"as_of_year": args.as_of_year}
        run(spark, args.job, inputs, args.output, **given)


if __name__ == "__main__":
    main()
