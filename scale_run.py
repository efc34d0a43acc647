"""One year's run over many copies of the register, timed step by step.

    SCALE_COPIES=40 BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python scale_run.py

A third of the loans is moved to one state, so that the steps meet a hot key.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from bench import session
from lienspark.operators.quality import unique_failures
from lienspark.plans.enrich import enrich_year
from lienspark.plans.ingest import ingest_loans
from lienspark.plans.load import load_year
from lienspark.plans.marts import build_marts, loan_fact, sample_of, segmented, summarise
from lienspark.settings import fresh_path
from lienspark.sinks.lake import count_files, write_rates
from lienspark.sources.lake import read_staging
from lienspark.sources.seeds import builtin_seeds
from lienspark_checks import fixtures

YEAR = 2024


def main() -> None:
    copies = int(os.environ.get("SCALE_COPIES", "40"))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    place = fresh_path(spark, "scale")
    table = f"scale_{place.split('/')[-2]}"

    loans = fixtures.register(spark, sf_dir, all_states=True)
    copied = loans.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = copied.withColumn("state_code", F.expr("if(copy % 3 = 0, 'CA', state_code)"))
    hot.repartition(16).drop("copy").write.option("sep", "|").option("header", True).csv(
        f"{place}/register"
    )
    write_rates(fixtures.rates(spark, sf_dir), f"{place}/rates")

    seconds = {}

    def timed(step: str, action):
        started = time.perf_counter()
        result = action()
        seconds[step] = round(time.perf_counter() - started, 2)
        return result

    report = timed(
        "ingest", lambda: ingest_loans(spark, f"{place}/register", f"{place}/raw", YEAR)
    ).first()
    timed(
        "enrich",
        lambda: enrich_year(spark, f"{place}/raw", f"{place}/rates", f"{place}/staging", YEAR),
    )
    timed(
        "load",
        lambda: load_year(
            read_staging(spark, f"{place}/staging/{YEAR}"), table, YEAR, location=f"{place}/table"
        ),
    )
    fact = loan_fact(spark.table(table), builtin_seeds(spark))

    def discard(frame):
        frame.write.format("noop").mode("overwrite").save()

    timed("fact", lambda: discard(fact))
    scored = segmented(spark.table(table))
    seeds = builtin_seeds(spark)
    timed("summary", lambda: discard(summarise(scored, seeds)))
    timed("sample", lambda: discard(sample_of(scored, seeds, seed=1)))
    timed("unique_id", lambda: discard(unique_failures(fact, "id")))
    timed("marts", lambda: build_marts(spark, table, base=table, root=f"{place}/marts", seed=1))
    print(
        json.dumps(
            {
                "register_rows": loans.count() * copies,
                "loans": report.rows_loaded,
                "files": {
                    "raw": report.n_files,
                    "staging": count_files(spark, f"{place}/staging"),
                    "table": count_files(spark, f"{place}/table"),
                },
                "seconds": seconds,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
