"""Benchmark the headline operators.

1. The reference-shaped inputs (customers, ledger, mapping) are derived from
   ``$BENCH_SF_DIR`` and stored as Parquet in the shared scratch folder; that
   step is timed once and reported as ``derive_inputs``.
2. Each headline operator then runs over the stored inputs, as a deployment
   reads its ledger table: one warm-up run, then three timed runs, median
   reported.  A run executes the whole plan into Spark's ``noop`` sink (no
   rows travel to the driver).

   deriving the inputs), the registered flagship query is also timed as the
   driver runs it, derivation included: ``tally_per_transaction_end_to_end``.
   It is reported but not part of ``value``.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.config import TallyOptions  # noqa: E402
from ledgerline.operators import activity, pairing, sequence, tally  # noqa: E402
from ledgerline.plans import jobs  # noqa: E402
from ledgerline.plans import catalog  # noqa: E402
from ledgerline.plans.catalog import FINE_SPAN  # noqa: E402
from ledgerline.plans.inputs import stored_inputs  # noqa: E402
from ledgerline.session import local_session, scratch_path  # noqa: E402
from ledgerline.sources import fixtures  # noqa: E402

RUNS = 3

HEADLINE = {
    "tally_per_transaction": lambda i: tally.tally_per_transaction(i.ledger, i.customers, i.mappings),
    "account_activity": lambda i: activity.account_activity(i.ledger, i.customers, i.mappings),
    "account_rollup": lambda i: jobs.per_account(i, TallyOptions(balance_mode="minmax")),
    "account_rollup_boundary": lambda i: jobs.per_account(i, TallyOptions(balance_mode="boundary")),
    "pair_next_credit": lambda i: pairing.with_next_credit(i.ledger),
    "pair_next_credit_bucketed": lambda i: pairing.with_next_credit(i.ledger, span=FINE_SPAN),
    "ledger_sequence": lambda i: sequence.dense_position(i.ledger.select("account_number", "seq")),
    "account_activity_shifted": lambda i: activity.account_activity_shifted(i.ledger, i.customers, i.mappings),
}


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cpus, shuffle_partitions=cpus * 2, app="ledgerline-bench")

    timings: dict[str, float] = {}
    # JVM and code-generation warm-up, so the first timed step is not charged for it.
    spark.range(0, 100_000).selectExpr("id % 97 k").groupBy("k").count().collect()
    t0 = time.perf_counter()
    paths = fixtures.materialize(spark, sf_dir, scratch_path(spark, "bench-inputs"))
    timings["derive_inputs"] = round(time.perf_counter() - t0, 3)
    inputs = stored_inputs(spark, paths)

    for name in names:
        plan = HEADLINE[name]
        timed(plan(inputs))
        timings[name] = round(statistics.median(timed(plan(inputs)) for _ in range(RUNS)), 3)
    if not sys.argv[1:]:
        flagship = catalog.queries()["tally_per_transaction"]
        timed(flagship(spark, sf_dir))
        timings["tally_per_transaction_end_to_end"] = round(
            statistics.median(timed(flagship(spark, sf_dir)) for _ in range(RUNS)), 3
        )
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    operators = {k: v for k, v in timings.items() if k in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "sum_of_median_operator_seconds",
                "value": round(sum(operators.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )


if __name__ == "__main__":
    main()
