"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed; the result is written to the no-op sink,
so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.catalog import queries  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

HEADLINE = [
    "report_liquidity", "report_arap", "report_bank_limits", "report_debt", "report_treasury_debt",
    "report_derivatives", "report_correlation", "report_volatility", "report_triggers", "report_ratings",
    "recon_arap", "recon_treasury", "recon_orders", "entity_lookup_multikey", "fx_convert_by_date",
    "classify_rules", "maturity_bucket", "outer_reconcile", "quantile_thresholds", "latest_version",
    "share_of_total", "bond_netting", "subtotal_rollup", "corr_matrix", "column_profile", "qc_missing_new",
    "rolling_mean", "mirror_pairs", "filter_or_keys", "pivot_sum",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(registered[name](spark, folder))
        start = time.perf_counter()
        run(registered[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(folder)),
    }), flush=True)


if __name__ == "__main__":
    main()
