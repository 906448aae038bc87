"""Print the physical plans of the headline outputs (for review).

Usage: python tools/explain_plans.py [sf_dir] > docs/PLANS.md
Long expression lists are cut to keep the file readable.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def short(plan: str, width: int = 220) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        out.append(line if len(line) <= width else line[:width] + " …")
    return "\n".join(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.codegen.wholeStage", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from recordcheck.operators.evaluate import evaluate
    from recordcheck.plans.audit import Audit
    from recordcheck.plans.catalog_party import party_catalog
    from recordcheck.sources.fixtures import party

    src = party(spark, sf_dir)
    cat = party_catalog(src.columns)
    audit = Audit(src, keys=("k",))
    plans = {
        "evaluation (171 rules, one projection, no exchange)": evaluate(src, cat.rules, cat.fields),
        "executive summary (reads the materialized evaluation)": audit.summary(),
        "detail, global order (range partitioning with the row id as last key)": audit.detail(),
        "critical view (filter on stored counters, pushed to the parquet scan)": audit.critical(),
        "type totals (partial aggregation, one row per task)": audit.type_totals(),
        "top-10 fields (partial count per field, TakeOrderedAndProject)": audit.top_fields(),
        "field profile (states and code only; partial aggregation, lookup of the few example codes)": audit.profile(),
    }
    print("# Physical plans of the headline outputs\n")
    print(f"Generated by `tools/explain_plans.py` on `{sf_dir}`; expression lists cut at 220 characters.\n")
    for title, df in plans.items():
        df.count() if "materialized" in title else None
        print(f"## {title}\n\n```")
        print(short(df._jdf.queryExecution().executedPlan().toString()))
        print("```\n")
    audit.release()


if __name__ == "__main__":
    main()
