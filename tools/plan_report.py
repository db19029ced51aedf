"""Tabulate the physical plan shape of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query (write-based entries are skipped): number of file scans,
exchanges by kind, Window / Sort / aggregate nodes, whole-stage codegen
stages, and whether any Python evaluation appears.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from stratus.plans.inspect import explain_string, uses_python  # noqa: E402
from stratus.plans.registry import build_queries  # noqa: E402
from stratus.session import ensure_checkpoint_dir  # noqa: E402

WRITES = {"bronze_csv_roundtrip", "gold_parquet_roundtrip", "gold_idempotent", "full_pipeline"}


def shape(df) -> dict:
    plan = explain_string(df)
    tree = plan.split("\n\n")[0]
    kinds = []
    for m in re.finditer(r"\(\d+\) Exchange\nInput[^\n]*\nArguments: ([^\n]*)", plan):
        arg = m.group(1)
        if arg.startswith("hashpartitioning"):
            keys = re.findall(r"(\w+)#", arg.split(", REBALANCE")[0].split(", ENSURE")[0])
            tag = "rebalance" if "REBALANCE" in arg else ("repartition" if "REPARTITION" in arg else "hash")
            kinds.append(f"{tag}({','.join(keys)})")
        elif arg.startswith("rangepartitioning"):
            kinds.append("range(sort)")
        elif arg.startswith("SinglePartition"):
            kinds.append("single")
        else:
            kinds.append(arg.split("(")[0])
    return {
        "scans": len(re.findall(r"(?m)^\(\d+\) Scan ", plan)),
        "exchanges": kinds,
        "windows": len(re.findall(r"(?m)^\(\d+\) Window\b", plan)),
        "sorts": len(re.findall(r"(?m)^\(\d+\) Sort\b", plan)),
        "aggregates": len(re.findall(r"(?m)^\(\d+\) HashAggregate\b", plan)),
        "codegen": len(set(re.findall(r"\[codegen id : (\d+)\]", plan))),
        "python": uses_python(df),
        "tree_lines": len(tree.splitlines()),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             # static plans show whole-stage codegen ids; shapes are the same with AQE
             .config("spark.sql.adaptive.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    print("| query | scans | exchanges (what is shuffled) | windows | sorts | hash aggregates | codegen stages | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(build_queries().items()):
        if name in WRITES:
            continue
        s = shape(fn(spark, sf))
        print(f"| `{name}` | {s['scans']} | {', '.join(s['exchanges']) or '-'} | {s['windows']} | "
              f"{s['sorts']} | {s['aggregates']} | {s['codegen']} | {'yes' if s['python'] else 'no'} |")


if __name__ == "__main__":
    main()
