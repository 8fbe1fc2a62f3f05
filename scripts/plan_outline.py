"""Print a compact physical-plan outline (operators, exchanges, pushed filters) for registered queries.

Usage: python scripts/plan_outline.py <sf_dir> name [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def outline(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        if "Scan parquet" in line:
            m = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            rs = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            head = line.split("Scan parquet")[0] + "Scan parquet " + line.split("Scan parquet")[1].split("[")[0].strip()
            line = head + (f" PushedFilters={m.group(1)[:90]}" if m else "") + (f" ReadSchema={rs.group(1)[:90]}" if rs else "")
        out.append(line[:170])
    return "\n".join(out)


def main() -> None:
    from pyspark.sql import SparkSession
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from orelake.catalog import QUERIES
    for name in names:
        print(f"### {name}\n```")
        print(outline(QUERIES[name](spark, sf_dir)))
        print("```\n")


if __name__ == "__main__":
    main()
