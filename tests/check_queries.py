"""Run registered queries against their SQL twins: ``python tests/check_queries.py SF_DIR [key ...]``."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def main(sf_dir: str, keys: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in sorted(queries):
        if keys and not any(key.startswith(k) for k in keys):
            continue
        start = time.time()
        try:
            df = queries[key](spark, sf_dir)
            if key in oracles:
                problem = compare(df, con, oracles[key])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            text = "".join(traceback.format_exception_only(error)) + "".join(traceback.format_tb(error.__traceback__)[-2:])
            problem = text[:1500]
        mark = "ok " if problem is None else "BAD"
        bad += problem is not None
        print(f"{mark} {key:28s} {'S' if key in oracles else 'R'} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
