"""Command line: python tests/run_oracle.py [name ...] compares queries at sf0.01."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle

import __spark_entry__ as entry
from zephyrgrid.session import build_session


def main() -> None:
    directory = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession

        # A session nobody prepared: default settings and another time zone.
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "America/New_York")
                 .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    else:
        spark = build_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(directory)
    queries, sql = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:]
    names = [n for n in queries if not wanted or any(n == w or (w.endswith("*") and n.startswith(w[:-1])) for w in wanted)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            frame = queries[name](spark, directory)
            if name in sql:
                problems = oracle.compare(frame, con, sql[name])
            else:
                count = frame.count()
                problems = [] if count else ["no rows"]
        except Exception as error:  # report every query, then fail
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        kind = "sql " if name in sql else "rows"
        print(f"{'ok ' if not problems else 'BAD'} {kind} {time.time() - start:6.2f}s {name}", flush=True)
        for problem in problems:
            bad += 1
            print(f"      {problem[:900]}", flush=True)
    print(f"{len(names)} queries, {bad} problems", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
