"""Compare every query with its SQL twin: ``python -m verification.run [sf_dir] [names]``."""

from __future__ import annotations

import sys
import tempfile
import time

from pyspark.sql import SparkSession

from verification import oracle, queries
from verification.compare import connect, differences


def local_session(cpus: str = "8") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("stayledger-check")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "6g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stayledger-wh-"))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    runnable, statements = queries.runnable(), oracle.statements()
    failed = 0
    for name in sys.argv[2:] or runnable:
        started = time.perf_counter()
        try:
            if name in statements:
                found = differences(spark, runnable[name], statements[name], sf_dir, con)
                word = "differs" if found else "same"
            else:
                found, word = [], f"{runnable[name](spark, sf_dir).count()} rows, no twin"
        except Exception as e:  # noqa: BLE001
            found, word = [f"{type(e).__name__}: {str(e)[:500]}"], "failed"
        failed += bool(found)
        print(f"{name:24s} {time.perf_counter() - started:6.2f} s  {word}",
              *found, sep="\n    " if found else "", flush=True)
    print(f"{failed} of {len(sys.argv[2:] or runnable)} differ or fail")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
