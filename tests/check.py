"""Runs every registered query against its SQL: python -m tests.check [sf_dir] [name …]"""

import sys
import time

import __spark_entry__ as e
from tests.oracle import compare, connect
from tidegauge.session import engine_session


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or [n for n in e.queries() if n in e.oracle_sql()]
    spark = engine_session(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            df = e.queries()[name](spark, sf)
            found = compare(df, con, e.oracle_sql()[name])
            rows = df.count() if not name.startswith(("stream", "conv")) else "-"
        except Exception as error:  # noqa: BLE001
            found, rows = [f"{type(error).__name__}: {str(error)[:600]}"], "?"
        bad += bool(found)
        print("BAD" if found else "ok ", name, rows, f"{time.time() - begin:.2f}s", flush=True)
        for difference in found:
            print("   ", difference)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
