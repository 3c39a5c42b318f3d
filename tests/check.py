"""Run queries against their SQL from the shell: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, difference  # noqa: E402
from tallyloom.session import build_session  # noqa: E402


def main() -> int:
    sf = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.001'}"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf), entry.oracle_sql(), 0
    for name in names:
        begin = time.time()
        try:
            df = entry.queries()[name](spark, sf)
            if name in sql:
                wrong = difference(df, con, sql[name])
                n = ""
            else:
                n, wrong = f"{df.count()} rows, no SQL", None
        except Exception as e:  # noqa: BLE001
            wrong, n = f"{type(e).__name__}: {str(e)[:900]}", ""
        bad += wrong is not None
        print(f"{'ok  ' if wrong is None else 'FAIL'} {name} {time.time() - begin:.2f}s {n} {wrong or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
