"""Run every query beside its SQL: ``python tests/check_all.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
from tablemill.operators.staging import drop_scratch
from tablemill.session import build_session
from tests.oracle import compare, connect


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.queries())
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in chosen:
        began = time.time()
        try:
            result, sql = contract.queries()[name](spark, sf_dir), contract.oracle_sql().get(name)
            problem = compare(result, connection, sql) if sql else f"no SQL, {result.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - began:6.2f}s {name} {problem or ''}", flush=True)
    drop_scratch(spark)
    print(f"{len(chosen) - failed} of {len(chosen)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
