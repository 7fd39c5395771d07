"""Command line: ``python tests/check_all.py <folder> [key ...]`` compares queries with their SQL."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from couponlens.session import local_session  # noqa: E402


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = oracle.connect(folder), entry.oracle_sql(), 0
    for key, query in entry.queries().items():
        if wanted and key not in wanted:
            continue
        began = time.time()
        try:
            problem = oracle.difference(query(spark, folder), con, sqls[key])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if wanted:
                traceback.print_exc()
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {key} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
