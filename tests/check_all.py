"""Compares every query with its SQL: python tests/check_all.py [sf] [name..]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from emberline.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark, con = local_session(), oracle.connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = []
    for name in names:
        t = time.time()
        try:
            got = oracle.spark_rows(queries[name](spark, folder))
            spent = time.time() - t
            note = oracle.difference(got, oracle.duck_rows(con, sql[name])) if name in sql else f"no SQL, {len(got[1])} rows"
            bad = name in sql and note is not None
        except Exception as e:  # report and go on
            spent, note, bad = time.time() - t, f"{type(e).__name__}: {str(e)[:600]}", True
        if bad:
            failed.append(name)
        n = len(got[1]) if not bad else 0
        print(f"{'FAIL' if bad else 'ok  '} {name:28s} {spent:6.2f}s {n:7d} {note or ''}", flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
