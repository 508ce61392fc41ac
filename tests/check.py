"""Run registered queries against their SQL: python -m tests.check [sf_dir] [name ...]."""

import os
import sys
import time

from custoria.session import local_session
from tests.compare import connection, differences, type_notes

import __spark_entry__ as entry


def main(sf: str, names: list[str]) -> int:
    spark = local_session()
    queries, sqls = entry.queries(), entry.oracle_sql()
    con = connection(sf)
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in sqls:
                problem = differences(df, con, sqls[name])
                types = type_notes(df, con, sqls[name]) if os.environ.get("CHECK_TYPES") else ""
                note = f"same {types}"
            else:
                problem, note = None, f"rows {df.count()}"
        except Exception as error:  # report every query, whatever one does
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or note}", flush=True)
    print(f"{bad} of {len(names or queries)} fail")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) else 0)
