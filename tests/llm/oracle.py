"""Compare the pipeline operators' queries with DuckDB: ``python -m tests.llm.oracle [key ...]``."""

from __future__ import annotations

import sys
import time

from minewright.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, compare, duck, session


class Query:
    def __init__(self, key: str):
        self.build, self.oracle = QUERIES[key], ORACLE_SQL.get(key)

    def __call__(self, spark, folder):
        return self.build(spark, folder)


def main(keys):
    spark, con = session(), duck()
    for key in keys or QUERIES:
        started = time.time()
        try:
            ok, message = compare(spark, con, Query(key), SF)
        except Exception as error:  # report and go on with the next key
            ok, message = False, f"{type(error).__name__}: {str(error)[:3000]}"
        print(("ok  " if ok else "BAD ") + key + ": " + message, f"{time.time() - started:.1f}s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
