"""Run registered queries against their SQL: ``python -m tests.check_queries [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time

import __spark_entry__ as registry
from tests.conftest import local_session
from tests.oracle import assert_same, connect


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session()
    connection = connect(sf_dir)
    queries, oracles = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in names or queries:
        began = time.time()
        try:
            rows = assert_same(queries[name](spark, sf_dir), connection, oracles[name])
            print(f"ok    {name:30} {rows:8} rows {time.time() - began:6.2f} s", flush=True)
        except Exception as error:
            failed += 1
            print(f"WRONG {name:30} {type(error).__name__}: {str(error)[:600]}", flush=True)
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
