"""Compare all queries with their SQL: ``python -m tests.check_all FOLDER [NAME ...]``."""

import sys
import time

from __spark_entry__ import oracle_sql, queries
from orderloom.session import local_session
from tests.compare import connect, difference


def main(folder: str, names: list[str]) -> int:
    spark, connection = local_session(), connect(folder)
    known, sql = queries(), oracle_sql()
    failed = 0
    for name in names or sorted(known):
        begun = time.time()
        try:
            wrong = difference(spark, connection, folder, known[name], sql[name])
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:300]}"
        failed += wrong is not None
        print(f"{name:32} {time.time() - begun:6.2f}s {'ok' if wrong is None else wrong}", flush=True)
    print("missing SQL:", sorted(set(known) - set(sql)), "failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
