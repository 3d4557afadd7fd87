"""Runs one registered query as the first of its process and says how its rows differ from its SQL.

Arguments: the query and the folder of the tables. Not a test by itself; ``test_first_query`` starts it.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from compare import connect, spark_rows, sql_rows  # noqa: E402
from spendlake.session import local_session  # noqa: E402

if __name__ == "__main__":
    name, folder = sys.argv[1:]
    found = spark_rows(entry_module.queries()[name](local_session("2", name, shuffle_partitions=2), folder))
    wanted = sql_rows(connect(folder), entry_module.oracle_sql()[name])
    if found != wanted:
        print(f"{name}: {found[0]} against {wanted[0]}")
        print("not wanted", list((found[1] - wanted[1]).items())[:3])
        print("missing", list((wanted[1] - found[1]).items())[:3])
        sys.exit(1)
