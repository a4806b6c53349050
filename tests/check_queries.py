"""``python tests/check_queries.py SF_DIR [name …]``: every query against its SQL, with times."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from edaphon.session import local_session  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    spark, connection, bad = local_session(8), connect(sf), 0
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf)
            problem = compare(frame, connection, sql[name]) if name in sql else None
            note = problem or ("ok" if name in sql else f"rows {frame.count()}")
        except Exception:  # noqa: BLE001 - report and go on with the next query
            problem = note = traceback.format_exc(limit=-3)[-1500:]
        bad += problem is not None
        print(f"{'BAD ' if problem else 'good'} {name:26s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} bad of {len(names or queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
