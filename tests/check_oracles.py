"""Run registered queries next to their SQL twins: python tests/check_oracles.py [dir] [name ...]."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from earshot.plans.oracles import ORACLES  # noqa: E402
from earshot.plans.queries import QUERIES  # noqa: E402
from earshot.session import local_session  # noqa: E402


def connect(root: str):
    con = duckdb.connect()
    for file in sorted(os.listdir(root)):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{root}/{file}'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None when both give the same multiset of rows, else what differs."""
    names = sorted(df.columns)
    want = con.execute(sql)
    found_names = [d[0] for d in want.description]
    if sorted(found_names) != names:
        return f"columns {names} against {sorted(found_names)}"
    at = [found_names.index(n) for n in names]
    theirs = sorted((tuple(row[i] for i in at) for row in want.fetchall()), key=repr)
    ours = sorted((tuple(row) for row in df.select(*names).collect()), key=repr)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    return f"{len(wrong)} rows differ, such as {wrong[0]}" if wrong else None


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session("oracles", "8"), connect(root)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, root)
            if name in ORACLES:
                bad = difference(df, con, ORACLES[name])
                status = "equal" if bad is None else bad
            else:
                bad, status = None, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            bad = status = f"{type(error).__name__}: {str(error)[:600]}"
        if bad:
            failed.append(name)
        print(f"{name:26s} {time.time() - start:6.1f}s  {status}", flush=True)
    print("failed:", failed or "none")


if __name__ == "__main__":
    main()
