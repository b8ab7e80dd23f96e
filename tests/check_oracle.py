"""Compare every registered query with its SQL oracle at one scale, by hand.

    python tests/check_oracle.py /root/testdata/sf0.01 [query ...]

Prints one line per query: OK / BAD (with the first differing rows) / rows-only.
"""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402
from quarry.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in names or list(qs):
        t = time.time()
        df = qs[name](spark, sf_dir)
        if name not in oracle:
            print(f"{name}: rows-only {df.count()} {time.time() - t:.1f}s", flush=True)
            continue
        r = compare(df, con, oracle[name])
        ok = r["cols"] and r["values"]
        failures += not ok
        extra = "" if ok else f" names={r['col_names']} diff={r['diff']}"
        print(f"{name}: {'OK ' if ok else 'BAD'} rows={r['rows']} {time.time() - t:.1f}s{extra}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
