"""Compare all (or the named) queries with their oracle: python tests/run_oracle.py sf0.01 [names]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E
from ordertide.session import session
from tests.comparing import FAMILIES, TESTDATA, duck, rows_of

if __name__ == "__main__":
    folder = f"{TESTDATA}/{sys.argv[1]}"
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                          "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(folder), E.oracle_sql()
    names = sys.argv[2:] or list(E.queries())
    for name in names:
        start = time.time()
        df = E.queries()[name](spark, folder)
        got = rows_of(df.columns, df.collect())
        spent = time.time() - start
        if name not in oracle:
            print(f"{name:32s} rows {len(got)} (no oracle) {spent:.2f}s")
            continue
        cur = con.execute(oracle[name])
        cols = [d[0] for d in cur.description]
        want = rows_of(cols, cur.fetchall())
        kinds = {c: str(d[1]) for c, d in zip(cols, cur.description)}
        types = [(c, t, kinds.get(c)) for c, t in df.dtypes if FAMILIES.get(t) != kinds.get(c)]
        verdict = "ok" if got == want and sorted(cols) == sorted(df.columns) else "DIFFERENT"
        print(f"{name:32s} {verdict} rows {len(got)}/{len(want)} {spent:.2f}s {types or ''}", flush=True)
        if verdict != "ok":
            print(sorted(df.columns), sorted(cols))
            print([r for r in got if r not in set(want)][:3])
            print([r for r in want if r not in set(got)][:3])
