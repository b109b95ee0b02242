"""Run registered queries against their SQL from the command line: python tests/run_oracles.py DIR [name...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences  # noqa: E402

from rowharbor.session import local_session  # noqa: E402

if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            problems = differences(df, con, oracles[name]) if name in oracles else [f"no SQL, {df.count()} rows"]
        except Exception as e:
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
            if names:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s", *problems, sep=" | ", flush=True)
    print("failures", bad)
