"""Run registered queries against their DuckDB oracles (as the correctness gate does).

usage: python tools/compare_oracle.py [sf_dir] [name ...]
env: ORACLE_JSON=<file> also writes the per-query results there;
     ORACLE_SESSION_TZ=<zone> runs Spark in that session time zone.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from laminar import checks, registry  # noqa: E402
from laminar.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(registry.QUERIES)
    extra = {"spark.ui.showConsoleProgress": "false"}
    if os.environ.get("ORACLE_SESSION_TZ"):  # results must not depend on the session zone
        extra["spark.sql.session.timeZone"] = os.environ["ORACLE_SESSION_TZ"]
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf=extra)
    con = checks.duckdb_connection(sf_dir)
    bad = 0
    results = {}
    for name in names:
        t0 = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            sql = registry.ORACLE.get(name)
            if sql is None:
                res = {"rows_only": df.count()}
            else:
                res = checks.compare(df, con, sql)
                bad += not (res["values_match"] and res["types_match"])
        except Exception as exc:  # report and go on
            res = {"error": repr(exc)[:600]}
            bad += 1
        res["sec"] = round(time.time() - t0, 2)
        results[name] = res
        print(name, json.dumps(res, default=str), flush=True)
    print("MISMATCHES", bad)
    if os.environ.get("ORACLE_JSON"):
        with open(os.environ["ORACLE_JSON"], "w") as fh:
            json.dump({"sf_dir": sf_dir, "mismatches": bad, "queries": results}, fh,
                      indent=1, default=str)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
