"""Side-by-side check of a registered query against its DuckDB SQL (used by tests and by
``python -m featuremill.plans.oracle``). DuckDB runs in-process; no server is involved."""

from __future__ import annotations

import math
import os
import sys
import time

from featuremill.plans import standins as S


def duckdb_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in S.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if STRICT else float(f"{v:.12g}") + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _family(t: str) -> str:
    t = t.lower()
    for k, fam in (("int", "int"), ("long", "int"), ("double", "float"), ("float", "float"),
                   ("decimal", "dec"), ("string", "str"), ("varchar", "str"), ("bool", "bool"),
                   ("date", "date"), ("timestamp", "ts")):
        if k in t:
            return fam
    return t


def compare(spark, con, key: str, sf_dir: str) -> dict:
    from featuremill.plans.catalog import all_queries
    q = all_queries()[key]
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
    t1 = time.time()
    out = {"key": key, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if q.sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.execute(q.sql())
    dcols = [d[0] for d in rel.description]
    dtypes = [str(d[1]) for d in rel.description]
    drows = rel.fetchall()
    out["duck_rows"] = len(drows)
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: spark-only {sorted(set(scols) - set(dcols))}, "
                        f"sql-only {sorted(set(dcols) - set(scols))}")
    else:
        sd = dict(zip(scols, stypes))
        dd = dict(zip(dcols, dtypes))
        tdiff = {c: (sd[c], dd[c]) for c in scols if _family(sd[c]) != _family(dd[c])}
        if tdiff:
            problems.append(f"types differ: {tdiff}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sset = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=repr)
        dset = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
        if sset != dset:
            extra_s = [r for r in sset if r not in set(dset)][:3]
            extra_d = [r for r in dset if r not in set(sset)][:3]
            problems.append(f"values differ; spark-only {extra_s}; sql-only {extra_d}; "
                            f"columns {order}")
    if len(srows) != len(drows):
        problems.append(f"row counts {len(srows)} vs {len(drows)}")
    out["status"] = "match" if not problems else "MISMATCH"
    if problems:
        out["problems"] = problems
    return out


def main(argv):
    from featuremill.plans.catalog import all_queries
    from featuremill.session import get_session
    sf_dir = "/root/testdata/sf0.01"
    keys = argv or list(all_queries())
    spark = get_session("local[8]", shuffle_partitions=8, driver_memory="16g")
    con = duckdb_views(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, sf_dir)
        except Exception as e:  # report and go on with the next key
            r = {"key": k, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:600]}"}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
