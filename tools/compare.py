"""python tools/compare.py SF_DIR NAME... : queries against their SQL in DuckDB, with times."""

import importlib
import sys
import time

import duckdb

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

from spanloom.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings sessions patient_alias recordings master_full segments segment_files csv_bi mix_targets".split()


def rounded(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, list):
        return tuple(map(rounded, v))
    if isinstance(v, dict):
        return tuple(rounded(x) for _, x in sorted(v.items()))
    if type(v).__module__.startswith("numpy"):
        return tuple(rounded(x) for x in v.tolist()) if getattr(v, "ndim", 0) else rounded(v.item())
    return v


def main() -> int:
    d, names = sys.argv[1], sys.argv[2:]
    entry = importlib.import_module("__spark_entry__")
    q, o = entry.queries(), entry.oracle_sql()
    names = [n for n in q if not names or any(n == x or x.endswith("*") and n.startswith(x[:-1]) for x in names)]
    spark = local_session("8")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    bad = 0
    for name in names:
        began = time.time()
        try:
            df = q[name](spark, d)
            columns = sorted(df.columns)
            table = df.select(columns).toArrow()
            took = time.time() - began
            line = f"{name}: {table.num_rows} rows {took:.1f} s"
            if name in o:
                began = time.time()
                want = con.sql(o[name]).to_arrow_table()
                line += f" (SQL {time.time() - began:.1f} s)"
                if sorted(want.column_names) != columns:
                    line += f" COLUMNS {columns} {sorted(want.column_names)}"
                    bad += 1
                else:
                    key = lambda r: tuple((x is not None, str(x)) for x in r)
                    rows = lambda t: sorted((tuple(rounded(v) for v in r) for r in zip(*[t[c].to_pylist() for c in columns])), key=key)  # noqa: E731, B905
                    a, b = rows(table), rows(want)
                    if a == b:
                        line += " equal"
                    else:
                        bad += 1
                        sa, sb = set(a), set(b)
                        line += f" DIFFERENT sql has {len(b)}; only spark {sorted(sa - sb, key=key)[:3]}; only sql {sorted(sb - sa, key=key)[:3]}"
            print(line, flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name}: FAILED {str(e)[:1500]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 100))
