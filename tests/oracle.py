"""Compare registered queries with their SQL: `python tests/oracle.py [sf_dir] [name ...]`."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(rows):
    """Rows as sorted text, so that neither row order nor integer width counts."""
    def cell(value):
        if isinstance(value, bool) or value is None:
            return repr(value)
        if isinstance(value, float):
            return repr(value + 0.0)
        return repr(value)

    return sorted("|".join(cell(v) for v in row) for row in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when they agree."""
    columns = sorted(df.columns)
    got = normal(tuple(r) for r in df.select(*columns).collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return [f"columns {columns} against {sorted(names)}"]
    order = [names.index(c) for c in columns]
    want = normal(tuple(row[i] for i in order) for row in cursor.fetchall())
    if len(got) != len(want):
        return [f"{len(got)} rows against {len(want)}"] + got[:2] + want[:2]
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return [f"{len(wrong)} of {len(want)} rows differ"] + [str(x) for x in wrong[:3]] if wrong else []


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tallygrid.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session("oracle", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="tallygrid-oracle-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name in chosen:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else []
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1200]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
