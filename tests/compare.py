"""Compare every registered query with its SQL text in DuckDB.

    python -m tests.compare [folder] [query ...]
"""

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
# Spark type -> the DuckDB types that count as equal.
SAME_TYPE = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
    "boolean": {"BOOLEAN"},
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sortable(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(round(value, 9) + 0.0))
    return (1, str(value))


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_sortable(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    """List of what differs; empty if the results are equal."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE ({sql})").fetchall()}
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if types[field.name] not in SAME_TYPE.get(kind, {kind}):
            found.append(f"type of {field.name}: {kind} != {types[field.name]}")
    rows = [tuple(r) for r in df.collect()]
    if len(rows) != len(expected):
        return [*found, f"rows {len(rows)} != {len(expected)}"]
    left, right = normal(rows, df.columns), normal(expected, names)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        found.append(f"{len(bad)} rows differ, first {bad[0]}")
    return found


def main(sf_dir="/root/testdata/sf0.01", *only):
    import __spark_entry__ as entry
    from delaykit.session import build_session

    spark = build_session(
        "compare", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}, master="local[8]"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                found = differences(df, con, oracles[name])
                what = "; ".join(found) if found else f"equal ({df.count()} rows)"
            else:
                found, what = [], f"rows only ({df.count()} rows)"
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:300]}"]
            what = found[0]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {time.time() - start:6.2f}s {name}: {what}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
