"""Run a registered query and its SQL counterpart on the same tables and compare them."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type names for the types SQL results may have.
TYPES = {
    "BIGINT": "bigint",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "DOUBLE": "double",
    "INTEGER": "int",
    "TIMESTAMP": "timestamp_ntz",
    "VARCHAR": "string",
}


def expected(folder: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    import duckdb

    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
            )
        cursor = connection.execute(sql)
        names = [column[0] for column in cursor.description]
        types = [TYPES.get(str(column[1]), str(column[1])) for column in cursor.description]
        return dict(zip(names, types)), by_name(names, cursor.fetchall())


def by_name(names: list[str], rows) -> list[tuple]:
    """Rows with the columns in name order, in a repeatable row order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, folder: str, sql: str) -> str | None:
    """What differs, or None when schema and every value agree."""
    types, wanted = expected(folder, sql)
    if dict(df.dtypes) != types:
        return f"schema {sorted(dict(df.dtypes).items())} != {sorted(types.items())}"
    found = by_name(df.columns, df.collect())
    if found != wanted:
        only = sorted(set(found) - set(wanted), key=repr)[:2]
        lost = sorted(set(wanted) - set(found), key=repr)[:2]
        return f"{len(found)} rows, expected {len(wanted)}; extra {only}; missing {lost}"
    return None


def main(folder: str, names: list[str]) -> int:
    import time

    import __spark_entry__ as contract
    from civicspark.session import build_session

    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql, failures = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if name not in sql or names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(query(spark, folder), folder, sql[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failures} failed")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
