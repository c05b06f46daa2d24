"""Compare a Spark query with its SQL twin in DuckDB, whatever the order of the rows."""
from collections import Counter
from pathlib import Path

import duckdb


def run_sql(sf_dir, sql):
    with duckdb.connect() as connection:
        for path in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        result = connection.execute(sql)
        names = [column[0] for column in result.description]
        return names, [str(column[1]) for column in result.description], result.fetchall()


def by_name(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)
