"""The file count of a star source covers the monthly files of all its line items."""

from __future__ import annotations

import duckdb

from milepost.oracle import ORACLE
from milepost.registry import REPORTS
from tests.test_scale import write_star


def twin(folder, name):
    with duckdb.connect() as db:
        for table in ("lineitem", "orders", "customer", "supplier"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
        return db.execute(ORACLE[name]).fetchall()


def test_files_are_those_of_the_line_items(spark, tmp_path):
    source = write_star(spark, tmp_path, 3_000)
    found = [tuple(r) for r in REPORTS["q01_cantidad_archivos"](source).collect()]
    assert found == [("green", 1, "02", "02"), ("total", 2, "02", "02"), ("yellow", 1, "02", "02")]
    assert sorted(twin(tmp_path, "q01_cantidad_archivos")) == found
