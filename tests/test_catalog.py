"""Every query of the catalog against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from docquery import catalog

DATA = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    neat = lambda v: round(v, 6) if isinstance(v, float) and not math.isnan(v) else v
    return sorted(tuple(str(neat(r[k])) for k in order) for r in rows), sorted(columns)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(spark, duck, name):
    frame = catalog.queries()[name](spark, DATA)
    got = plain(frame.collect(), frame.columns)
    cursor = duck.execute(catalog.expected_sql()[name])
    assert got == plain(cursor.fetchall(), [c[0] for c in cursor.description])
