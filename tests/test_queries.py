"""Every registered query beside its SQL, on the smallest tables."""

from datetime import date

import duckdb
import pytest

from tarn import queries as core

SF = "/root/testdata/sf0.001"


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    shown = lambda v: f"{v + 0.0:.5f}" if isinstance(v, float) else str(v)
    return sorted(names), sorted(tuple(shown(r[k]) for k in order) for r in values)


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, name):
    df = core.QUERIES[name](spark, SF)
    found = rows(df.columns, df.collect())
    if name not in core.SQL:
        assert found[1]
        return
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in ("region", "nation", "supplier", "lineitem"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    made = db.execute(core.SQL[name])
    assert found == rows([c[0] for c in made.description], made.fetchall())
