import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["user_id", "bin", "purchase", "view", "click", "error", "signup", "split"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 60


def _norm(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


def _key(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


@pytest.mark.parametrize("name", ["prep_pipeline", "impute_provenance", "metrics_by_model", "describe",
                                  "fe_clustered_se", "knn_exact", "walk_forward_folds", "kde_grid",
                                  "indicator_manifest_merge", "model_save_load", "hausman", "persistence"])
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(sdf.columns)
    a = sorted((tuple(_norm(r[c]) for c in order) for r in sdf.collect()), key=_key)
    drows = res.fetchall()
    b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows), key=_key)
    assert a == b
