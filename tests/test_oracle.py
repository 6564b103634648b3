"""Every registered query with SQL gives the same columns, rows and values as DuckDB."""

import pytest

from compare import differences, duck
from creascope.plans.catalog import QUERIES
from creascope.plans.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "embedding_components", "image_embeddings",
    "image_table", "model_comparison", "model_importances",
    "run_rows", "batch_scores",
}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert differences(spark, con, FOLDER, QUERIES[name], ORACLE[name]) is None


def test_every_query_is_checked_somehow():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert not set(ORACLE) - set(QUERIES)
