"""Catalogue queries vs their DuckDB oracle on sf0.001 (the driver does this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, norm_frame, value_hash
from tests.conftest import SF_SMALL

FAST = ["ratings_projection", "product_text_parse", "log_filter_parse", "user_id_hash", "charset_redecode",
        "rate_more_products", "rate_more_recently_products", "average_products", "hot_products",
        "most_rated_products", "product_search_regex", "item_cf_top10", "item_cf_list_sizes",
        "tfidf_weights", "content_pairs", "similarity_flatten", "recent_ratings_k", "online_candidates",
        "online_recs", "online_recs_asof", "rating_upsert", "factor_topk", "rmse_eval", "recs_to_products",
        "content_recs_to_products", "recs_ranked_products", "stream_recs_lookup", "stored_hot_products", "stored_product_by_id",
        "stored_recs_to_products", "stored_content_recs_to_products", "stored_offline_recs_lookup",
        "hashed_tfidf", "als_user_lists_check", "als_item_lists_check", "als_predictions"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_oracles_are_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert value_hash(norm_frame(sp)) == value_hash(norm_frame(dk))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["productId", "rank", "simProductId", "score"]
    assert df.count() > 0


def test_queries_without_the_training_data_package_or_its_libraries(monkeypatch):
    """A hidden dependency of the optional subpackage leaves the recommender's queries."""
    import sys

    import __spark_entry__ as entry
    from recolib.plans.catalog import QUERIES
    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("recolib.llm")]:
        monkeypatch.delitem(sys.modules, name)
    for hidden in ("corpus_pipeline", "ahocorasick"):
        with monkeypatch.context() as m:
            m.setitem(sys.modules, hidden, None)
            assert set(entry.queries()) == set(QUERIES)
            assert set(entry.oracle_sql()) < set(QUERIES)
        for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("recolib.llm")]:
            monkeypatch.delitem(sys.modules, name)
