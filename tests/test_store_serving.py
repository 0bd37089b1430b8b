
from pyspark.sql import functions as F

from recolib.functions import columns as X
from recolib.operators import content, serving, statistics as S
from recolib.sources import store
from recolib.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL


def test_store_roundtrip_and_similarity_lookup(spark, tmp_dir):
    fx = Fixtures(spark, SF_SMALL)
    store.store_base_tables(fx.products, fx.ratings, tmp_dir)
    assert store.load_ratings(spark, tmp_dir).count() == fx.ratings.count()
    assert store.load_products(spark, tmp_dir).schema == store.C.PRODUCT_SCHEMA
    pairs = content.content_pairs(fx.products)
    store.save_result(content.content_lists(pairs), tmp_dir, store.C.PRODUCT_RECS)
    flat = store.load_similarity(spark, tmp_dir)
    assert flat.count() == pairs.count()
    m = store.similarity_map(flat).first()
    assert all(v > 0.4 for v in m.sims.values())


def test_upsert_by_key_replaces_whole_key(spark):
    old = spark.createDataFrame([(1, 10, 1.0), (1, 11, 2.0), (2, 10, 3.0)], "userId int, productId int, score double")
    new = spark.createDataFrame([(1, 12, 9.0)], "userId int, productId int, score double")
    got = sorted(tuple(r) for r in store.upsert_by_key(old, new, ["userId"]).collect())
    assert got == [(1, 12, 9.0), (2, 10, 3.0)]


def test_ms_to_seconds(spark):
    assert spark.range(1).select(X.ms_to_seconds(F.lit(1556436808123)).alias("s")).first().s == 1556436808


def test_enriched_missing_average_is_zero(spark):
    fx = Fixtures(spark, SF_SMALL)
    avg = S.average_products(fx.ratings.where("productId <> 5"))
    row = serving.product_info(fx.products, avg, [5]).first()
    assert row.productId == 5 and row.score == 0.0
    assert serving.product_info(fx.products, avg, [10 ** 8]).count() == 0   # unknown id: no row


def test_similar_products_ordered_keeps_rank(spark):
    fx = Fixtures(spark, SF_SMALL)
    from recolib.operators import itemcf
    recs = itemcf.item_cf_top(fx.ratings)
    q = spark.createDataFrame([(1,)], "productId int")
    out = serving.similar_products(recs, fx.products, S.average_products(fx.ratings), q, ordered=True)
    ranks = sorted(r["rank"] for r in out.collect())
    assert ranks == list(range(1, len(ranks) + 1))
    plain = serving.similar_products(recs, fx.products, S.average_products(fx.ratings), q)
    assert plain.count() == len(ranks)


def test_registered_views_are_the_tables(spark):
    fx = Fixtures(spark, SF_SMALL)
    store.register_views(spark, {"s16_ratings": fx.ratings, "s16_products": fx.products})
    got = spark.sql("SELECT p.productId, count(*) AS n FROM s16_ratings r JOIN s16_products p USING (productId) GROUP BY 1")
    want = fx.ratings.join(fx.products.select("productId"), "productId").groupBy("productId").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    store.register_views(spark, {"s16_ratings": fx.ratings.limit(0)})  # a view of the name is replaced
    assert spark.table("s16_ratings").count() == 0
