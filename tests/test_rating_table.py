import os

import pytest
from pyspark.sql import functions as F

from recolib.operators.ratings import upsert_ratings
from recolib.sources.rating_table import RatingTable

RATING = "userId long, productId long, score double, timestamp long"
EVENT = "event_id long, userId long, productId long, score double, timestamp long"


def rows(df):
    return sorted(map(tuple, df.select("userId", "productId", "score", "timestamp").collect()), key=str)


@pytest.fixture()
def base(spark):
    hot = [(1, i, 1.0, 10 + i) for i in range(300)]  # one user holds most rows
    return spark.createDataFrame(hot + [(u, i, 2.0, 5) for u in range(2, 40) for i in range(3)] + [(2, 0, 4.0, 3)], RATING)


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def test_a_batch_rewrites_its_buckets_only_and_a_retry_changes_nothing(spark, tmp_dir, base):
    table = RatingTable(spark, tmp_dir, 8)
    table.create(base)
    assert rows(table.read()) == rows(base)
    before, was = files(tmp_dir), table._state()[1]["buckets"]
    events = spark.createDataFrame([(1, 2, 0, 5.0, 50), (2, 2, 0, 3.0, 60), (3, 2, 99, 1.0, 70), (4, None, 7, 1.0, 1),
                                    (5, 2, None, 1.0, 1)], EVENT)
    assert table.apply(events, 0)
    want = rows(upsert_ratings(base, events.dropna()))
    assert rows(table.read()) == want and (2, 0, 3.0, 3) in want and (2, 99, 1.0, 70) in want
    now = table._state()[1]["buckets"]
    assert sum(now[b] != was[b] for b in was) == 1 and before <= files(tmp_dir)
    assert not table.apply(events, 0) and table._state()[1]["buckets"] == now
    later = spark.createDataFrame([(6, 2, 0, 1.5, 80)], EVENT)
    assert table.apply(later, 1) and not table.apply(events, 0)  # an old batch that comes again takes nothing back
    assert (2, 0, 1.5, 3) in rows(table.read([2])) and rows(table.read([2])) == [r for r in rows(table.read()) if r[0] == 2]


def test_empty_tables_and_batches_new_users_and_failures(spark, tmp_dir, base, monkeypatch):
    table = RatingTable(spark, tmp_dir, 8)
    table.create(base.limit(0))
    assert table.read().count() == 0
    none = spark.createDataFrame([], EVENT)
    assert table.apply(none, 0) and table.read().count() == 0
    one = spark.createDataFrame([(1, 77, 5, 4.0, 9)], EVENT)
    # a writer that dies before the pointer leaves the table as it was; the batch can be repeated
    monkeypatch.setattr(table, "_add_pointer", lambda *a: False)
    with pytest.raises(RuntimeError):
        table.apply(one, 1)
    monkeypatch.undo()
    assert table.read().count() == 0
    assert table.apply(one, 1) and rows(table.read()) == [(77, 5, 4.0, 9)]
    with pytest.raises(RuntimeError):
        table.create(base)


def test_batches_of_a_stream(spark, tmp_dir, base):
    table = RatingTable(spark, f"{tmp_dir}/table", 4)
    table.create(base)
    parts = [[(i, i % 9, i % 4, float(i % 5), 100 + i) for i in range(n * 20, n * 20 + 20)] for n in range(3)]
    events = spark.createDataFrame([e for p in parts for e in p], EVENT)
    for p in parts:
        spark.createDataFrame(p, EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
        q = (spark.readStream.schema(EVENT).parquet(f"{tmp_dir}/src").writeStream.foreachBatch(table.apply)
             .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
    assert rows(table.read()) == rows(upsert_ratings(base, events))
    assert table.read().select(F.count("*")).first()[0] == len(rows(table.read()))
