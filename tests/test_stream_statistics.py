import os

from pyspark.sql import functions as F

from recolib.operators import statistics as S
from recolib.streaming.online import rating_event_stream
from recolib.streaming.statistics import (KEYS, StatisticsJob, average_products, rate_more_products,
                                          rate_more_recently_products, totals)

SCHEMA = "event_id long, userId long, productId long, score double, timestamp long"
DAY = 86_400


def events(first, n):
    """Ratings of few products over a year; some without a score, some without a product."""
    return [(i, i % 7, None if i % 11 == 0 else i % 5, None if i % 13 == 0 or i % 5 == 4 else float(i % 6),
             (i * 37 % 365) * DAY) for i in range(first, first + n)]


def rows(df):
    return sorted(map(tuple, df.withColumn("_", F.lit(0)).collect()), key=str)


def views(current):
    return [rows(f(current)) for f in (rate_more_products, rate_more_recently_products,
                                       lambda c: average_products(c).select("productId", F.round("avg", 9)))]


def batch(ratings):
    known = ratings.where("productId is not null")
    return [rows(S.rate_more_products(known)), rows(S.rate_more_recently_products(known)),
            rows(S.average_products(known).select("productId", F.round("avg", 9)))]


def drop(spark, folder, part):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_equals_the_batch_after_restarts_late_rows_and_retries(spark, tmp_dir):
    src, base = f"{tmp_dir}/src", events(0, 60)
    parts = [events(100, 50), [], events(40, 30), events(300, 1), events(200, 40)]  # the third comes late
    stored = spark.createDataFrame(base, SCHEMA)
    so_far = list(base)
    for n, part in enumerate(parts):
        drop(spark, src, part)
        job = StatisticsJob(spark, f"{tmp_dir}/stats", stored, compact_every=2)  # each time as after a restart
        job.start(rating_event_stream(spark, src, max_files_per_trigger=1), f"{tmp_dir}/ckpt").awaitTermination()
        so_far += part
        assert views(job.current_totals()) == batch(spark.createDataFrame(so_far, SCHEMA)), n
    # a batch that is written again changes nothing
    before = rows(job.current_totals())
    last = max(int(d.split("=")[1]) for d in os.listdir(f"{tmp_dir}/stats/totals") if d.startswith("batch_id="))
    again = [tuple(r) for r in spark.read.parquet(f"{tmp_dir}/stats/totals/batch_id={last}").collect()]
    job.process_batch(spark.createDataFrame(again, "productId long, yearmonth string, n long, scored long, total double"), last)
    assert rows(job.current_totals()) == before
    assert os.path.isdir(f"{tmp_dir}/stats/compacted")


def test_a_batch_writes_only_what_it_changed(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    drop(spark, src, events(0, 200))
    job = StatisticsJob(spark, f"{tmp_dir}/stats")
    job.start(rating_event_stream(spark, src), f"{tmp_dir}/ckpt").awaitTermination()
    drop(spark, src, [(900, 1, 2, 5.0, 0)])
    job.start(rating_event_stream(spark, src), f"{tmp_dir}/ckpt").awaitTermination()
    written = sorted(os.listdir(f"{tmp_dir}/stats/totals"))
    assert spark.read.parquet(f"{tmp_dir}/stats/totals/{written[-1]}").select(*KEYS).collect() == [(2, "197001")]


def test_nothing_yet_and_no_stream(spark, tmp_dir):
    job = StatisticsJob(spark, f"{tmp_dir}/none")
    assert job.current_totals().count() == 0
    assert totals(spark.createDataFrame([], SCHEMA)).count() == 0


def test_replayed_streams_take_a_million_rows_a_batch(spark):
    from recolib.plans import catalog

    assert catalog._stream_files(spark.range(3_000)) == catalog.STREAM_FILES
    assert catalog._stream_files(spark.range(9_500_000)) == 10
