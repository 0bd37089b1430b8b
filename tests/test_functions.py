from pyspark.sql import functions as F

from recolib.functions import columns as X
from recolib.sources import text


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_java_string_hash(spark):
    # the user of the one real sample log line is the hash of 'abc'
    assert one(spark, X.java_string_hash(F.lit("abc"))) == 96354
    assert one(spark, X.java_string_hash(F.lit(""))) == 0
    # wraps like a 32-bit int: "polygenelubricants".hashCode() == Integer.MIN_VALUE
    assert one(spark, X.java_string_hash(F.lit("polygenelubricants"))) == -2147483648


def test_year_month_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, X.year_month(F.lit(1556668799))) == "201904"  # 2019-04-30 23:59:59 UTC
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normalise_score(spark):
    assert one(spark, X.normalise_score(F.lit(9))) == 4.5
    assert one(spark, X.normalise_score(F.lit(10.0))) == 5.0


def test_redecode_roundtrip(spark):
    s = "héllo wörld ünïcode"
    assert one(spark, X.redecode(X.misdecode(F.lit(s)))) == s


def test_log_filter_edges(spark):
    lines = spark.createDataFrame(
        [("x INFO PRODUCT_RATING_PREFIX:96354|57272|5.0|1556436808",),
         ("no rating here",),
         ("PRODUCT_RATING_PREFIX: 1|2|3.5|10 PRODUCT_RATING_PREFIX:9|9|9|9",),
         ("tail PRODUCT_RATING_PREFIX:",),
         ("PRODUCT_RATING_PREFIX:1|2|x|10",),
         ("PRODUCT_RATING_PREFIX:1|2",)], "value string")
    rows = sorted(tuple(r) for r in text.log_filter_parse(lines).collect())
    # a second prefix ends the first payload; empty / short / non-numeric payloads drop
    assert rows == [(1, 2, 3.5, 10), (96354, 57272, 5.0, 1556436808)]
    payloads = [r[0] for r in text.filter_log(lines).collect()]
    assert "1|2|3.5|10" in payloads


def test_product_line_edges(spark):
    lines = spark.createDataFrame(
        [("1^ red bolt ^1057,439^0^ img/1.jpg ^SMALL^red|bolt|Brand#1|SMALL",),
         ("2^name^c^m^img^cat",),                 # 6 fields
         ("3^name^c^m^img^cat^",),                # empty tags
         ("x^name^c^m^img^cat^tags",)], "value string")
    out = {r["productId"]: r for r in text.parse_product_lines(lines).collect()}
    assert set(out) == {1, 3}
    assert out[1]["name"] == "red bolt" and out[1]["imageUrl"] == "img/1.jpg"
    assert out[3]["tags"] == ""
    bad = text.parse_product_lines(lines, keep_bad=True).where("_bad").count()
    assert bad == 2


def test_rating_line_edges(spark):
    lines = spark.createDataFrame([("4867,457976,5.0,1395676800",), ("1,2,3",), ("1,2,x,4",)], "value string")
    rows = [tuple(r) for r in text.parse_rating_lines(lines).collect()]
    assert rows == [(4867, 457976, 5.0, 1395676800)]


def test_recent_item_parse(spark):
    cols = X.parse_recent_item(F.lit("57272:4.5"))
    r = spark.range(1).select(cols["productId"].alias("p"), cols["score"].alias("s")).first()
    assert (r.p, r.s) == (57272, 4.5)


def test_trailing_separators_are_dropped(spark):
    words = {t: one(spark, X.tokenize(X.tag_words(F.lit(t)))) for t in ("a|b|", "a||b", "|a", "a|b||", "red bolt ", "")}
    assert words == {"a|b|": ["a", "b"], "a||b": ["a", "", "b"], "|a": ["", "a"], "a|b||": ["a", "b"],
                     "red bolt ": ["red", "bolt"], "": [""]}
    assert one(spark, X.tokenize(F.lit("  "))) == []
    from recolib.operators import content
    p = spark.createDataFrame([(1, "red|bolt|"), (2, "red|bolt"), (3, "x|y")], "productId long, tags string")
    score = {(r.productId, r.simProductId): r.score for r in content.content_pairs(p).collect()}
    assert abs(score[1, 2] - 1.0) < 1e-9


def test_redecode_of_ordinary_text(spark):
    assert one(spark, X.redecode(F.lit("café"))) == "caf�"
    assert one(spark, X.redecode(F.lit("手机 😀"))) == "?? ?"
    assert one(spark, X.redecode(F.lit("plain"))) == "plain"
    assert one(spark, X.redecode(X.misdecode(F.lit("手机😀")))) == "手机😀"


def test_string_hash_beyond_the_basic_plane(spark):
    assert one(spark, X.java_string_hash(F.lit("a😀"))) == 1866116


def test_large_ids_and_times_survive_every_parser(spark):
    big = 3_000_000_000
    lines = spark.createDataFrame([(f"{big},1,5.0,10",), ("1,1,5.0,4102444800",), ("1,2,3.0,10",)], "value string")
    assert sorted(tuple(r) for r in text.parse_rating_lines(lines).collect()) == [
        (1, 1, 5.0, 4102444800), (1, 2, 3.0, 10), (big, 1, 5.0, 10)]
    lines = spark.createDataFrame([(f"PRODUCT_RATING_PREFIX:{big}|{big + 1}|5.0|10",)], "value string")
    assert [tuple(r) for r in text.log_filter_parse(lines).collect()] == [(big, big + 1, 5.0, 10)]
    lines = spark.createDataFrame([(f"{big}^n^c^m^i^k^t",)], "value string")
    assert [r.productId for r in text.parse_product_lines(lines).collect()] == [big]
    assert one(spark, X.parse_recent_item(F.lit(f"{big}:4.5"))["productId"]) == big


def test_split_of_strided_ids(spark):
    from recolib.operators import als
    r = spark.range(0, 361 * 100, 100).selectExpr("id AS userId", "id * 7 AS productId", "1.0 AS score")
    train, test = als.train_test(r)
    assert 0.7 < train.count() / 361 < 0.9 and train.count() + test.count() == 361


def test_shared_folder_must_be_named_on_a_cluster():
    import pytest

    from recolib import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
