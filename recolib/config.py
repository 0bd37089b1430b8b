"""Schemas, dataset names and the fixed values the results depend on."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
ITEM_CF_LIST_LEN = 10            # similar items kept per product (co-occurrence)
RECENT_RATINGS_K = 20            # recent ratings read per event ...
RECENT_RATINGS_INCLUSIVE = True  # ... with an inclusive range end, so 21 rows
CANDIDATES_PER_EVENT = 20        # similar unrated items scored per event
RECENT_QUEUE_CAP = 40            # recent-rating queue length per user
SIM_THRESHOLD = 0.4              # content lists and online scoring keep sim > 0.4
GOOD_RATING = 3.0                # a recent rating counts as good when > 3
HASH_BUCKETS = 800               # HashingTF width of the content features
ALS_RANK = 50
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.02
ALS_ALPHA = 0.02
# Factor blocks: part of the result (factors are seeded per block), so never taken from the cluster.
ALS_BLOCKS = 10
ALS_BLOCK_RATINGS = 4_000_000    # more blocks where one would hold more ratings than this
ALS_LIST_LEN = 50                # recommendations per user and per item
FACTOR_PARTS = 16                # parts of items by norm in the top-k search over factors
ALS_GRID_RANKS = (50, 100)
ALS_GRID_ALPHAS = (0.01, 0.02)
TRAIN_FRACTION = 0.8
LOG_PREFIX = "PRODUCT_RATING_PREFIX:"
PRODUCT_FIELD_SEP = "^"
TAG_SEP = "|"
MESSAGE_SEP = "|"
RECENT_ITEM_SEP = ":"
STREAM_TRIGGER = "20 seconds"

# Number of recent ratings read per event (the inclusive range end adds one).
RECENT_ROWS = RECENT_RATINGS_K + (1 if RECENT_RATINGS_INCLUSIVE else 0)

# ---------------------------------------------------------------------------
# Dataset names (one catalogue; the job-side names).
# ---------------------------------------------------------------------------
PRODUCT = "Product"
RATING = "Rating"
RATE_MORE_PRODUCTS = "RateMoreProducts"
RATE_MORE_RECENTLY_PRODUCTS = "RateMoreRecentlyProducts"
AVERAGE_PRODUCTS = "AverageProducts"
USER_TO_PRODUCT = "UserToProduct"
PRODUCT_TO_USER = "ProductToUser"
STREAM_RECS = "StreamRecs"
PRODUCT_RECS = "ProductRecs"
PRODUCT_CLASSES = "ProductClasses"
CLASS_MEMBERS = "ClassMembers"
ITEM_CF_PRODUCT_RECS = "ItemCFProductRecs"
PRODUCT_NAME_INDEX = "ProductNameIndex"

# ---------------------------------------------------------------------------
# Typed schemas.
# ---------------------------------------------------------------------------
RATING_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("productId", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

PRODUCT_SCHEMA = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

USER_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("username", T.StringType()),
])

RATING_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("userId", T.LongType()),
    T.StructField("productId", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

REC = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("score", T.DoubleType()),
])
REC_USER = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("score", T.DoubleType()),
])

ITEM_RECS_SCHEMA = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("recs", T.ArrayType(REC)),
])
USER_RECS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("recs", T.ArrayType(REC)),
])
ITEM_USERS_SCHEMA = T.StructType([
    T.StructField("productId", T.LongType()),
    T.StructField("recs", T.ArrayType(REC_USER)),
])
