"""Sparse Gram products: for items i < j that share a group g,

    G(i, j) = sum over g of w(g, i) * w(g, j)

Item-to-item co-occurrence (group = user, w = rating rows) and cosine numerators
(group = term, w = tf-idf) are both this product. ``gram_pairs`` sums it item by item and
shuffles no pairs; where pairs are asked for themselves it is an equi self-join on the group.
Two things keep that distributed:

* Only i < j is produced (half the matrix); callers mirror when they need both.
* A group holding more than ``block`` items (a heavy user, a common term) is cut
  into ceil(d / block) hash buckets of its items, and the self-join key becomes
  (group, bucket_i, bucket_j). Each bucket pair is its own join key, so no task
  ever holds more than about block^2 pairs of one group, however large the group.
  Groups under the limit keep one bucket and are not replicated at all.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from recolib.session import stored

DEFAULT_BLOCK = 512
PAIRS_A_TASK = 1 << 23  # pairs that one task of a group join forms, about
PAIRS_A_SUM = 1 << 21  # pairs that one task sums up in memory, about
PAIRS_AN_ITEM = 1 << 20  # pairs of one item that one task sums up, about
PAIRS_A_ROUND = 1 << 28  # pairs whose lists lie on the disks at a time where a caller goes by rounds, about


def meeting_pairs(base: DataFrame, group: str, item: str, carry: tuple[str, ...] = (),
                  block: int = DEFAULT_BLOCK) -> DataFrame:
    """Every pair of different items of a group, once per group: (group, i, j, <carry>_1, <carry>_2) with i < j.

    ``base`` holds one row per (group, item); ``carry`` names columns of it that come along.
    """
    rows = base.select(F.col(group).alias("_g"), F.col(item).alias("_i"), *[F.col(c) for c in carry])

    # Items per group -> bucket count. The size table is a (partial) aggregate,
    # joined back on the group; AQE splits a skewed group on the probe side.
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_d"))
    nb = F.greatest(F.lit(1), F.ceil(F.col("_d") / F.lit(block))).cast("int")
    sized = rows.join(sizes, "_g").withColumn("_nb", nb) \
        .withColumn("_b", F.when(F.col("_nb") > 1, F.pmod(F.xxhash64("_i"), F.col("_nb")))
                    .otherwise(F.lit(0)).cast("int"))

    # bucket pairs with b1 <= b2 only: each unordered pair of items meets once
    left = sized.select("_g", F.col("_b").alias("_b1"), F.explode(F.sequence(F.col("_b"), F.col("_nb") - 1)).alias("_b2"),
                        F.col("_i").alias("i"), *[F.col(c).alias(f"{c}_1") for c in carry])
    right = sized.select("_g", F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_b1"), F.col("_b").alias("_b2"),
                         F.col("_i").alias("j"), *[F.col(c).alias(f"{c}_2") for c in carry])

    # The join multiplies rows (about d^2/2 per group), so its input size says
    # nothing about its output: the partition count follows the pairs instead of
    # letting AQE coalesce a small input into a few tasks that then emit most of them.
    n = join_partitions(sizes, F.col("_d") * F.col("_d") / 2)
    keys3 = ["_g", "_b1", "_b2"]
    joined = (left.repartition(n, *keys3).join(right.repartition(n, *keys3), keys3)
              .where((F.col("i") < F.col("j")) | ((F.col("_b1") < F.col("_b2")) & (F.col("i") > F.col("j")))))
    up = F.col("i") < F.col("j")
    swapped = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(a)
               for c in carry for a, b in ((f"{c}_1", f"{c}_2"), (f"{c}_2", f"{c}_1"))]
    return joined.select(F.col("_g").alias(group), F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), *swapped)


def gram_pairs(entries: DataFrame, group: str, item: str, weight: str | None = None,
               carry: tuple[str, ...] = (), block: int = DEFAULT_BLOCK,
               out_weight: str = "g", half: bool = True, item_pairs: int = PAIRS_AN_ITEM) -> DataFrame:
    """Gram product of a sparse (group x item) matrix: (i, j, <carry>_1, <carry>_2, g) with i < j, or with ``half=False``
    in both orientations.

    ``entries`` must hold one row per (group, item); ``weight`` defaults to 1. ``carry`` names per-item columns (e.g. a
    norm or a count) that come along and become part of the pair key.

    No pair is shuffled. An item's rows travel with the lists of the items they meet, as packed arrays of the smallest
    integer types, to the item's partition; pairs are formed and summed there, about ``PAIRS_A_SUM`` a task, so the sums
    stay in memory. A group of more than ``block`` items travels in pieces, and an item of more than ``item_pairs`` pairs
    is cut by the hash of its partners, so neither a hot group nor a hot item is one task's.
    """
    return gram_rounds(entries, group, item, weight, carry, block, out_weight, half, item_pairs, None)[0]


def gram_rounds(entries: DataFrame, group: str, item: str, weight: str | None = None,
                carry: tuple[str, ...] = (), block: int = DEFAULT_BLOCK, out_weight: str = "g", half: bool = True,
                item_pairs: int = PAIRS_AN_ITEM, round_pairs: int | None = PAIRS_A_ROUND) -> list[DataFrame]:
    """:func:`gram_pairs` as tables of about ``round_pairs`` pairs that hold the pairs of different items i each. A caller
    that reduces and stores one before it runs the next has the lists of one round on the disks, not of all."""
    w = F.col(weight) if weight else F.lit(1)
    rows = entries.where(F.col(item).isNotNull()).select(F.col(group).alias("_g"), F.col(item).alias("_i"), w.alias("_w"), *carry)
    types = dict(rows.dtypes)
    rows = narrowed(rows, ["_i", "_w", *carry])
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_d"))
    nb = F.ceil(F.col("_d") / F.lit(block)).cast("int")
    sized = rows.join(sizes.withColumn("_nb", nb), "_g").withColumn("_b", F.pmod(F.xxhash64("_i"), F.col("_nb")).cast("int"))
    cuts = sized.groupBy("_i").agg(F.ceil(F.sum("_d") / F.lit(item_pairs)).cast("int").alias("_nc"))

    total = pair_total(sizes, F.col("_d") * F.col("_d") / (2 if half else 1))
    rounds = max(1, math.ceil(total / round_pairs)) if round_pairs else 1
    # the items of each group, or piece of a group, written once for all rounds
    pieces = (sized.join(cuts, "_i").groupBy("_g", "_b", "_nb").agg(F.collect_list(F.struct("_i", "_w", *carry, "_nc")).alias("_met"))
              .repartition(task_count(sizes, total), "_g", "_b"))
    pieces = stored(pieces, "pieces")
    one, more = pieces.where("_nb = 1"), pieces.where("_nb > 1")
    every = F.sequence(F.lit(0), F.col("_nb") - 1)
    asked = more.select("_g", F.col("_b").alias("_b2"), F.explode(every).alias("_b1"), "_met")
    asking = more.select("_g", F.col("_b").alias("_b1"), F.explode(every).alias("_b2"), F.col("_met").alias("_own"))
    met = one.select(F.col("_met").alias("_own"), "_met").unionByName(
        asking.join(asked, ["_g", "_b1", "_b2"]).select("_own", "_met"))
    return [_gram_sums(met, carry, out_weight, half, types, task_count(sizes, total / rounds, PAIRS_A_SUM), r, rounds)
            for r in range(rounds)]


def _gram_sums(met: DataFrame, carry: tuple[str, ...], out_weight: str, half: bool, types: dict[str, str], tasks: int,
               this: int, rounds: int) -> DataFrame:
    """The sums of round ``this`` over (_own, _met): each item of _own meets all of _met."""
    own = F.col("_own")
    if rounds > 1:
        own = F.filter(own, lambda x: F.pmod(F.xxhash64(F.lit(rounds), x["_i"]), F.lit(rounds)) == this)
    met = met.select(F.explode(own).alias("_x"), "_met").select("_x.*", "_met")
    met = met.withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_nc") - 1)))
    whole = F.when(F.col("_nc") == 1, F.lit(True))

    def kept(x: F.Column) -> F.Column:
        other = x["_i"] > F.col("_i") if half else x["_i"] != F.col("_i")
        return other & whole.otherwise(F.pmod(F.xxhash64(x["_i"]), F.col("_nc")) == F.col("_c"))

    met = met.withColumn("_met", F.filter("_met", kept)).where(F.size("_met") > 0)
    sides = [F.col(c).alias(f"{c}_1") for c in ("_w", *carry)]
    packed = [F.col(f"_met.{c}").alias(f"{c}_2") for c in ("_w", *carry)]
    dealt = met.select(F.col("_i").alias("i"), "_c", *sides, F.col("_met._i").alias("j"), *packed).repartition(tasks, "i", "_c")
    lists = ["j", *[f"{c}_2" for c in ("_w", *carry)]]
    ones = [f"{c}_1" for c in ("_w", *carry)]
    flat = dealt.select("i", "_c", *ones, F.inline(F.arrays_zip(*lists)))
    sides = [*[f"{c}_1" for c in carry], *[f"{c}_2" for c in carry]]
    # the partition's keys are among the sum's, so the sum needs no shuffle
    product = F.col("_w_1").cast(types["_w"]) * F.col("_w_2").cast(types["_w"])
    sums = flat.groupBy("i", "_c", "j", *sides).agg(F.sum(product).alias(out_weight))
    return sums.select(*[F.col(c).cast(types["_i"]).alias(c) for c in ("i", "j")],
                       *[F.col(c).cast(types[c[:-2]]).alias(c) for c in sides], out_weight)


def narrowed(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the integers among ``columns`` in the smallest type that holds their values; costs one aggregate."""
    whole = [c for c in columns if dict(df.dtypes)[c] in ("bigint", "int")]
    if not whole:
        return df
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in whole for f in (F.min, F.max)]).first()
    for c in whole:
        low, high = ends[f"min_{c}"], ends[f"max_{c}"]
        for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31)):
            if low is not None and -1 << bits <= low and high < 1 << bits:
                df = df.withColumn(c, F.col(c).cast(name))
                break
    return df


def gram_rows_for(entries: DataFrame, items: DataFrame, group: str, item: str, weight: str,
                  carry: tuple[str, ...] = (), block: int = 4 * DEFAULT_BLOCK, out_weight: str = "g") -> DataFrame:
    """Rows of the Gram product for the given items only: (i, j, <carry>_1, <carry>_2, _in, g) for i in ``items``
    and every other j that shares a group; ``_in`` tells whether j is in ``items`` too.

    Work is linear in the items' own entries. A group of more than ``block`` entries, or of more than ``block`` asked
    ones, is cut into hash buckets on that side, and every bucket of one side meets every bucket of the other, so one
    hot group runs on many tasks whether few or all items are asked for.
    """
    q = items.select(F.col(item).alias("_q")).distinct()
    base = (entries.join(q, entries[item] == q["_q"], "left")
            .select(F.col(group).alias("_g"), F.col(item).alias("_i"), F.col(weight).alias("_w"), *carry,
                    F.col("_q").isNotNull().alias("_in")))
    sizes = base.groupBy("_g").agg(F.count(F.lit(1)).alias("_d"), F.count_if("_in").alias("_a")).where("_a > 0")
    buckets = [F.ceil(F.col(c) / F.lit(block)).cast("int").alias(n) for c, n in (("_d", "_nb"), ("_a", "_na"))]
    sized = base.join(sizes.select("_g", *buckets), "_g")
    own, asked = (F.pmod(F.xxhash64("_i"), F.col(n)).cast("int") for n in ("_nb", "_na"))
    left = sized.where("_in").select("_g", asked.alias("_c"), F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("_b"),
                                     F.col("_i").alias("i"), F.col("_w").alias("_w1"),
                                     *[F.col(c).alias(f"{c}_1") for c in carry])
    right = sized.select("_g", F.explode(F.sequence(F.lit(0), F.col("_na") - 1)).alias("_c"), own.alias("_b"),
                         F.col("_i").alias("j"), F.col("_w").alias("_w2"),
                         *[F.col(c).alias(f"{c}_2") for c in carry], "_in")
    n = join_partitions(sizes, F.col("_a") * F.col("_d"))
    keys3 = ["_g", "_c", "_b"]
    joined = (left.repartition(n, *keys3).join(right.repartition(n, *keys3), keys3)
              .where(F.col("i") != F.col("j")))
    keys = ["i", "j", *[f"{c}_1" for c in carry], *[f"{c}_2" for c in carry], "_in"]
    return joined.groupBy(*keys).agg(F.sum(F.col("_w1") * F.col("_w2")).alias(out_weight))


def pair_total(sizes: DataFrame, pairs: F.Column) -> float:
    """The pairs that the groups of ``sizes`` form. Costs one aggregate over the groups."""
    return sizes.agg(F.sum(pairs.cast("double"))).first()[0] or 0.0


def task_count(sizes: DataFrame, total: float, a_task: int = PAIRS_A_TASK) -> int:
    """Tasks for ``total`` pairs: one per ``a_task``, at least the session's shuffle partitions."""
    least = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, math.ceil(total / a_task))


def join_partitions(sizes: DataFrame, pairs: F.Column, a_task: int = PAIRS_A_TASK) -> int:
    """Partitions of an exploding join: one per ``a_task`` of the pairs that the groups of ``sizes`` form, at
    least the session's shuffle partitions. Costs one aggregate over the groups."""
    return task_count(sizes, pair_total(sizes, pairs), a_task)


def mirror(pairs: DataFrame, a: str, b: str, suffixed: tuple[str, ...] = ()) -> DataFrame:
    """Both orientations of an upper-triangle pair table: (a, b) and (b, a);
    ``suffixed`` columns swap their ``_1`` / ``_2`` versions.

    One pass: each row becomes a two-element array that is inlined, so the
    (expensive) pair table is computed once and never unioned with itself.
    """
    cols = pairs.columns
    swap = {a: b, b: a}
    for c in suffixed:
        swap[f"{c}_1"] = f"{c}_2"
        swap[f"{c}_2"] = f"{c}_1"
    fwd = F.struct(*[F.col(c).alias(c) for c in cols])
    rev = F.struct(*[F.col(swap.get(c, c)).alias(c) for c in cols])
    return pairs.select(F.inline(F.array(fwd, rev)))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a reused intermediate in the session's checkpoint folder
    (``spark.checkpoint.dir``, shared storage on a cluster) and cut its lineage,
    so later branches scan it instead of recomputing it and a lost executor does
    not force a recomputation from the source tables."""
    from recolib.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
