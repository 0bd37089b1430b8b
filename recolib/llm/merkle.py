"""Merkle dataset manifest (operator 12): checkpoint-and-recompute proofs over one hash tree per source and a tree of
their roots.

1. Leaves (digest only, no text) are written, dealt into ranges of (tree, doc_id, digest), and numbered: a leaf's place
   in its range, and the number of leaves of its tree in earlier ranges, make its index. No task orders a whole tree.
2. Only every second level is kept. A kept level is a table of aligned subtrees, one row per ``FANOUT`` ** 2 nodes with
   their digests; the level between is hashed in passing and forgotten. Trees of all sources grow in the same jobs, and
   the number of jobs is half their height.
3. Proofs go down from the roots: a row joins the one proof of its subtree's root, hashes the missing level again from
   its stored nodes, emits each node's siblings on both levels, and lets the rest go. A join carries one proof for
   ``FANOUT`` ** 2 nodes; proofs of single documents exist only in the row being written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolib.llm.common import id_remainder, let, stored

FANOUT = 16
SPAN = FANOUT * FANOUT  # nodes of a stored subtree
TAMPER_MOD = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PROOF = "array<struct<left:string,right:string>>"  # bottom up; the digests before and after a node in its run


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def _hash(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (``tree`` and others, all columns named ``tree`` or in ``order`` or payload) with ``idx``, the position
    in the tree by ``order``, and ``n``, the tree's size. Rows equal in all of ``order`` take any order."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    # after the sort the generated number is the range's number and the row's place in it
    placed = stored(tied.repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie")
                    .drop("tie").withColumn("place", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("place", 33)), name)
    runs = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    tree = Window.partitionBy("tree")  # one row per range that the tree reaches into
    earlier = F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.select("tree", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"),
                          F.sum("size").over(tree).alias("n"))
    return (placed.join(offsets, ["tree", "part"])
            .select(*rows.columns, (F.col("place") + F.col("shift")).alias("idx"), "n"))


def _subtrees(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One row per aligned subtree: its nodes in order, at most ``SPAN`` of them."""
    node = F.struct((F.col("idx") % SPAN).cast("int").alias("at"), "digest", *payload)
    up = F.floor(F.col("idx") / SPAN).alias("up")
    return nodes.groupBy("tree", "n", up).agg(F.sort_array(F.collect_list(node)).alias("nodes"))


def _between(digests: Column) -> Column:
    """Digests of the level above, which is not kept."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda r: _hash(F.slice(digests, r * FANOUT + 1, FANOUT)))


def _root_of(digests: Column, n: Column) -> Column:
    """A subtree's root. A tree that has one node left at a level is finished there."""
    def above(mid: Column) -> Column:
        return F.when(n <= FANOUT, F.get(mid, F.lit(0))).otherwise(_hash(mid))

    return F.when(n == 1, F.get(digests, F.lit(0))).otherwise(let(_between(digests), above))


def grow(rows: DataFrame, payload: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The kept levels of all trees of ``rows`` (tree, idx, n, digest, payload), lowest first, and the roots (tree,
    digest), one per tree."""
    levels = [stored(_subtrees(rows, payload), f"{name}-0")]
    while True:
        roots = levels[-1].withColumn("digest", _root_of(F.col("nodes.digest"), F.col("n")))
        nodes = roots.select("tree", F.col("up").alias("idx"), F.ceil(F.col("n") / SPAN).alias("n"), "digest")
        if (levels[-1].agg(F.max("n")).first()[0] or 0) <= SPAN:
            return levels, stored(nodes.select("tree", "digest"), f"{name}-roots")
        levels.append(stored(_subtrees(nodes, []), f"{name}-{len(levels)}"))


def _own_proof(digests: Column, mid: Column, at: Column, n: Column) -> Column:
    def step(nodes: Column, at: Column) -> Column:
        run = F.slice(nodes, F.floor(at / FANOUT).cast("int") * FANOUT + 1, FANOUT)
        k = at % FANOUT
        return F.array(F.struct(F.array_join(F.slice(run, F.lit(1), k), "").alias("left"),
                                F.array_join(F.slice(run, k + 2, FANOUT), "").alias("right")))

    none = F.array().cast(PROOF)
    return F.concat(F.when(n > 1, step(digests, at)).otherwise(none),
                    F.when(n > FANOUT, step(mid, F.floor(at / FANOUT).cast("int"))).otherwise(none))


def _descend(level: DataFrame, above: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, idx, payload, proof) of every node of a kept level; ``above`` has (tree, idx, proof) of subtree roots."""
    joined = level.join(above.withColumnRenamed("idx", "up"), ["tree", "up"])

    def proofs(digests: Column) -> Column:
        return let(_between(digests), lambda mid: F.transform("nodes", lambda x: F.struct(
            (F.col("up") * SPAN + x["at"]).alias("idx"), *[x[c].alias(c) for c in payload],
            F.concat(_own_proof(digests, mid, x["at"], F.col("n")), F.col("proof")).alias("proof"))))

    return joined.select("tree", F.inline(let(F.col("nodes.digest"), proofs)))


def proofs(levels: list[DataFrame], above: DataFrame, payload: list[str], name: str) -> DataFrame:
    """Proofs of all lowest nodes; ``above`` has (tree, proof) of each tree's root."""
    at_root = above.select("tree", F.lit(0).cast("long").alias("idx"), "proof")
    for k in range(len(levels) - 1, 0, -1):
        at_root = stored(_descend(levels[k], at_root, []), f"{name}-proofs-{k}")
    return _descend(levels[0], at_root, payload)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, ``proof`` (an array of the digests left and right of the
    path, bottom up) and ``changed``, the leaf after the tampering of this audit (null where nothing is tampered with).

    A source's leaves ascend by doc_id, null first, rows of one id by leaf; sources ascend by UTF-8 bytes, null first
    and apart from the empty one. A null field is ``-``; a null id is not tampered with, and tampering keeps null texts.
    Repeated rows are leaves of their own; an empty table gives no rows. Other columns are ignored."""
    tree = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.col("doc_id").isNotNull() & (id_remainder(F.col("doc_id"), TAMPER_MOD) == 0)
    low = F.translate("text", UPPER, LOWER)
    leaves = stored(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                                leaf_digest(*fields, F.col("text")).alias("digest"),
                                F.when(tampered, leaf_digest(*fields, low)).alias("changed")), "leaves")
    levels, subroots = grow(numbered(leaves, ["doc_id", "digest"], "numbered"), ["doc_id", "changed"], "tree")
    of_source = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    top, root = grow(numbered(of_source, ["source"], "sources"), ["source"], "top")
    above = proofs(top, root.select("tree", F.array().cast(PROOF).alias("proof")), ["source", "digest"], "top")
    above = stored(above.join(root.select("tree", F.col("digest").alias("root")), "tree")
                   .select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "root", "proof"), "subroots")
    found = proofs(levels, above.select("tree", "proof"), ["doc_id", "digest", "changed"], "tree")
    return (found.join(above.select("tree", "subroot", "root"), "tree")
            .select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", "changed"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def audit(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; rows as ``manifest``."""
    m = manifest(docs)
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    out = m.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                   folded(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int) -> str:
    """DuckDB: both trees level by level, up to FANOUT ** levels leaves a source and as many sources."""
    def f(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(f(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def up(prev: str, run: str, node: str) -> list[str]:
        return [f"{run} AS (SELECT tree, idx // {FANOUT} AS idx, n, string_agg(h, '' ORDER BY idx) AS run FROM {prev} "
                f"GROUP BY tree, idx // {FANOUT}, n)",
                f"{node} AS (SELECT tree, idx, (n + {FANOUT - 1}) // {FANOUT} AS n, CASE WHEN n = 1 THEN run "
                f"ELSE sha256(run) END AS h FROM {run})"]

    def climb(base: str, run: str, name: str) -> str:
        side = f"CASE WHEN r.n = 1 THEN '' ELSE {{}} END"
        left = side.format(f"substr(r.run, 1, 64 * (b.pos % {FANOUT}))")
        right = side.format(f"substr(r.run, 64 * (b.pos % {FANOUT}) + 65)")
        return (f"{name} AS (SELECT b.* EXCLUDE (pos, proof, fold), b.pos // {FANOUT} AS pos, proof || {left} || {right} AS proof, "
                f"CASE WHEN r.n = 1 THEN fold ELSE sha256({left} || fold || {right}) END AS fold "
                f"FROM {base} b JOIN {run} r ON r.tree = b.tree AND r.idx = b.pos // {FANOUT})")

    parts = [
        "bits AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 "
        "THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i))",
        "d AS (SELECT *, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree, "
        "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS crc FROM documents, bits)",
        f"e AS (SELECT doc_id, tree, {leaf('text')} AS h, CASE WHEN crc % {TAMPER_MOD} = 0 "
        f"THEN {leaf(f'''translate(text, '{UPPER}', '{LOWER}')''')} END AS changed FROM d)",
        "n0 AS (SELECT *, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM e "
        "WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h))",
    ]
    for k in range(levels):
        parts += up(f"n{k}", f"r{k}", f"n{k + 1}")
    parts.append(f"s0 AS (SELECT '' AS tree, tree AS source, h, row_number() OVER (ORDER BY tree) - 1 AS idx, "
                 f"count(*) OVER () AS n FROM n{levels})")
    for k in range(levels):
        parts += up(f"s{k}", f"q{k}", f"s{k + 1}")
    parts.append("p0 AS (SELECT doc_id, h AS leaf, tree, idx AS pos, '' AS proof, coalesce(changed, h) AS fold FROM n0)")
    parts += [climb(f"p{k}", f"r{k}", f"p{k + 1}") for k in range(levels)]
    parts.append(f"u0 AS (SELECT p.doc_id, p.leaf, s.h AS subroot, '' AS tree, s.idx AS pos, proof, fold "
                 f"FROM p{levels} p JOIN s0 s ON s.source = p.tree)")
    parts += [climb(f"u{k}", f"q{k}", f"u{k + 1}") for k in range(levels)]
    return ("WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, s.h AS root, sha256(proof) AS proof_sha256, "
            f"fold AS folded_root, fold = s.h AS verified FROM u{levels}, s{levels} s")


SQL = _sql(5)
