"""Merkle manifest of a table: one tree of row digests per group, one tree over the groups, a proof for every row.

Proofs come from pointer jumping. Every node starts with a pointer to its parent and the segment of siblings met on the
way. Joining the nodes with themselves appends the segment of the node pointed to and takes over its pointer, so the
distance covered doubles until every leaf has reached the root. After k rounds leaves point 2 ** k levels up, so only
nodes of such levels are carried on to be joined with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetworks.llm.frames import named
from fleetworks.operators.numbering import number_rows
from fleetworks.session import scratch_dir, settle

#: Consecutive nodes that become one.
ARITY = 3
#: Columns of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the groups, and where pointers beyond the root lead.
TOP, DONE = -1, -2
_SEGMENT = "array<struct<left:binary,right:binary>>"
_NOTHING = b""


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the values: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(_NOTHING), lambda done, d: F.concat(done, d))


def _combined(run: Column) -> Column:
    """Digest of consecutive digests, as 32 bytes."""
    return F.unhex(F.sha2(_hex(_joined(run)), 256))


def proof_digest(siblings: Column) -> Column:
    """sha256 of all siblings from leaf to root, left to right on each level."""
    return F.sha2(_hex(F.aggregate(siblings, F.lit(_NOTHING), lambda done, s: F.concat(done, s["left"], s["right"]))), 256)


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf's hex digest and its siblings lead to."""
    return F.aggregate(siblings, leaf, lambda own, s: F.sha2(F.concat(_hex(s["left"]), own, _hex(s["right"])), 256))


def _grown(leaves: DataFrame, most: int, label: str) -> tuple[DataFrame, DataFrame, int]:
    """Trees over (tree, pos, n, digest), n being a tree's leaves and ``most`` the largest n.

    Returns the members (tree, level, pos, n, left, right), without the last node of each tree; these last nodes
    (tree, level, digest); and the number of levels. One job a level, each a third of the one before. Groups hold at
    most ``ARITY`` rows.
    """
    spark, path, level = leaves.sparkSession, scratch_dir(leaves.sparkSession, label), 0
    nodes = leaves
    tops = [leaves.where("n = 1").select("tree", F.lit(0).alias("level"), "digest")]
    runs = "tree int, up bigint, n bigint, run array<struct<pos:bigint,digest:binary>>"
    while most > 1:
        grouped = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {ARITY}").alias("up"), "n").agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("run"))
        grouped.select("tree", "up", "n", "run").write.parquet(f"{path}/level={level}")
        level += 1
        made = spark.read.schema(runs).parquet(f"{path}/level={level - 1}")
        nodes = made.select("tree", F.col("up").alias("pos"), F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
                            _combined(F.col("run.digest")).alias("digest"))
        tops.append(nodes.where("n = 1").select("tree", F.lit(level).alias("level"), "digest"))
        most = -(-most // ARITY)
    ends = tops[0]
    for more in tops[1:]:
        ends = ends.unionByName(more)
    if not level:
        members = leaves.where("false").select("tree", F.lit(0).alias("level"), "pos", "n", F.col("digest").alias("left"),
                                               F.col("digest").alias("right"))
    else:
        members = spark.read.schema(f"{runs}, level int").parquet(path).select(
            "tree", "level", "n", F.col("run.digest").alias("_run"), F.posexplode("run").alias("_at", "_own")).select(
            "tree", "level", F.col("_own.pos").alias("pos"), "n", _joined(F.slice("_run", 1, F.col("_at"))).alias("left"),
            _joined(F.slice("_run", F.col("_at") + 2, ARITY)).alias("right"))
    return members, settle(ends, f"{label}-ends"), level


def _pointers(members: DataFrame, last: Column) -> DataFrame:
    """Nodes with a pointer to their parent; where the parent is the root, to a place of their own beyond it."""
    beyond = last & (F.col("n") <= ARITY)
    return members.select(
        "tree", "level", "pos", F.when(beyond, DONE).otherwise(F.col("tree")).alias("to_tree"),
        F.when(beyond, 0).otherwise(F.col("level") + 1).alias("to_level"),
        F.when(beyond, F.col("pos")).otherwise(F.expr(f"pos div {ARITY}")).alias("to_pos"),
        F.array(F.struct("left", "right")).cast(_SEGMENT).alias("siblings"))


def _jumped(nodes: DataFrame, hops: DataFrame) -> DataFrame:
    """``nodes`` with the segments and pointers of the ``hops`` they point to; those beyond the root stay."""
    met = hops.select(F.col("tree").alias("to_tree"), F.col("level").alias("to_level"), F.col("pos").alias("to_pos"),
                      F.col("to_tree").alias("_tree"), F.col("to_level").alias("_level"), F.col("to_pos").alias("_pos"),
                      F.col("siblings").alias("_more"))
    joined = nodes.join(met, ["to_tree", "to_level", "to_pos"], "left")
    hit, rest = F.col("_tree").isNotNull(), [c for c in nodes.columns if not c.startswith("to_") and c != "siblings"]
    return joined.select(
        *rest, F.coalesce("_tree", "to_tree").alias("to_tree"), F.coalesce("_level", "to_level").alias("to_level"),
        # places beyond the root are spread, since no other row is to meet there
        F.when(F.col("_tree") == DONE, F.col("pos")).when(hit, F.col("_pos")).otherwise(F.col("to_pos")).alias("to_pos"),
        F.when(hit, F.concat("siblings", "_more")).otherwise(F.col("siblings")).alias("siblings"))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: Sequence[str] = FIELDS,
             changed: dict[str, Column] | None = None) -> DataFrame:
    """Per row: key, ``leaf``, ``subroot``, ``root`` and ``siblings`` from leaf to root, an array of (left, right).

    A leaf is the digest of ``fields``. The leaves of a group ascend by key; of equal keys, by their digests, and a null
    key comes first. Every ``ARITY`` consecutive nodes become one, the last ones of a level too if fewer, even one, until
    one is left, the subroot; a lone leaf is its own. Subroots ascend by group, null first and UTF-8 bytewise, and become
    the root in the same way. Digests are lowercase hex; siblings are kept as the bytes of theirs joined together.

    ``changed`` replaces fields by expressions over the columns of ``docs`` and adds ``changed_leaf``, the digest of the
    row so altered; the trees are of the unaltered rows. Repeated rows are leaves each. Columns beside the fields change
    nothing. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    wanted = [named(f) for f in fields]
    altered = [(changed or {}).get(f, named(f)) for f in fields]
    light = docs.select(named(key).alias("_key"), named(group).alias("_group"), F.unhex(leaf_digest(wanted)).alias("digest"),
                        *([F.unhex(leaf_digest(altered)).alias("_changed")] if changed else []))
    # the texts are read once; from here on rows are digests
    numbered = settle(number_rows(settle(light, "leaves"), ["_group", "_key", "digest"], "_number", start=0), "leaf-numbers")
    trees = numbered.groupBy("_group").agg(F.min("_number").alias("_start"), F.count("*").alias("n"))
    trees = settle(number_rows(trees, ["_start"], "tree", start=0).withColumn("tree", F.col("tree").cast("int")), "trees")
    many, most = trees.agg(F.count("*"), F.max("n")).first()
    shape = "subroot string, root string, siblings " + _SEGMENT + (", changed_leaf string" if changed else "")
    if not many:
        return spark.createDataFrame([], "leaf string, " + shape).select(F.lit(None).cast(docs.schema[key].dataType).alias(key), "*")
    placed = numbered.join(trees, numbered["_group"].eqNullSafe(trees["_group"]))
    placed = settle(placed.select("_key", "tree", (F.col("_number") - F.col("_start")).alias("pos"), "n", "digest",
                                  *(["_changed"] if changed else [])), "placed")
    members, subroots, height = _grown(placed.select("tree", "pos", "n", "digest"), most, "runs")
    tops = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").cast("bigint").alias("pos"),
                           F.lit(many).cast("bigint").alias("n"), "digest")
    top_members, ends, top_height = _grown(tops, many, "top-runs")
    root = ends.select(_hex(F.col("digest"))).first()[0]

    # a subroot is the leaf of the top tree at its group's place, and goes on from there under its own name
    above = _pointers(top_members, F.lit(True))
    linked = above.where("level = 0").drop("tree", "level").join(
        subroots.select(F.col("tree").cast("bigint").alias("pos"), "tree", "level"), "pos").withColumn("pos", F.lit(0).cast("bigint"))
    nodes = settle(_pointers(members, F.lit(many == 1)).unionByName(linked).unionByName(above.where("level > 0")), "nodes")
    own = ["_key", "tree", "pos", "digest", *(["_changed"] if changed else [])]
    starts = nodes.where(f"tree <> {TOP} and level = 0").drop("level")
    if height + top_height == 0:
        leaves = placed.select(*own, F.array().cast(_SEGMENT).alias("siblings"))
    else:
        leaves = placed.select(*own).join(starts, ["tree", "pos"])
        hops, reach = nodes.where(f"tree = {TOP} or level > 0"), 1
        while reach < height + top_height:
            leaves = _jumped(leaves, hops)
            reach *= 2
            if reach < height + top_height:
                kept = (F.col("tree") == TOP) | (F.col("level") % reach == 0)
                hops = settle(_jumped(hops.where(kept), hops), "hops")
    return leaves.join(subroots.select("tree", F.col("digest").alias("_subroot")), "tree").select(
        F.col("_key").alias(key), _hex(F.col("digest")).alias("leaf"), _hex(F.col("_subroot")).alias("subroot"),
        F.lit(root).alias("root"), "siblings", *([_hex(F.col("_changed")).alias("changed_leaf")] if changed else []))


def verified(rows: DataFrame, leaf: str = "leaf") -> DataFrame:
    """Rows of a manifest with ``folded_root``, what ``leaf`` and the siblings lead to, and whether it is the root."""
    return rows.withColumn("folded_root", folded(F.col(leaf), F.col("siblings"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
