"""Merkle dataset manifest (11): levels of digests as parent-linked rows, and a recursive query that climbs them.

Each row of a table is a leaf. Leaves of one group (``lang``) form a tree of fan-out 8, the groups' subroots form the
tree above them. Every inner node is a row (id, kids, up, pos): its children's digests in order, its parent's id and its
place there. A recursive Spark query climbs from the leaves: each step joins the parent, puts the carried digest in its
place among the parent's kids, hashes them, and appends the siblings to the proof. A run's leaves share every step above
their own, so they climb as one row that holds each leaf's digest. Rows per step: an eighth of the table's.

Digests travel as 32 bytes; H hashes their lowercase hex text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.llm.common import stored
from surveyspark.llm.ranks import ranked

#: Children of a node, and bytes of a digest.
FAN, DIGEST = 8, 32

#: The tree of subroots; groups' trees are named "0" (null) or "1" and the group's text, which sorts null first.
TOP = ""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Manifest:
    """``packs``: a row for each run of leaves: docs (ids in order), kids (their digests), up, pos. ``nodes``: inner nodes.
    ``tops``: one row, the root's digest; none for an empty table."""

    packs: DataFrame
    nodes: DataFrame
    tops: DataFrame


def hashed(digests: Column) -> Column:
    """H of 32-byte digests that lie one after the other."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)).cast("binary"), 256))


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


def node_id(level: Column, index: Column, tree: Column) -> Column:
    return F.concat_ws("/", level.cast("string"), index.cast("string"), tree)


def _joined(order: str, digest: str) -> Column:
    """Digests of a run, one after the other. A run has at most FAN of them."""
    run = F.array_sort(F.collect_list(F.struct(order, digest)))
    return F.aggregate(run, F.unhex(F.lit("")), lambda done, x: F.concat(done, x[digest]))


def _levels(level0: DataFrame) -> list[DataFrame]:
    """Levels above (tree, index, n, digest), n the nodes of the tree at that level: each with its kids too."""
    most = level0.agg(F.max("n")).first()[0] or 0
    out, level = [], level0
    while most > 1:
        runs = level.filter("n > 1").groupBy("tree", "n", F.expr(f"index div {FAN}").alias("up")).agg(_joined("index", "digest").alias("kids"))
        level = stored(
            runs.select("tree", F.col("up").alias("index"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), hashed(F.col("kids")).alias("digest"), "kids"), "merkle-level"
        )
        out.append(level)
        most = -(-most // FAN)
    return out


def build(df: DataFrame, columns: list[str], group: str, key: str, tampered: Column | None = None, changed: str = "text") -> Manifest:
    """The manifest of ``df``: leaves of ``columns`` by ``group``, ascending by ``key`` (nulls first; ties by digest).

    ``tampered`` (a Column, the text to read instead of ``changed``) gives each leaf a second digest, the one to climb
    with; by default it is the leaf's own. Only digests, keys and groups are shuffled, never ``columns``."""
    given = [F.col(c) for c in columns]
    other = [tampered if c == changed and tampered is not None else F.col(c) for c in columns]
    leaves = df.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("tree"), F.col(key).alias("key"), leaf_digest(given).alias("digest"), leaf_digest(other).alias("carried")
    )
    leaves = stored(ranked(leaves, "tree", [F.col("key").asc_nulls_first(), F.col("digest")], rank="index", size="n"), "merkle-leaves")
    levels = _levels(leaves.select("tree", "index", "n", "digest"))
    tops = leaves.filter("n = 1").select("tree", "digest")
    for level in levels:
        tops = tops.unionByName(level.filter("n = 1").select("tree", "digest"))
    trees = ranked(tops.withColumn("all", F.lit(0)), "all", [F.col("tree")], rank="index", size="n")
    trees = stored(trees.select("tree", "index", "n", "digest"), "merkle-trees")
    above = _levels(trees.select(F.lit(TOP).alias("tree"), "index", "n", "digest"))
    # where a tree's single top goes: into the tree of subroots, or nowhere if there is but one tree
    link = trees.select(
        "tree", F.col("n").alias("trees"), F.when(F.col("n") > 1, node_id(F.lit(1), F.expr(f"index div {FAN}"), F.lit(TOP))).alias("to"), F.when(F.col("n") > 1, F.expr(f"index % {FAN}")).alias("at")
    )
    parts = [level.withColumn("level", F.lit(i + 1)) for i, level in enumerate(levels)]
    inner = [_linked(p.filter("n > 1")) for p in parts] + [
        p.filter("n = 1").join(link, "tree").select(node_id(F.col("level"), F.col("index"), F.col("tree")).alias("id"), "kids", F.col("to").alias("up"), F.col("at").cast("int").alias("pos")) for p in parts
    ]
    inner += [_linked(p.withColumn("level", F.lit(i + 1))) for i, p in enumerate(above)]
    spark = df.sparkSession
    nodes = spark.createDataFrame([], "id string, kids binary, up string, pos int")
    for part in inner:
        nodes = nodes.unionByName(part)
    run = F.expr(f"index div {FAN}").alias("run")
    packs = leaves.groupBy("tree", "n", run).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("index", "key"))), lambda x: x["key"]).alias("keys"),
        F.transform(F.array_sort(F.collect_list(F.struct("index", "carried"))), lambda x: x["carried"]).alias("carried"),
        _joined("index", "digest").alias("kids"),
    )
    many = packs.filter("n > 1").select("keys", "carried", "kids", node_id(F.lit(1), F.col("run"), F.col("tree")).alias("up"), F.lit(None).cast("int").alias("pos"))
    single = packs.filter("n = 1").join(link, "tree").select("keys", "carried", "kids", F.col("to").alias("up"), F.col("at").cast("int").alias("pos"))
    root = (above[-1] if above else trees.filter("n = 1")).select(F.col("digest").alias("root"))
    return Manifest(stored(many.unionByName(single), "merkle-packs"), stored(nodes, "merkle-nodes"), stored(root, "merkle-root"))


def _linked(level: DataFrame) -> DataFrame:
    """Nodes below their tree's top, linked to the level above; the top of the uppermost tree has no parent."""
    up = F.when(F.col("n") > 1, node_id(F.col("level") + 1, F.expr(f"index div {FAN}"), F.col("tree")))
    pos = F.when(F.col("n") > 1, F.expr(f"index % {FAN}")).cast("int")
    return level.select(node_id(F.col("level"), F.col("index"), F.col("tree")).alias("id"), "kids", up.alias("up"), pos.alias("pos"))


CLIMB = """
WITH RECURSIVE climb (keys, carried, kids, up, pos, subroot, path) AS (
  SELECT keys, carried, kids, up, pos, CAST(NULL AS BINARY), CAST('' AS BINARY) FROM {packs}
  UNION ALL
  SELECT c.keys,
    transform(c.carried, (x, i) -> unhex(sha2(CAST(lower(hex(concat(
      substring(n.kids, 1, {digest} * coalesce(c.pos, i)), x, substring(n.kids, {digest} * coalesce(c.pos, i) + {digest} + 1)))) AS BINARY), 256))),
    c.kids, n.up, n.pos,
    CASE WHEN n.id RLIKE '^1/[0-9]+/$' THEN substring(n.kids, {digest} * c.pos + 1, {digest}) ELSE c.subroot END,
    CASE WHEN c.pos IS NULL THEN c.path
      ELSE concat(c.path, substring(n.kids, 1, {digest} * c.pos), substring(n.kids, {digest} * c.pos + {digest} + 1)) END
  FROM climb c JOIN {nodes} n ON c.up = n.id)
SELECT keys, carried, kids, pos, subroot, path FROM climb WHERE up IS NULL
"""


def climbed(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """The packs at the root: each leaf's folded digest in ``carried``, siblings above its run in ``path``.

    ``kids`` are the run's original leaves; ``subroot`` is null where the only tree's top is the root."""
    names = {k: f"merkle_{k}_{uuid.uuid4().hex[:12]}" for k in ("packs", "nodes")}
    manifest.packs.createOrReplaceTempView(names["packs"])
    manifest.nodes.createOrReplaceTempView(names["nodes"])
    limit = "spark.sql.cteRecursionRowLimit"  # Spark's guard against endless recursion counts rows; here levels end it
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        return stored(spark.sql(CLIMB.format(digest=DIGEST, **names)), "merkle-climb")
    finally:
        spark.conf.set(limit, before)
        for name in names.values():
            spark.catalog.dropTempView(name)


def verify(df: DataFrame, columns: list[str], group: str, key: str, tampered: Column | None = None, changed: str = "text") -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    Nulls anywhere are values of their own (a null group is a tree, a null key sorts first); empty and very long texts
    are hashed whole; repeated rows are leaves of their own, side by side; an empty table gives no rows; further columns
    are not read. One tree alone is the root; one leaf alone is its subroot, and a proof without siblings is H of nothing."""
    manifest = build(df, columns, group, key, tampered, changed)
    top = climbed(df.sparkSession, manifest)
    root = manifest.tops.select("root").scalar()
    each = top.select(F.posexplode(F.arrays_zip("keys", "carried")).alias("i", "leaf"), "kids", "path", "subroot")
    def text(x: Column) -> Column:
        return F.lower(F.hex(x))

    # the column functions of substring take fixed places only
    own = F.expr(f"substring(kids, i * {DIGEST} + 1, {DIGEST})")
    beside = F.expr(f"concat(substring(kids, 1, i * {DIGEST}), substring(kids, i * {DIGEST} + {DIGEST} + 1), path)")
    out = each.select(
        F.col("leaf.keys").alias(key), text(own).alias("leaf"), F.coalesce("subroot", root).alias("subroot"), root.alias("root"), F.sha2(text(beside).cast("binary"), 256).alias("proof_sha256"),
        text(F.col("leaf.carried")).alias("folded_root"),
    )
    return out.withColumns({"subroot": text(F.col("subroot")), "root": text(F.col("root"))}).withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(key: str, text: str) -> Column:
    """The tampered text: A-Z lower-cased where 3 divides the crc32 of the decimal key; a null key's text stays."""
    return F.when(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0, F.translate(F.col(text), UPPER, LOWER)).otherwise(F.col(text))


def manifest_proofs(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, tampered with by ``lowered``, verified leaf by leaf (see ``verify``)."""
    out = verify(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", lowered("doc_id", "text"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
