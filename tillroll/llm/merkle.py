"""Merkle dataset manifest: a tree per group over its rows, and a tree over the groups' roots.

A node's digest is the hash of its children's digests, ``fanout`` consecutive
ones each. Trees are built by a slot pivot: grouping by the parent's place,
conditional aggregates spread its children into ``fanout`` columns, the columns
side by side are hashed, and without a child's own column they are its
siblings. One shuffle serves ``TIER`` levels: rows are dealt by the block of
fanout**TIER leaves that they lie in, so the groupings above it need no other,
and a block is kept as one row that holds its small subtree. Going down again,
blocks are opened level by level in place; only the row of a block, not of a
leaf, is joined with the path from above.

Places come from one range sort: a row's place is its row number in the sorted
partition plus the rows of its group in earlier partitions, so that a group
with a third of all rows is spread like any other.

Defined results: NULL fields hash as ``-``; a NULL group is a group of its own,
before all others; a NULL id comes first in its group. Rows that repeat an id
are leaves each, ordered by their digest. A tree of one leaf is that leaf. An
empty table gives an empty manifest. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stage

#: Children of a node; levels that share one shuffle.
FANOUT, TIER = 3, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:binary,right:binary>"


def field(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(fields: list[Column]) -> Column:
    """The lowercase hex SHA-256 of a row's fields."""
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hex digest leads to by its siblings."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(_hex(p.left), h, _hex(p.right)), 256))


def proof(path: Column) -> Column:
    """All siblings' hex digests, from the leaf's level up, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(_hex(p.left), _hex(p.right))), "")


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """(key, n, pos, node): the place of each row in its key, by ``order``, and the key's number of rows."""
    ranged = (rows.repartitionByRange(partitions(rows.sparkSession), "key", *order).sortWithinPartitions("key", *order)
              .select("key", "node", F.monotonically_increasing_id().alias("row")))
    ranged = stage(ranged, name).withColumn("part", F.shiftright("row", 33))
    runs = ranged.groupBy("key", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("key")  # a row per partition that holds the key
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("key", "part", "first", F.sum("rows").over(whole).alias("n"),
                       F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return ranged.join(runs, ["key", "part"]).select(
        "key", "n", (F.col("offset") + F.col("row") - F.col("first")).alias("pos"), "node")


def _tier(nodes: DataFrame, fanout: int) -> DataFrame:
    """``TIER`` levels up: a row per block (key, n, pos) with its subtree in ``node``."""
    rows = nodes.withColumn("block", F.expr(f"pos div {fanout ** TIER}")).repartition("key", "block")
    kids = [f"c{i}" for i in range(fanout)]
    for _ in range(TIER):
        slots = [F.max(F.when(F.col("slot") == i, F.col("node"))).alias(c) for i, c in enumerate(kids)]
        rows = (rows.select("key", "block", "n", F.expr(f"pos div {fanout}").alias("pos"),
                            (F.col("pos") % fanout).alias("slot"), "node")
                .groupBy("key", "block", "pos").agg(F.min("n").alias("n"), *slots))
        many = F.col("n") > 1  # a lone node is its tree's root
        joined = F.unhex(F.sha2(F.concat(*[F.coalesce(_hex(F.col(f"{c}.hash")), F.lit("")) for c in kids]), 256))
        rows = rows.select("key", "block", "pos", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.struct(
            F.when(many, joined).otherwise(F.col("c0.hash")).alias("hash"), many.alias("many"), *kids).alias("node"))
    return rows.select("key", "n", "pos", "node")


def _up(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """The written tiers of a forest, leaves first; the last has a row per key."""
    most, tiers = nodes.agg(F.max("n")).first()[0] or 0, []
    while True:
        tiers.append(stage(_tier(nodes, fanout), f"{name}-{len(tiers)}"))
        most = -(-most // fanout ** TIER)
        if most <= 1:
            return tiers
        nodes = tiers[-1].select("key", "n", "pos", F.struct("node.hash").alias("node"))


def _down(tiers: list[DataFrame], above: DataFrame | None, fanout: int) -> DataFrame:
    """(key, subroot, node, path) per leaf. ``above``: (key, path) from the subroots on."""
    rows = tiers[-1].withColumn("subroot", F.col("node.hash"))
    rows = rows.join(above, "key") if above is not None else rows.withColumn("path", F.array().cast(f"array<{_STEP}>"))
    kids = [f"c{i}" for i in range(fanout)]
    for k, tier in enumerate(reversed(tiers)):
        if k:
            rows = rows.drop("node").join(tier.select("key", "pos", "node"), ["key", "pos"])
        for _ in range(TIER):
            raw = [F.coalesce(F.col(f"node.{c}.hash"), F.lit(b"")) for c in kids]
            opened = []
            for i, c in enumerate(kids):
                step = F.struct(F.concat(F.lit(b""), *raw[:i]).alias("left"), F.concat(F.lit(b""), *raw[i + 1:]).alias("right"))
                path = F.when(F.col("node.many"), F.concat(F.array(step), "path")).otherwise(F.col("path"))
                opened.append(F.struct((F.col("pos") * fanout + i).alias("pos"), F.col(f"node.{c}").alias("node"), path.alias("path")))
            live = F.filter(F.array(*opened), lambda x: x.node.isNotNull())
            rows = rows.select("key", "subroot", F.explode(live).alias("x")).select("key", "subroot", "x.pos", "x.node", "x.path")
    return rows.select("key", "subroot", "node", "path")


def manifest(rows: DataFrame, group: Column, order: Column, leaf: Column, carry: dict[str, Column] | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """Per row: leaf, subroot and root (hex), path (its siblings, leaf's level first) and the carried columns.

    ``group`` names the subtree, ``order`` the place in it; ``leaf`` is the row's hex digest."""
    carry = carry or {}
    key = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    node = F.struct(F.unhex(leaf).alias("hash"), order.alias("at"), *[c.alias(name) for name, c in carry.items()])
    leaves = stage(rows.select(key.alias("key"), node.alias("node")), "merkle-leaves")
    forest = _up(_numbered(leaves, ["node.at", "node.hash"], "merkle-order"), fanout, "merkle-tier")
    subroots = forest[-1].select(F.lit("").alias("key"), F.struct("node.hash", F.col("key").alias("group")).alias("node"))
    crown = _up(_numbered(subroots, ["node.group"], "merkle-subroots"), fanout, "merkle-crown")
    above = stage(_down(crown, None, fanout).select(F.col("node.group").alias("key"), "path", F.col("subroot").alias("root")),
                  "merkle-paths")
    roots = above.select("key", "root")
    down = _down(forest, above.select("key", "path"), fanout).join(roots, "key")
    return down.select(_hex(F.col("node.hash")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                       _hex(F.col("root")).alias("root"), "path", *[F.col(f"node.{name}").alias(name) for name in carry])


def verify(docs: DataFrame, tampered: Column, id_col: str = "doc_id", group_col: str = "source",
           fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> DataFrame:
    """The manifest of ``docs`` held against their texts as ``tampered`` gives them.

    Per row: id, leaf, subroot, root, path, proof_sha256, folded_root (from the
    tampered text's leaf and the original siblings), verified."""
    def leaf(text: Column) -> Column:
        return digest([text if name == text_col else F.col(name) for name in fields])

    rows = manifest(docs, F.col(group_col), F.col(id_col), leaf(F.col(text_col)),
                    {"id": F.col(id_col), "found": F.unhex(leaf(tampered))})
    rows = rows.withColumn("folded_root", fold(_hex(F.col("found")), F.col("path"))).drop("found")
    return rows.withColumns({"proof_sha256": F.sha2(proof(F.col("path")), 256),
                             "verified": F.col("folded_root") == F.col("root")})
