"""Sharding by balanced label propagation.

Every document starts in the shard that a hash of its row gives. Documents that
share a hub (here: an equal text) are linked. In each round a Spark join gives
every linked document its hub's preferred shard, the one that holds most of the
hub's documents (as many such shards as the hub needs, if it is larger than a
shard); a shard that turned documents away is preferred only by hubs that are
mostly there. A shard's quota is the room left by the linked documents that stay; if
more want to come, a hash lets in the fitting share. Hubs are counted per shard
before anything meets, so a hub with a third of all rows costs 40 counts.

Unlinked documents cut no edge wherever they lie, so they fill the shards up to
counts at most one apart; linked documents beyond a shard's count move with
them, next to their hub's others.

Defined results: NULL text counts as empty (a text like any other), NULL ids
are allowed, and repeated rows are rows like others. An empty table gives an
empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of
from .ranks import positions

#: Rows that one window sorts on average.
BUCKET_ROWS = 2048


def propagate(links: DataFrame, shards: int, capacity: int, rounds: int = 5) -> DataFrame:
    """``links`` (uid, hub, shard) with the shards after at most ``rounds`` rounds; a written table.

    A uid may stand under several hubs; it follows the vote of the largest."""
    links = stage(links, "shard-links")
    full = F.array(*[F.lit(False)] * shards)
    for turn in range(rounds):
        counts = links.groupBy("hub", "shard").agg(F.count(F.lit(1)).alias("n"))
        held = counts.groupBy("hub").agg(F.sum("n").alias("size"), F.collect_list(F.struct("shard", "n")).alias("held"))
        ordered = F.sort_array(F.transform("held", lambda x: F.struct(  # a full shard only for a hub that is mostly there
            (F.element_at(full, x["shard"] + 1) & (2 * x["n"] <= F.col("size"))).alias("late"), (-x["n"]).alias("n"),
            F.xxhash64("hub", x["shard"]).alias("h"), x["shard"].alias("shard"))))
        wanted = stage(held.withColumn("all", ordered).select(
            "hub", "size", F.transform(F.slice("all", 1, F.ceil(F.col("size") / capacity).cast("int")), lambda x: x["shard"])
            .alias("prefer")), "shard-prefer")  # one entry per shard at most
        pick = F.when(F.array_contains("prefer", F.col("shard")), F.col("shard")).otherwise(
            F.get("prefer", F.pmod(F.xxhash64("uid"), F.size("prefer")).cast("int")))
        votes = stage(links.join(wanted, "hub").select("uid", "hub", "shard", "size", pick.alias("want")), "shard-votes")
        several = votes.groupBy("uid").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
        if not several.isEmpty():
            top = votes.groupBy("uid").agg(F.max_by("want", F.struct("size", "hub")).alias("top"))
            votes = stage(votes.join(top, "uid").withColumn("want", F.col("top")).drop("top"), "shard-votes")
        own = votes.select("uid", "shard", "want").distinct()
        flow = own.groupBy("want").agg(  # one row per shard
            F.sum((F.col("shard") == F.col("want")).cast("long")).alias("stay"), F.count(F.lit(1)).alias("all")).collect()
        if not sum(r.all - r.stay for r in flow):
            break
        admit = [1.0] * shards
        for r in flow:
            if r.all > r.stay:
                admit[r.want] = min(1.0, max(0, capacity - r.stay) / (r.all - r.stay))
        full = F.array(*[F.lit(a < 1.0) for a in admit])
        chance = F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(1 << 20)) / float(1 << 20)
        goes = chance < F.element_at(F.array(*[F.lit(a) for a in admit]), F.col("want") + 1)
        links = stage(votes.select("uid", "hub", F.when(goes, F.col("want")).otherwise(F.col("shard")).alias("shard")), "shard-links")
    return links


def _ranges(sizes: list[int]) -> list[int]:
    out = [0]
    for s in sizes:
        out.append(out[-1] + s)
    return out


def shard_rows(docs: DataFrame, shards: int = 40, rounds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, law ('rows'), shard, slot, grown_shard (NULL)."""
    body = text_of(text_col)
    rows = stage(docs.select(
        F.col(id_col).cast("long").alias("id"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.substring(F.unhex(F.sha2(body, 256)), 1, 16).alias("hub"))
        .withColumn("uid", F.monotonically_increasing_id()), "shard-rows")
    total = rows.count()
    base, more = divmod(total, shards)
    target = [base + (s < more) for s in range(shards)]
    hubs = stage(rows.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hub"), "shard-hubs")
    start = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")
    linked = propagate(rows.select("uid", "hub").join(hubs, "hub").select("uid", "hub", start.alias("shard")), shards,
                       max(1, base), rounds)

    buckets = max(1, -(-total // (shards * BUCKET_ROWS)))
    near = F.pmod(F.xxhash64("hub"), F.lit(buckets)) * 64 + F.pmod(F.xxhash64("uid"), F.lit(64))
    ranked = stage(positions(linked, ["shard"], near, ["hub", "uid"], "rank"), "shard-linked")
    targets = F.array(*[F.lit(t) for t in target])
    stays = F.col("rank") < F.element_at(targets, F.col("shard") + 1)
    held = {r.shard: r.n for r in ranked.filter(stays).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    ends = _ranges([target[s] - held.get(s, 0) for s in range(shards)])

    loose = (rows.select("uid", "hub").join(hubs, "hub", "left_anti").select("uid", "hub", F.lit(1).alias("kind"))
             .unionByName(ranked.filter(~stays).select("uid", "hub", F.lit(0).alias("kind"))))
    loose = stage(loose, "shard-loose")
    n = loose.count()
    wide = max(1, -(-n // BUCKET_ROWS))
    spread = F.pmod(F.when(F.col("kind") == 0, F.xxhash64("hub")).otherwise(F.xxhash64("uid")), F.lit(wide)) * 8 \
        + F.pmod(F.xxhash64("uid"), F.lit(8))
    filled = positions(loose.withColumn("all", F.lit(0)), ["all"], spread, ["kind", "hub", "uid"], "rank")
    place = F.size(F.filter(F.array(*[F.lit(e) for e in ends[1:]]), lambda e: e <= F.col("rank")))
    labels = ranked.filter(stays).select("uid", "shard").unionByName(filled.select("uid", place.alias("shard")))
    placed = stage(rows.drop("hub").join(labels, "uid"), "shard-placed")
    slots = positions(placed, ["shard"], F.pmod(F.xxhash64("uid"), F.lit(buckets)), ["uid"], "slot")
    return slots.select("id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
