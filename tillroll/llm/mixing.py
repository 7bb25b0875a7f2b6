"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in the order of a seeded hash, form blocks of
``block_rows`` documents. A source's target weight w is a ratio of whole numbers. Its block i
may run from slot floor(i / w) and is due by ceil((i + 1) / w); every slot goes
to the released block with the earliest deadline. The weights add up to 1, so
every deadline is met, and at every slot each source is within less than one
block of its target, over the whole stream.

The schedule is made in cycles of ``CYCLE`` slots, each folded over its slots in
SQL and all side by side. What a cycle needs to know is how many blocks each
source had before it. It finds that out by itself: it starts ``warm`` slots early
from an apportioned guess, whose difference the deadlines iron out. Every seam is
checked: if the state that a cycle begins with isn't the one that the cycle before ended with,
all are made again from twice as far back (from slot 0 at the latest), so the
result is the one schedule that a single pass over all slots would give.

Once a source has run out, the others go on by their weights: a phase ends where
the first of its sources does, and the next has the windows of those left.
``scheduled`` rows lie in the first phase, before the first slot that could miss
a block. ``mixed_rows`` gives these alone or, with ``whole``, all rows.

Defined results: a NULL source is a source of its own. A source with weight 0
or none has NULL slots and is not scheduled; one without rows is left out and
the others' weights scaled up. Repeated rows and NULL ids count as rows like
others. An empty table gives an empty result. Only id and source are read.
Blocks count documents, not bytes or tokens. More than MAX_SOURCES sources raise
an error.
"""

from __future__ import annotations

import json
import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, stage
from .ranks import positions

#: Slots of a cycle, slots that it starts early, rows that one window sorts on average, most sources.
CYCLE, WARM, BUCKET_ROWS, MAX_SOURCES = 1000, 250, 1024, 2_000
#: Weights that aren't whole numbers or simple ratios are rounded to so many parts in all.
PARTS = 1 << 24


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in the ratio of the weights above 0: exact where so many parts are enough, else rounded to PARTS."""
    exact = {s: Fraction(str(w)) for s, w in weights.items() if w > 0}
    scale = math.lcm(*(f.denominator for f in exact.values()))
    whole = {s: int(f * scale) for s, f in exact.items()}
    common = math.gcd(*whole.values())
    if sum(whole.values()) <= PARTS * common:
        return {s: x // common for s, x in whole.items()}
    total = sum(exact.values())
    return {s: max(1, round(f / total * PARTS)) for s, f in exact.items()}


def power_weights(counts: dict[str, int], power: float) -> dict[str, float]:
    """Target weights between the corpus's own shares (power 1) and equal ones (power 0)."""
    return {s: n**power for s, n in counts.items()}


def phases(blocks: list[int], weight: list[int]) -> list[dict]:
    """The stretches between the ends of sources: first slot, slots, and per source its first block and number of blocks.

    A source takes part while it has blocks left; a phase ends with the first of its sources."""
    left, start, first, out = list(blocks), 0, [0] * len(blocks), []
    while any(left):
        total = sum(w for w, n in zip(weight, left) if n)
        slots = min(-(-n * total // w) for w, n in zip(weight, left) if n)
        taken = [min(n, w * slots // total) if n else 0 for w, n in zip(weight, left)]
        out.append({"phase": len(out), "start": start, "slots": slots, "total": total, "first": list(first), "taken": taken,
                    "weight": [w if n else 0 for w, n in zip(weight, left)]})
        left = [n - t for n, t in zip(left, taken)]
        first = [f + t for f, t in zip(first, taken)]
        start += slots
    return out


def _table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table from the driver, as one literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


PHASES = "phase:int,start:bigint,slots:bigint,total:bigint,first:array<bigint>,taken:array<bigint>,weight:array<bigint>"

#: A source without weight in its phase takes no part.
_BLOCKS = ("transform(weight, (w, s) -> if(w = 0, NULL, named_struct('due', ((x.n[s] + 1) * total + w - 1) div w, 'pos', s, "
           "'from', (x.n[s] * total) div w)))")


def _fold(first: str, last: str, state: str, keep: bool) -> str:
    """EDF over the slots first .. last - 1 from ``state``; ``keep``: with the picks (slot, pos, block)."""
    ready = f"array_min(filter({_BLOCKS}, b -> b.from <= t))"
    # from a wrong guess no block may be released: then the earliest of all goes
    pick = f"coalesce({ready}, array_min(filter({_BLOCKS}, b -> b IS NOT NULL))).pos"
    picks = "concat(a.picks, array(named_struct('slot', t, 'pos', p, 'block', a.n[p])))" if keep else "a.picks"
    step = (f"aggregate(array({pick}), x, (a, p) -> named_struct('n', transform(a.n, (c, s) -> if(s = p, c + 1, c)), 'picks', {picks}))")
    begin = f"named_struct('n', {state}, 'picks', cast(array() AS array<struct<slot:bigint,pos:int,block:bigint>>))"
    return f"if({first} >= {last}, {begin}, aggregate(sequence({first}, {last} - 1), {begin}, (x, t) -> {step}))"


def _guess(slot: str) -> str:
    """Blocks per source before ``slot``: whole parts, and one more for those that are due first."""
    base = f"transform(weight, w -> (w * {slot}) div total)"
    late = (f"transform(array_sort(filter(transform(weight, (w, s) -> if(w = 0 OR (w * {slot}) % total = 0, NULL, "
            f"named_struct('due', ((((w * {slot}) div total) + 1) * total + w - 1) div w, 'pos', s))), b -> b IS NOT NULL)), b -> b.pos)")
    more = f"slice({late}, 1, cast({slot} - aggregate({base}, 0L, (a, x) -> a + x) AS int))"
    return f"transform({base}, (n, s) -> if(array_contains({more}, s), n + 1, n))"


def cycles(spark: SparkSession, stretches: list[dict], warm: int = WARM) -> DataFrame:
    """(phase, cycle, before, picks, after): every cycle's schedule with the blocks per source before and after it."""
    rows = _table(spark, stretches, PHASES).select("*", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CYCLE})")).alias("cycle"))
    # few bytes but long to make: a number of partitions keeps them from being put together in one task
    rows = rows.repartition(partitions(spark), "phase", "cycle").withColumns({
        "begin": F.col("cycle") * CYCLE, "end": F.least((F.col("cycle") + 1) * CYCLE, "slots"),
        "early": F.greatest(F.col("cycle") * CYCLE - warm, F.lit(0).cast("long"))})
    rows = rows.withColumn("guess", F.expr(_guess("early")))
    rows = rows.withColumn("before", F.expr(_fold("early", "begin", "guess", False)).getField("n"))
    rows = rows.withColumn("made", F.expr(_fold("begin", "end", "before", True)))
    return rows.select("phase", "cycle", "before", F.col("made.picks").alias("picks"), F.col("made.n").alias("after"))


def schedule(spark: SparkSession, stretches: list[dict], warm: int = WARM) -> DataFrame:
    """(pos, block, slot, release, deadline): the slot of every block in the whole stream."""
    longest = max(p["slots"] for p in stretches)
    while True:
        made = stage(cycles(spark, stretches, warm), "mix-cycles")
        next_one = made.select("phase", (F.col("cycle") - 1).alias("cycle"), F.col("before").alias("expected"))
        if warm >= longest or not made.join(next_one, ["phase", "cycle"]).filter("after <> expected").limit(1).count():
            break
        warm *= 2
    of = _table(spark, stretches, PHASES)
    rows = made.select("phase", F.inline("picks")).join(F.broadcast(of), "phase").filter("block < taken[pos]")
    window = lambda text: (F.col("start") + F.expr(text)).alias
    return rows.select("pos", (F.expr("first[pos]") + F.col("block")).alias("block"), (F.col("start") + F.col("slot")).alias("slot"),
                       window("(block * total) div weight[pos]")("release"),
                       window("((block + 1) * total + weight[pos] - 1) div weight[pos]")("deadline"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.7, block_rows: int = 4,
        seed: int = 7, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Per row: id, source, block, release, deadline, slot, place (in the whole stream), scheduled."""
    spark = docs.sparkSession
    named = F.when(F.col(source_col).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(source_col).cast("string")))
    rows = stage(docs.select(F.col(id_col).cast("long").alias("id"), named.alias("mix_source"))
                 .withColumn("h", F.xxhash64("id", F.lit(seed))), "mix-rows")
    counted = rows.groupBy("mix_source").agg(F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: map them to fewer first")
    counts = {r.mix_source: r.n for r in counted}
    own = whole_weights(power_weights(counts, power) if weights is None else {
        s: weights.get(None if s == "null" else s[1:], 0.0) for s in counts})
    names = sorted(own)
    if not counts:
        return spark.createDataFrame([], "id long, source string, block long, release long, deadline long, slot long, place long, scheduled boolean")

    table = _table(spark, [{"mix_source": s, "pos": names.index(s) if s in own else -1, "buckets": 1 + n // BUCKET_ROWS}
                           for s, n in counts.items()], "mix_source:string,pos:int,buckets:bigint")
    ranked = positions(rows.join(F.broadcast(table), "mix_source"), ["mix_source"],
                       F.pmod(F.col("h"), F.col("buckets")), ["h", "id"], "rank")
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block_rows))
    if names:
        stretches = phases([-(-counts[s] // block_rows) for s in names], [own[s] for s in names])
        one = stretches[0]  # a source's first block beyond its part of the phase can't run earlier than this
        end = min(t * one["total"] // w for t, w in zip(one["taken"], one["weight"]) if w)
        made = schedule(spark, stretches)
    else:
        end, made = 0, spark.range(0).selectExpr("cast(id AS int) AS pos", "id AS block", "id AS slot", "id AS release", "id AS deadline")
    return ranked.join(made, ["pos", "block"], "left").select(
        "id", F.when(F.col("mix_source") != "null", F.expr("substring(mix_source, 2)")).alias("source"), "block",
        "release", "deadline", "slot", (F.col("slot") * block_rows + F.col("rank") % block_rows).alias("place"),
        F.coalesce(F.col("slot") < end, F.lit(False)).alias("scheduled"))


def mixed_rows(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.7, block_rows: int = 4,
               id_col: str = "doc_id", source_col: str = "source", whole: bool = False) -> DataFrame:
    """The scheduled rows of ``docs`` in the order of the mix, with their own columns; with ``whole`` all rows that
    have a slot, so all but those of sources with weight 0. Rows that repeat an id count once."""
    plan = (mix(docs, weights, power, block_rows, id_col=id_col, source_col=source_col)
            .filter("slot IS NOT NULL" if whole else "scheduled").groupBy("id").agg(F.min("place").alias("place")).select(F.col("id").alias("_mix_id"), F.col("place").alias("_mix_place")))
    return (docs.join(plan, F.col(id_col).cast("long").eqNullSafe(F.col("_mix_id")))
            .orderBy("_mix_place").drop("_mix_id", "_mix_place"))
