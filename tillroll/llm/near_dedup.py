"""Near-duplicate classes by HyperMinHash.

1. A document's distinct word shingles are hashed to 64 bits. The top 8 bits
   choose one of 256 buckets; of a bucket's smallest remainder the register
   keeps the number of leading zeros (6 bits) and 10 mantissa bits. An empty
   bucket borrows the register that a fixed random ranking of the filled ones
   puts first, so small sets compare like large ones.
2. Documents with equal sets are one node from here on.
3. 51 bands of 5 registers are hashed to keys; a pair at 0.8 shares none with
   probability 2e-9. Nodes of a key are compared with one of them only,
   the one that shares the most keys, not with each other.
4. A candidate is dropped if the Jaccard index estimated from its registers,
   corrected for chance collisions, is over six standard errors too low. The
   others are verified on full sets: the most promising partner of each node
   first, then those that still join two components.
5. What a star can miss: two nodes of a key that are linked with each other but
   not with that one. Keys whose nodes lie in more than one component are
   finished exactly: their nodes' shingles are ordered from rare to common, and
   two sets as similar as asked must share one of their first
   n - ceil(0.8 n) + 1. Pairs in different components that do are verified.
   Nodes of a large group are mostly in one component by then and pair no more.
6. Components of the links, by joins; later links are folded into the
   components that the earlier ones made.

Defined results: lower case is A-Z only; words are split at ASCII white space;
a text with fewer words than a shingle is one shingle; NULL or empty texts have
none, are linked with nothing and stay. A row with a NULL id is a document
linked with nothing. Rows that repeat an id and a text carry the same result.
An empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, text_of
from .components import components

#: 256 registers; bands times registers a band; standard errors that an estimate may be off.
REGISTERS, BANDS, ROWS, ERRORS = 256, 51, 5, 6.0
MANTISSA = 10
#: Nodes whose ids may be broadcast to fetch their texts (24 bytes each); beyond it Spark shuffles.
BROADCAST_NODES = 200_000
#: Rows of a batch that Spark sends a Python worker: two full sets a row, so the default of 10,000 would be hundreds of megabytes.
PIECE_ROWS = 256

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S31, _S33, _S29 = np.uint64(31), np.uint64(33), np.uint64(29)
_LOW = np.uint64((1 << 56) - 1)
_BORROW = np.random.RandomState(20).permutation(REGISTERS * REGISTERS).reshape(REGISTERS, REGISTERS)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S33)) * _B
    h = (h ^ (h >> _S29)) * _C
    return h ^ (h >> _S31)


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    size = min(words, len(found))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for j in range(size):
        h = (h ^ (h >> _S31)) * _A + w[j:len(w) - size + 1 + j]
    return np.unique(_scramble(h))


def registers(s: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a non-empty sorted set."""
    bucket = (s >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    mantissa, exponent = np.frexp((s[first] & _LOW).astype(np.float64))
    bits = np.maximum(((mantissa - 0.5) * (1 << (MANTISSA + 1))).astype(np.int64), 0)
    value = ((np.clip(56 - exponent, 0, 63).astype(np.int64) << MANTISSA) | bits).astype("<u2")
    filled = bucket[first]
    out = np.zeros(REGISTERS, "<u2")
    out[filled] = value
    if len(filled) < REGISTERS:
        empty = np.ones(REGISTERS, bool)
        empty[filled] = False
        out[empty] = value[np.argmin(_BORROW[empty][:, filled], axis=1)]
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, its standard error at 0.8) of register rows of sets with ``n_a`` and ``n_b`` members."""
    same = (a == b).mean(axis=1)
    steps = 2.0 ** -np.arange(0, 58)

    def zeros(n):  # distribution of the leading zeros of a bucket's smallest member
        rest = np.exp(-np.maximum(n, 1.0)[:, None] / REGISTERS * steps[None, :])
        return np.diff(rest, axis=1) / np.maximum(1e-12, 1.0 - rest[:, :1])
    chance = (zeros(n_a) * zeros(n_b)).sum(axis=1) * 2.0 ** -MANTISSA
    held = REGISTERS * (1.0 - np.exp(-np.minimum(n_a, n_b) / REGISTERS))
    return (same - chance) / (1.0 - chance), np.sqrt(0.16 / np.maximum(1.0, np.minimum(held, np.minimum(n_a, n_b))))


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, regs = [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), words)
                sizes.append(len(s))
                key = np.array([len(s), _scramble(s).sum(dtype=np.uint64), _scramble(s ^ _A).sum(dtype=np.uint64)], "<u8")
                keys.append(key.tobytes())
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                   pa.array(regs, pa.binary())], names=["doc_id", "n", "set_key", "regs"])
    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``PIECE_ROWS`` rows for the steps run inside; the session's own number stands again afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = spark.conf.get(key)
    rows = int(held)
    spark.conf.set(key, str(min(rows, PIECE_ROWS) if rows > 0 else PIECE_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, held)


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, keep, sets = batch.column(0).to_pylist(), [], []
            for k, (key, text) in enumerate(zip(batch.column(1), batch.column(2))):
                s = shingles(text.as_py(), words)
                own = np.array([len(s), _scramble(s).sum(dtype=np.uint64), _scramble(s ^ _A).sum(dtype=np.uint64)], "<u8")
                if own.tobytes() == key.as_py():  # an id may stand for several texts
                    keep.append(node[k])
                    sets.append(s.astype("<u8").tobytes())
            yield pa.record_batch([pa.array(keep, pa.int64()), pa.array(sets, pa.binary())], names=["node", "members"])
    return run


def _promising(low: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in (3, 4))
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in (5, 6))
            j, error = estimate(a, b, n_a, n_b)
            yield batch.select([0, 1, 2]).filter(pa.array(j >= low - ERRORS * error))
    return run


def _linked(part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= part * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return run


class _Classes:
    """The steps over one table of documents."""

    def __init__(self, docs: DataFrame, words: int, percent: int, id_col: str, text_col: str):
        self.words, self.percent = words, percent
        self.texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
        self.sigs = stage(self.texts.mapInArrow(_sketch(words), "doc_id long, n long, set_key binary, regs binary"), "near-sketches")
        sets = (self.sigs.filter("n > 0 AND doc_id IS NOT NULL").groupBy("set_key", "n")
                .agg(F.min("doc_id").alias("rep"), F.first("regs").alias("regs")))
        self.nodes = stage(sets.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
        self.labels: DataFrame | None = None

    def members(self) -> DataFrame:
        """(key, node, n, hub, size) of band keys that two nodes or more share.

        A key's hub is its node with the most company over all its keys: in a group
        of edited copies that is the least edited one, which most others are close to."""
        keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", 1 + 2 * ROWS * i, 2 * ROWS)) for i in range(BANDS)])
        bands = self.nodes.select("node", "n", F.explode(keys).alias("key"))
        shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        held = stage(bands.join(stage(shared, "near-keys"), "key"), "near-shared")
        company = stage(held.groupBy("node").agg(F.sum("size").alias("company")), "near-company")
        hubs = (held.join(company, "node").groupBy("key")
                .agg(F.max_by("node", F.struct("company", "node")).alias("hub")))
        return stage(held.join(stage(hubs, "near-hubs"), "key"), "near-members")

    def candidates(self, members: DataFrame) -> DataFrame:
        """(a, b, shared) whose registers allow a link."""
        pairs = stage(members.filter("node <> hub").groupBy(F.col("hub").alias("a"), F.col("node").alias("b"))
                      .agg(F.count(F.lit(1)).alias("shared")), "near-pairs")
        side = lambda s: self.nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"r_{s}"))
        fit = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        sized = (pairs.join(side("b"), "b").join(side("a"), "a").filter(fit)
                 .select("a", "b", "shared", "n_a", "n_b", "r_a", "r_b"))
        return stage(sized.mapInArrow(_promising(self.percent / 100), "a long, b long, shared long"), "near-candidates")

    def full(self, wanted: DataFrame) -> DataFrame:
        """(node, members) for the nodes of ``wanted`` (node), from their whole texts."""
        wanted = stage(wanted.distinct().join(self.nodes.select("node", "rep", "set_key"), "node"), "near-wanted")
        ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted
        got = self.texts.join(ids, F.col("doc_id") == F.col("rep")).select("node", "set_key", "text")
        return stage(got.mapInArrow(_full_sets(self.words), "node long, members binary"), "near-sets")

    def verify(self, pairs: DataFrame, sets: DataFrame) -> None:
        """Fold those of ``pairs`` (a, b) that are linked into the components so far."""
        side = lambda s: sets.select(F.col("node").alias(s), F.col("members").alias(f"m_{s}"))
        both = pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "m_a", "m_b")
        links = stage(both.mapInArrow(_linked(self.percent), "a long, b long"), "near-links")
        if self.labels is None:
            self.labels = components(links)
        elif not links.isEmpty():
            merged = stage(components(self.contracted(links).select("c_a", "c_b").toDF("a", "b")), "near-merged")
            kept = (self.labels.join(merged.toDF("component", "up"), "component", "left")
                    .select("node", F.coalesce("up", "component").alias("component")))
            alone = merged.join(self.labels.select("node"), "node", "left_anti").select("node", "component")
            self.labels = stage(kept.unionByName(alone), "near-labels")

    def contracted(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) with the components of their ends, c_a and c_b; a node without links is its own."""
        side = lambda s: self.labels.select(F.col("node").alias(s), F.col("component").alias(f"c_{s}"))
        return (pairs.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
                .withColumns({"c_a": F.coalesce("c_a", "a"), "c_b": F.coalesce("c_b", "b")}))

    def across(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` whose ends lie in different components."""
        return self.contracted(pairs).filter("c_a <> c_b").select("a", "b")

    def unresolved(self, members: DataFrame) -> DataFrame:
        """(node, component, n) of keys with three nodes or more in several components."""
        told = (members.filter("size > 2").join(self.labels, "node", "left")
                .withColumn("component", F.coalesce("component", "node")))
        told = stage(told.select("key", "node", "n", "component"), "near-told")
        keys = (told.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                        F.count(F.lit(1)).alias("k")).filter("lo <> hi").select("key"))
        return told.join(stage(keys, "near-open"), "key").select("node", "component", "n").distinct()

    def prefix_pairs(self, open_nodes: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of open nodes in different components that share a prefix shingle (exact)."""
        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for node, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                    s = np.frombuffer(held.as_buffer(), "<i8")
                    yield pa.record_batch([pa.array(np.full(len(s), node)), pa.array(s)], names=["node", "shingle"])

        tokens = sets.mapInArrow(spread, "node long, shingle long")
        common = stage(tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "near-common")
        seen = stage(tokens.join(common, "shingle").join(open_nodes, "node"), "near-tokens")
        # Shingles of one set only come first and match nothing; the others' places follow them.
        order = Window.partitionBy("node").orderBy("df", "shingle")
        count = Window.partitionBy("node")
        placed = (seen.withColumn("place", F.row_number().over(order) - 1 + F.col("n") - F.count(F.lit(1)).over(count))
                  .withColumn("prefix", F.col("n") - F.ceil(F.col("n") * self.percent / 100.0) + 1).filter("place < prefix"))
        posts = stage(placed.select("shingle", "node", "component", "n", "place"), "near-postings")
        several = stage(posts.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                        .filter("lo <> hi").select("shingle"), "near-several")
        posts = stage(posts.join(several, "shingle"), "near-postings")
        x, y = posts.alias("x"), posts.select(*[F.col(c).alias(f"{c}2") for c in posts.columns])
        fit = ((F.col("shingle") == F.col("shingle2")) & (F.col("node") < F.col("node2")) & (F.col("component") != F.col("component2"))
               & (100 * F.least("n", "n2") >= self.percent * F.greatest("n", "n2"))
               & ((100 + self.percent) * F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2"))
                  >= self.percent * (F.col("n") + F.col("n2"))))
        return x.join(y, fit).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()

    def run(self) -> DataFrame:
        members = self.members()
        pairs = self.candidates(members)
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
        sets = self.full(nodes)
        best = pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")
        self.verify(best, sets)
        self.verify(self.across(pairs), sets)
        open_nodes = stage(self.unresolved(members), "near-open-nodes")
        if not open_nodes.isEmpty():
            rest = self.full(open_nodes.select("node"))
            self.verify(self.prefix_pairs(open_nodes, rest), rest)
        named = self.nodes.select("set_key", "node", "rep").join(self.labels, "node", "left")
        told = stage(named.withColumn("component", F.coalesce("component", "node")), "near-named")
        least = told.groupBy("component").agg(F.min("rep").alias("component_id"))
        classes = stage(told.join(stage(least, "near-least"), "component").select("set_key", "component_id"), "near-classes")
        out = self.sigs.select("doc_id", "n", "set_key").join(classes, "set_key", "left")
        root = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        return out.select("doc_id", F.col("n").alias("n_shingles"), root.alias("component_id"),
                          F.col("doc_id").eqNullSafe(root).alias("kept"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    if not 50 <= percent <= 100:
        raise ValueError("the bands are set for similarities of 50 percent or more")
    with _small_batches(docs.sparkSession):  # every step that sends rows to Python is written inside
        return _Classes(docs, words, percent, id_col, text_col).run()


def keep_rows(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id stays, with their own columns. An id with several texts stays if one of them does."""
    classes = near_duplicates(docs, words, percent, id_col, text_col)
    gone = (classes.groupBy("doc_id").agg(F.max(F.col("kept").cast("int")).alias("stays")).filter("stays = 0")
            .select(F.col("doc_id").alias("_gone_id")))
    return docs.join(gone, F.col(id_col).cast("long") == F.col("_gone_id"), "left_anti")
