"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each sender (a block of rows inside one input partition) sorts the distinct
   64-bit fingerprints of its texts and cuts them by owner, a range of the
   fingerprint space. Per owner it packs one Golomb-coded packet; ids and
   SHA-256 digests stay beside it in the written packet table.
2. Only the codes are shuffled to the owners. An owner answers every packet
   with a bitmap: which of its fingerprints some other sender holds as well.
3. A sender adds the repeats that it has itself; the marked rows are suspects.
4. Only suspects' texts are grouped, by their bytes. A group of equal texts
   shrinks to one row per map task before the shuffle, so a text that fills a
   third of the table costs no more than another.

Defined results: NULL text counts as empty. The row with the largest id stays;
a NULL id is below every id. Rows that repeat an id with an equal text are one
document listed several times: each carries the same decision, and
``keep_rows`` returns it once. An empty table gives an empty result. Only the
id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import golomb
from .common import partitions, stage, text_of

#: Rows that one sender sorts at a time: bounds a task's memory, whatever the partition's size.
SENDER_ROWS = 1 << 18

PACKET = ("sender long, owner int, n int, k int, code binary, local binary, "
          "runs binary, ids binary, known binary, digests binary")


def _owner_low(owner: int, owners: int) -> int:
    return -(-(owner << 32) // owners) << 32


def _packets(sender: int, ids: np.ndarray, known: np.ndarray, digests: np.ndarray, owners: int) -> pa.RecordBatch:
    """One sender's packets. ``runs`` holds how many rows each fingerprint has."""
    prints = digests[:, :8].copy().view(">u8").ravel().astype(np.uint64)
    order = np.argsort(prints, kind="stable")
    prints, ids, known, digests = prints[order], ids[order], known[order], digests[order]
    distinct, first, runs = np.unique(prints, return_index=True, return_counts=True)
    owner = (((distinct >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(owner, prepend=-1, append=owners))
    rows = {name: [] for name in ("sender", "owner", "n", "k", "code", "local", "runs", "ids", "known", "digests")}
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        o = int(owner[a])
        lo, span = _owner_low(o, owners), (1 << 64) // owners
        k = golomb.parameter(span, b - a)
        x, y = int(first[a]), int(first[b]) if b < len(first) else len(ids)
        for name, value in (("sender", sender), ("owner", o), ("n", b - a), ("k", k),
                            ("code", golomb.encode(distinct[a:b], lo, k)),
                            ("local", np.packbits(runs[a:b] > 1).tobytes()),
                            ("runs", runs[a:b].astype("<u4").tobytes()), ("ids", ids[x:y].tobytes()),
                            ("known", np.packbits(known[x:y]).tobytes()), ("digests", digests[x:y].tobytes())):
            rows[name].append(value)
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()] + [pa.binary()] * 6
    return pa.record_batch([pa.array(rows[c], t) for c, t in zip(rows, types)], names=list(rows))


def _sender(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            ids, known, digests = (np.concatenate(x) for x in zip(*held))
            return _packets((part << 32) | block, ids, known, digests, owners)

        for batch in batches:
            for at in range(0, batch.num_rows, SENDER_ROWS):
                cut = batch.slice(at, SENDER_ROWS)
                ids, sha = cut.column(0), cut.column(1)
                known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False))
                held.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), known,
                             np.frombuffer(b"".join(sha.to_pylist()), np.uint8).reshape(-1, 32)))
                rows += cut.num_rows
                if rows >= SENDER_ROWS:
                    yield flush()
                    held, rows, block = [], 0, block + 1
        if rows:
            yield flush()
    return send


def _owner(owners: int):
    def answer(packets: pa.Table) -> pa.Table:
        owner = packets.column("owner")[0].as_py()
        low = _owner_low(owner, owners)
        sent = [golomb.decode(c, n, low, k) for c, n, k in zip(
            packets.column("code").to_pylist(), packets.column("n").to_pylist(), packets.column("k").to_pylist())]
        values, counts = np.unique(np.concatenate(sent), return_counts=True)
        shared = values[counts > 1]
        maps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in sent]
        return pa.table({"sender": packets.column("sender"), "owner": packets.column("owner"),
                         "bitmap": pa.array(maps, pa.binary())})
    return answer


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sender's rows again, with the owner's bitmap and its own repeats applied."""
    for batch in batches:
        ids, known, suspect, digests = [], [], [], []
        for row in batch.to_pylist():
            runs = np.frombuffer(row["runs"], "<u4")
            marks = (np.unpackbits(np.frombuffer(row["bitmap"], np.uint8), count=row["n"])
                     | np.unpackbits(np.frombuffer(row["local"], np.uint8), count=row["n"]))
            own = np.frombuffer(row["ids"], "<i8")
            ids.append(own)
            known.append(np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(own)))
            suspect.append(np.repeat(marks, runs))
            digests.append(row["digests"])
        if not ids:
            continue
        blob = b"".join(digests)
        sha = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(blob) // 32, [None, pa.py_buffer(blob)])
        yield pa.record_batch([pa.array(np.concatenate(ids), pa.int64(), mask=np.concatenate(known) == 0),
                               sha.cast(pa.binary()), pa.array(np.concatenate(suspect).astype(bool))],
                              names=["id", "sha", "suspect"])


def mark_suspects(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sha, suspect) for every row, by the fingerprint exchange; a written table."""
    owners = partitions(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(text_of(text_col), 256)).alias("sha"))
    packets = stage(keyed.mapInArrow(_sender(owners), PACKET), "dedup-packets")
    bitmaps = (packets.select("sender", "owner", "n", "k", "code").groupBy("owner")
               .applyInArrow(_owner(owners), "sender long, owner int, bitmap binary"))
    answered = packets.drop("code", "k").join(bitmaps, ["sender", "owner"])
    return stage(answered.mapInArrow(_unpack, "id long, sha binary, suspect boolean"), "dedup-marks")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256."""
    marks = mark_suspects(docs, id_col, text_col)
    suspects = marks.filter("suspect")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("bytes"))
    ids = suspects.select(F.col("id").alias("s"))
    held = texts.join(ids, F.col("id").eqNullSafe(F.col("s")), "left_semi")
    equal = held.groupBy("bytes").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = stage(equal.select(F.unhex(F.sha2("bytes", 256)).alias("sha"), "keep_id", "group_size"), "dedup-classes")
    out = (F.col("id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
           F.lower(F.hex("sha")).alias("text_sha256"))
    shared = suspects.join(classes, "sha").select(*out)
    alone = (marks.filter("not suspect")
             .withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long")}).select(*out))
    return alone.unionByName(shared)


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; one row per id and text. Where an id and text repeat
    with other values in other columns, the row whose other columns come first as JSON stays."""
    gone = exact_dedup(docs, id_col, text_col).filter("not kept").select(
        F.col("id").alias("_gone_id"), F.unhex("text_sha256").alias("_gone_sha")).distinct()
    same = (F.col(id_col).cast("long").eqNullSafe(F.col("_gone_id"))
            & (F.unhex(F.sha2(text_of(text_col), 256)) == F.col("_gone_sha")))
    kept = docs.join(gone, same, "left_anti")
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    if not rest:
        return kept.dropDuplicates([id_col, text_col])
    others = F.struct(*[F.col(f"`{c}`") for c in rest])
    one = kept.groupBy(id_col, text_col).agg(F.min_by(others, F.to_json(others)).alias("_others"))
    return one.select(*[F.col(f"`{c}`") if c in (id_col, text_col) else F.col(f"_others.`{c}`") for c in docs.columns])
