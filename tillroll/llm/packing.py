"""Best-two-fit packing of tokenised documents into fixed-length sequences.

A task tokenises its rows: the byte-level pre-tokens of a text are looked up in
a bounded cache and only those not in it are split into ids. Only documents longer than a
sequence are cut, into full pieces; the first piece takes the remainder.

Pieces are dealt at random into groups of about ``group_pieces`` rows, packed
independently and in parallel: a group's memory is bounded, and it wastes at
most about one sequence. Where the documents have an order to keep, groups are
runs of neighbours in it. In a group, a bin takes the longest piece, then the
longest that still fits, and so on. If room is left, the bin's smallest piece is
replaced by two unpacked pieces that fit the expanded gap more tightly.

Defined results: NULL text counts as empty and packs as the lone end id. Rows
that repeat an id are packed each. Pieces of equal length are interchangeable
and taken in the order of id and piece. An empty table gives an empty result.
Only the id and text columns are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, stage, text_of

#: The byte-level vocabulary's pre-token pattern, for texts with no character above U+024F
#: (letters, numbers and white space of that range), and for others.
LATIN = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"

#: Pre-tokens that each of a worker's two cache generations holds.
CACHE_WORDS = 150_000

_STATE: dict = {}


def _patterns():
    import regex
    letter, number, space = LATIN
    latin = re.compile(f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[^{letter}{number}{space}]+"
                       f"|[{space}]+(?![^{space}])|[{space}]+")
    wide = regex.compile(CONTRACTIONS + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    return latin, wide, re.compile("[^\x00-ɏ]")


def _word_encoder(path: str):
    """word -> ids for the tokenizer file at ``path``.

    In a byte-level BPE whose merges stand in the order of their ids, a merge's
    rank is its id, which is all that tiktoken needs: the ids are the same and a
    word takes a tenth of the time. Any other file goes to ``tokenizers`` itself.
    """
    import tiktoken
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the format writes as themselves
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(
        b for b in range(256) if b not in visible)}
    if all(vocab.get(c, 256) < 256 for c in byte_of) and all(
            vocab.get(m.replace(" ", "", 1)) == 256 + i for i, m in enumerate(merges)):
        ranks = {bytes(map(byte_of.__getitem__, word)): i for word, i in vocab.items() if i < 256 + len(merges)}
        core = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        return core.encode_ordinary
    whole = Tokenizer.from_file(path)
    return lambda word: whole.encode(word, add_special_tokens=False).ids


class _Encoder:
    """Text -> token ids as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        self.path, self.whole = path, None
        self.encode = _word_encoder(path)
        with open(path, encoding="utf-8") as f:
            self.added = [token["content"] for token in json.load(f).get("added_tokens") or []]
        self.latin, self.wide, self.above = _patterns()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.added):  # read as one id: words are cut around it by its own rules
            if self.whole is None:  # few workers ever see such a text
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.path)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = (self.wide if self.above.search(text) else self.latin).findall(text)
        young = self.young
        try:
            return b"".join(map(young.__getitem__, words))
        except KeyError:
            pass
        if len(young) > CACHE_WORDS:
            self.old, self.young = young, {}
            young = self.young
        for word in set(words).difference(young):
            young[word] = self.old.get(word) or np.array(self.encode(word), "<u4").tobytes()
        return b"".join(map(young.__getitem__, words))


def _encoder(path: str) -> _Encoder:
    if path not in _STATE:
        _STATE[path] = _Encoder(path)
    return _STATE[path]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, n, size)]


def _tokenise(path: str, size: int, end_id: int, with_ids: bool, order: list[str]):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = _encoder(path), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            of: list[int] = []
            for at, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                coded = encoder.ids(text) + tail
                for k, (start, length) in enumerate(cut(len(coded) // 4, size)):
                    own = coded[4 * start:4 * (start + length)]
                    rows.append((doc, k, start, length, zlib.crc32(own), own if with_ids else None))
                    of.append(at)
            cols = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            keep = 6 if with_ids else 5
            along = [batch.column(2 + i).take(pa.array(of, pa.int64())) for i in range(len(order))]
            yield pa.record_batch([*(pa.array(c, t) for c, t in zip(cols[:keep], types)), *along], names=names[:keep] + order)
    return pieces


def tokenise(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
             text_col: str = "text", with_ids: bool = False, order: dict[str, Column] | None = None) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked, the ids (32-bit, little-endian);
    the columns of ``order`` go along."""
    order = order or {}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), *[c.alias(n) for n, c in order.items()])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    schema += "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[2:])
    return rows.mapInArrow(_tokenise(tokenizer, size, end_id, with_ids, list(order)), schema)


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, none above ``size``."""
    left = np.bincount(lengths, minlength=size + 1)
    bins: list[list[int]] = []
    while left.any():
        here = np.flatnonzero(left)
        room, held = size, []
        while len(here):  # greedy: the longest that fits
            at = int(np.searchsorted(here, room, "right")) - 1
            if at < 0:
                break
            x = int(here[at])
            times = min(int(left[x]), room // x) if x else int(left[x])
            held += [x] * times
            left[x] -= times
            room -= times * x
            here = here[:at]
        if room and held:
            small = held[-1]
            gap = room + small
            here = np.flatnonzero(left)
            here = here[(here > 0) & (here < gap)]
            best = small
            if len(here) and 2 * int(here[-1]) > small:
                mates = here[np.maximum(0, np.searchsorted(here, gap - here, "right") - 1)]
                sums = here + mates
                ok = (sums <= gap) & (mates >= here) & ((mates != here) | (left[here] > 1))
                equal = np.flatnonzero((sums <= gap) & (mates == here) & (left[here] < 2))
                for e in equal:  # a lone length can't pair with itself: the next shorter mate
                    if e > 0:
                        mates[e] = here[e - 1]
                        sums[e] = here[e] + here[e - 1]
                        ok[e] = True
                if ok.any():
                    pick = int(np.argmax(np.where(ok, sums, -1)))
                    best = int(sums[pick])
                    if best > small:
                        held[-1:] = [int(mates[pick]), int(here[pick])]
                        left[small] += 1
                        left[here[pick]] -= 1
                        left[mates[pick]] -= 1
        bins.append(held)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(lengths, kind="stable")
    starts = np.searchsorted(lengths[order], np.arange(size + 1))
    for b, held in enumerate(bins):
        at = 0
        for x in held:
            row = order[starts[x]]
            starts[x] += 1
            number[row], offset[row] = b, at
            at += x
    return number, offset


def _pack(size: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("piece", "ascending")])
        bins, offset = best_two_fit(group.column("length").to_numpy(), size)
        base = group.column("pack_group")[0].as_py() << 32
        return group.drop_columns(["pack_group"]).append_column(
            "sequence_id", pa.array(bins + base, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))
    return pack


def pack(pieces: DataFrame, size: int = 1024, group_pieces: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...; a table that is cheap to read again) with sequence_id and offset."""
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("pack_group").applyInArrow(_pack(size), schema)


def _pack_runs(size: int, group_pieces: int, dropped: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of ``group_pieces`` rows of a sorted partition, packed each; sequences are numbered in order."""
        held, rows, at = [], 0, TaskContext.get().partitionId() << 32

        def packed(run: pa.Table) -> list[pa.RecordBatch]:
            nonlocal at
            bins, offset = best_two_fit(run.column("length").to_numpy(), size)
            out = run.drop_columns(dropped).append_column("sequence_id", pa.array(bins + at, pa.int64())).append_column(
                "offset", pa.array(offset, pa.int64()))
            at += int(bins.max()) + 1
            return out.to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= group_pieces:
                whole = pa.Table.from_batches(held)
                yield from packed(whole.slice(0, group_pieces))
                held, rows = whole.slice(group_pieces).to_batches(), rows - group_pieces
        if rows:
            yield from packed(pa.Table.from_batches(held))
    return run


def pack_in_order(pieces: DataFrame, order: list[str], size: int = 1024, group_pieces: int = 4096) -> DataFrame:
    """As ``pack``, but groups are runs of neighbours in ``order`` and sequence ids follow it, so that what the order
    mixes stays mixed; the order's columns are dropped."""
    keys = [*order, "piece"]
    kept = [f for f in pieces.schema if f.name not in order]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    return (pieces.repartitionByRange(partitions(pieces.sparkSession), *keys).sortWithinPartitions(*keys)
            .mapInArrow(_pack_runs(size, group_pieces, order), schema))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, order: dict[str, Column] | None = None) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place. With ``order`` (name -> column, in turn; no name of a
    piece's column) sequences follow that order of the documents, else documents are dealt at random."""
    pieces = stage(tokenise(docs, tokenizer, size, end_id, id_col, text_col, with_ids, order), "pack-pieces")
    return pack_in_order(pieces, list(order), size) if order else pack(pieces, size)
