"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text is cut into words (runs of letters, lower-cased, each letter to one
letter) with a space at both ends; its features are the 1- to 3-character
grams of letters and the spaces at a word's ends, hashed to ``BUCKETS``
buckets. Training counts (language, bucket) over every labelled row that is not
held out: a task sums whole batches into one row of counts per language, so
what is shuffled depends on the languages only. The matrix of log
probabilities, BUCKETS numbers per language, is broadcast; scoring adds its
entries per document by ``bincount``, batch by batch.

Text is worked on in slabs of ``SLAB`` characters, cut between words (a word
longer than a slab is cut inside), so memory depends on the batch, not on the
longest text.

Defined results: NULL texts and texts without a letter get ``und`` and score 0;
so does every text if no language was learned. A row whose id is NULL is not
held out and not learned from. Equal scores go to the first language in code
point order. The score is the chosen language's posterior probability. Repeated
rows count as often as they occur. Only the id, text and language columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Hash buckets, longest gram, characters at a time.
BUCKETS, LONGEST, SLAB = 1 << 16, 3, 1 << 20
#: The model's bound: languages times BUCKETS numbers of 8 bytes.
MAX_MODEL_BYTES = 1 << 28
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLES: list[np.ndarray] = []


def _lowered() -> np.ndarray:
    """Per code point: its lower-case form if it is a letter, else a space. Built once in a worker."""
    if not _TABLES:
        points = range(0x110000)
        table = np.fromiter((ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c) if c.isalpha() else 32
                             for c in map(chr, points)), np.uint32, len(points))
        _TABLES.append(table)
    return _TABLES[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every gram of ``texts``."""
    joined = " " + " ".join(texts) + " "
    owner = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    codes = _lowered()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter = codes != 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters
    keep[0] = True
    codes, letter = codes[keep].astype(np.uint64), letter[keep]
    owner = np.concatenate([[0], owner])[keep]  # the leading space
    documents, buckets = [], []
    for n in range(1, LONGEST + 1):
        windows = len(codes) - n + 1
        if windows <= 0:
            break
        use = letter[:windows].copy() if n == 1 else np.ones(windows, bool)
        for j in range(1, n - 1):
            use &= letter[j:j + windows]
        at = np.flatnonzero(use)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = (h ^ codes[at + j]) * _MIX
            h ^= h >> np.uint64(29)
        buckets.append((h >> np.uint64(48)).astype(np.int64))
        documents.append(owner[at + ~letter[at]])  # that of the gram's first letter
    return np.concatenate(documents), np.concatenate(buckets)


def slabs(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of the texts, with the places of their documents, of about SLAB characters together."""
    places, pieces, size = [], [], 0
    for place, text in enumerate(texts):
        start, text = 0, text or ""
        while start < len(text):
            end = min(len(text), start + SLAB)
            if end < len(text):
                cut = max(text.rfind(" ", start + 1, end), text.rfind("\n", start + 1, end))
                end = cut if cut > start else end
            places.append(place)
            pieces.append(text[start:end])
            size, start = size + end - start, end
            if size >= SLAB:
                yield places, pieces
                places, pieces, size = [], [], 0
    if pieces:
        yield places, pieces


@dataclass
class Model:
    """``languages`` in order, the log prior of each, and per language the log probability of each bucket."""
    languages: list[str]
    prior: np.ndarray
    weight: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, posterior) per text."""
        n, known = len(texts), len(self.languages)
        total, held = np.zeros((known, n)), np.zeros(n, np.int64)
        for places, pieces in slabs(texts):
            document, bucket = grams(pieces)
            document = np.asarray(places)[document]
            held += np.bincount(document, minlength=n)
            for k in range(known):
                total[k] += np.bincount(document, self.weight[k][bucket], n)
        if not known:
            return [UNKNOWN] * n, np.zeros(n)
        total += self.prior[:, None]
        best = total.argmax(0)
        share = 1.0 / np.exp(np.maximum(total - total[best, np.arange(n)], -700.0)).sum(0)
        return ([self.languages[b] if h else UNKNOWN for b, h in zip(best, held)], np.where(held > 0, share, 0.0))


def held_out(id_col: str = "doc_id"):
    """Rows that nothing may be learnt from: crc32 of the id's digits is 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        lang = np.array(batch.column(0).to_pylist(), object)
        texts = np.array(batch.column(1).to_pylist(), object)
        for name in sorted(set(lang)):
            own = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
            mine = texts[lang == name]
            rows[name] = rows.get(name, 0) + len(mine)
            for _, pieces in slabs(mine):
                own += np.bincount(grams(pieces)[1], minlength=BUCKETS)
    for name, own in counts.items():
        seen = np.flatnonzero(own)
        yield pa.record_batch([pa.array([name] * (len(seen) + 1)), pa.array(np.append(seen, -1), pa.int32()),
                               pa.array(np.append(own[seen], rows[name]), pa.int64())], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        smoothing: float = 0.5) -> Model:
    """Fit on all labelled rows outside the held-out third. Raises where the languages exceed the model's bound."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    most = MAX_MODEL_BYTES // (8 * BUCKETS)
    if rows.select("lang").distinct().limit(most + 1).count() > most:
        raise ValueError(f"{lang_col} holds more than {most} values, too many for a model of {MAX_MODEL_BYTES} bytes")
    counts = rows.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # as many rows as the model has numbers, at most
    lang, bucket, n = (table.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    languages = sorted(set(lang.tolist()))
    place = {name: k for k, name in enumerate(languages)}
    at = np.fromiter((place[x] for x in lang), np.int64, len(lang))
    seen, texts = np.zeros((len(languages), BUCKETS)), np.zeros(len(languages))
    seen[at[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    texts[at[bucket < 0]] = n[bucket < 0]
    seen += smoothing
    return Model(languages, np.log(texts / max(texts.sum(), 1.0)), np.log(seen / seen.sum(1, keepdims=True)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = shared.value.predict(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(answer, "doc_id long, held_out boolean, lang_pred string, score double")
