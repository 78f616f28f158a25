"""Removal of long repeated passages, found by anchors at the positions of a difference cover.

A window is WINDOW consecutive words of a document; every word that a window covers is removed if the same
words also start earlier, in a document of a smaller id or further up in the same one.

COVER is a difference cover modulo PERIOD: for any two positions there is a shift below PERIOD that takes
both into the cover.  So if two windows of WINDOW words are equal, some ANCHOR = WINDOW - PERIOD + 1 words
in both, at the same shift and at cover positions of their documents, are equal too.

1. Anchors at cover positions (4 of 13) are hashed; those whose hash occurs twice mark the windows around
   them.  Documents without such an anchor are finished.
2. Marked windows are extended: all their WINDOW words are hashed, and of equal ones all but the earliest
   are repeated.
3. Words covered by repeated windows are removed.

Equal hashes are settled within a task first, and a task sends one position for each of them, its earliest.
So a passage that a third of all documents share makes one entry a task in the shuffle, and both shuffles
by hash are even.  Hashes travel sorted and packed, a row for each range of hashes (BUCKETS a shuffle
partition), and are compared range by range; a range of too many rows is unpacked in parts.  What tasks settle by themselves travels as packed positions.
Texts are shuffled once, by doc_id, and that exchange serves steps 2 and 3.

Windows are compared by 64-bit hashes of all their words.

Defined results: a null or empty text has no words.  Rows with a null doc_id come after all others (they are
given the largest long, which is no valid doc_id here).  Rows
that repeat a doc_id are told apart by a hash of their text, in the order of that hash; rows repeated
entirely count as one document, and each of them is returned with its result.  Further columns don't
matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.llm.common import table
from recordspark.llm.packed import pack, pack_buckets, runs, unpack, unpack_bucket
from recordspark.llm.words import Words, grams, mix, pieces, split

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Bits of an anchor's hash.  Anchors only mark windows, so a chance collision costs work and nothing else.
ANCHOR_BITS = 48
#: Positions that a task holds before it sends them on.
HELD = 1 << 21
_IN_COVER = np.zeros(PERIOD, dtype=bool)
_IN_COVER[list(COVER)] = True
#: Ranges of hashes for each shuffle partition.
BUCKETS = 4
#: bucket: range of hashes; packed: hashes and positions; or doc, part and known: settled positions of a document.
ROWS = "bucket int, packed binary, doc long, part long, known binary"
#: slot: a share of the documents, one for each shuffle partition; packed: documents and settled positions in it.
SETTLED = "slot int, packed binary"
FOUND = "doc long, part long, found binary"


def pack_positions(at: np.ndarray) -> bytes:
    """Ascending positions as differences, which repeat where positions do."""
    return np.diff(at, prepend=0).astype(np.int32).tobytes()


def _in_order(key, doc, part, at):
    """Sorted by hash and then from early to late, without doubles (rows repeated entirely are one document)."""
    order = np.lexsort((at, part, doc, key))
    key, doc, part, at = key[order], doc[order], part[order], at[order]
    again = np.zeros(len(key), dtype=bool)
    again[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1]) & (part[1:] == part[:-1]) & (at[1:] == at[:-1])
    return (x[~again] for x in (key, doc, part, at)) if again.any() else (key, doc, part, at)


def _firsts(key: np.ndarray, everyone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: which come first, and which are settled (of several equal ones, all or all but the first)."""
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    if not everyone:
        return first, ~first
    group = np.cumsum(first) - 1
    return first, np.bincount(group)[group] > 1 if len(key) else first


def _settled(doc: np.ndarray, part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Positions gathered by document: doc, part and packed positions."""
    if not len(doc):
        return doc, part, []
    order = np.lexsort((at, part, doc))
    doc, part, at = doc[order], part[order], at[order]
    starts = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]))))
    return doc[starts], part[starts], [pack_positions(at[a:z]) for a, z in zip(starts, np.append(starts[1:], len(doc)), strict=True)]


class _Sender:
    """Collects hashed positions of documents; sends the earliest of each hash, and settles the rest.

    everyone: whether the earliest of several is settled as well (anchors), or only the later ones (windows).
    """

    def __init__(self, everyone: bool, buckets: int):
        self.everyone, self.buckets, self.n, self.kept = everyone, buckets, 0, []

    def add(self, key: np.ndarray, doc: np.ndarray, part: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.kept.append((key, doc, part, at))
        self.n += len(key)
        if self.n >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        key, doc, part, at = _in_order(*(np.concatenate(x) for x in zip(*self.kept, strict=True)))
        self.n, self.kept = 0, []
        first, settled = _firsts(key, self.everyone)
        known = _settled(doc[settled], part[settled], at[settled])
        key, doc, part, at = key[first], doc[first], part[first], at[first]
        bucket, packed = pack_buckets(key, 64, self.buckets, doc.astype(np.int64), part.astype(np.int64), at.astype(np.int64))
        n = len(packed)
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(packed, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], ["bucket", "packed", "doc", "part", "known"])
        doc, part, lists = known
        # any bucket does for what is settled; by the place too, as very many rows may have no doc_id
        dealt = (mix(doc.view(np.uint64) ^ mix(part.view(np.uint64) + np.arange(len(doc), dtype=np.uint64))) % np.uint64(self.buckets)).astype(np.int32)
        for i in range(0, len(doc), 1 << 14):
            s = slice(i, i + (1 << 14))
            n = len(doc[s])
            yield pa.RecordBatch.from_arrays([pa.array(dealt[s]), pa.nulls(n, pa.binary()), pa.array(doc[s]), pa.array(part[s]), pa.array(lists[s], pa.binary())], ["bucket", "packed", "doc", "part", "known"])


def compare(batches: Iterator[pa.RecordBatch], everyone: bool, slots: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """ROWS sorted by bucket to what is settled: within the tasks, and between them in each range of hashes."""
    held, size = [], 0

    def send() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        if held:
            doc, part, at = (np.concatenate(x).astype(np.int64) for x in zip(*held, strict=True))
            slot = ((mix(doc.view(np.uint64) ^ mix(part.view(np.uint64))) >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((at, part, doc, slot))
            slot, doc, part, at = slot[order], doc[order], part[order], at[order]
            starts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1]))) if len(slot) else np.zeros(0, dtype=np.int64)
            ends = np.append(starts[1:], len(slot)) if len(slot) else starts
            packed = [pack(doc[a:z], part[a:z], at[a:z]) for a, z in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(slot[starts], pa.int32()), pa.array(packed, pa.binary())], ["slot", "packed"])
        held, size = [], 0

    def ranges() -> Iterator[pa.RecordBatch]:
        """The rows of hashes; those of documents are put with what is settled."""
        nonlocal size
        for b in batches:
            whole = b.filter(b.column(4).is_valid())
            for doc, part, known in zip(*(whole.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                at = np.cumsum(np.frombuffer(known, dtype=np.int32))
                held.append((np.full(len(at), doc), np.full(len(at), part), at))
                size += len(at)
            rest = b.filter(b.column(1).is_valid())
            yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1)], ["bucket", "packed"])

    for bucket, packed in runs(ranges()):
        for columns in unpack_bucket(bucket, packed, 4, 64, buckets):
            key, doc, part, at = _in_order(*columns)
            _, settled = _firsts(key, everyone)
            held.append((doc[settled], part[settled], at[settled]))
            size += int(settled.sum())
            if size >= HELD:
                yield from send()
    yield from send()


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SETTLED rows sorted by slot to one row a document with all its positions."""
    for _, packed in runs(batches):
        columns = [unpack(p, 3) for p in packed]
        doc, part, lists = _settled(*(np.concatenate([c[i] for c in columns]) for i in range(3)))
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(part), pa.array(lists, pa.binary())], ["doc", "part", "found"])


def _whole(words: Words, n: int) -> np.ndarray:
    """The positions (in all words) at which n words of one text begin."""
    text = words.texts_of_words()
    m = len(text) - n + 1
    return np.flatnonzero(text[:m] == text[n - 1 :]) if m > 0 else np.zeros(0, dtype=np.int64)


def _documents(b: pa.RecordBatch, a: int, z: int) -> tuple[np.ndarray, np.ndarray]:
    return b.column(0).slice(a, z - a).to_numpy(), b.column(1).slice(a, z - a).to_numpy()


def anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Step 1: (doc, part, text) rows to hashed cover positions.  Documents below WINDOW words have none."""
    sender = _Sender(True, buckets)
    for b in batches:
        for a, z, data, offsets in pieces(b, "text"):
            doc, part = _documents(b, a, z)
            words = split(data, offsets)
            text = words.texts_of_words()
            at = np.arange(len(text)) - words.first[text]
            start = _whole(words, ANCHOR)
            start = start[_IN_COVER[at[start] % PERIOD] & (words.counts[text[start]] >= WINDOW)]
            key = grams(words.hashes(), ANCHOR)[start] if len(start) else np.zeros(0, dtype=np.uint64)
            key = key >> np.uint64(64 - ANCHOR_BITS) << np.uint64(64 - ANCHOR_BITS)
            yield from sender.add(key, doc[text[start]], part[text[start]], at[start])
    yield from sender.flush()


def marked_windows(words: Words, anchors_at: np.ndarray) -> np.ndarray:
    """All-words positions of the windows that hold a marked anchor at a shift below PERIOD."""
    start = _whole(words, WINDOW)
    if not len(anchors_at):
        return start[:0]
    marks = np.zeros(len(words.start) + 1, dtype=np.int64)
    marks[anchors_at + 1] = 1
    upto = np.cumsum(marks)
    return start[upto[np.minimum(start + PERIOD, len(words.start))] > upto[start]]


def _positions(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and position of packed positions."""
    none = np.zeros(0, dtype=np.int64)
    arrays = [np.cumsum(np.frombuffer(p, dtype=np.int32)) if p else none for p in column.to_pylist()]
    return np.repeat(np.arange(len(arrays)), [len(x) for x in arrays]), np.concatenate(arrays) if arrays else none


def windows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Step 2: (doc, part, text, found) rows to the hashes of marked windows."""
    sender = _Sender(False, buckets)
    for b in batches:
        row, at = _positions(b.column(3))
        for a, z, data, offsets in pieces(b, "text"):
            doc, part = _documents(b, a, z)
            words = split(data, offsets)
            own = (row >= a) & (row < z)
            start = marked_windows(words, words.first[row[own] - a] + at[own])
            text = words.texts_of_words()[start]
            key = grams(words.hashes(), WINDOW)[start] if len(start) else np.zeros(0, dtype=np.uint64)
            yield from sender.add(key, doc[text], part[text], start - words.first[text])
    yield from sender.flush()


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def removed(batches: Iterator[pa.RecordBatch], texts: bool = False) -> Iterator[pa.RecordBatch]:
    """Step 3: (doc, part, text, doc_id, found) rows to results; texts: with the text that is left instead of its digest."""
    for b in batches:
        row, at = _positions(b.column(4))
        for a, z, data, offsets in pieces(b, "text"):
            words = split(data, offsets)
            own = (row >= a) & (row < z)
            gone = np.zeros(len(words.start) + 1, dtype=np.int64)
            start = words.first[row[own] - a] + at[own]
            np.add.at(gone, start, 1)
            np.add.at(gone, start + WINDOW, -1)
            left = np.cumsum(gone)[:-1] == 0
            first = words.first
            kept = np.concatenate(([0], np.cumsum(left)))
            out = []
            for i in range(z - a):
                f, l = first[i], first[i + 1]
                if kept[l] - kept[f] == l - f and l > f and not texts:
                    whole = b" ".join(data[offsets[i] : offsets[i + 1]].tobytes().split())
                else:
                    whole = b" ".join(words.word(j) for j in f + np.flatnonzero(left[f:l]))
                out.append(whole.decode() if texts else hashlib.sha256(whole).hexdigest())
            n = words.counts
            yield pa.RecordBatch.from_arrays([b.column(3).slice(a, z - a), pa.array(n.astype(np.int64)), pa.array((n - (kept[first[1:]] - kept[first[:-1]])).astype(np.int64)), pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _compared(rows: DataFrame, everyone: bool, slots: int, buckets: int) -> DataFrame:
    """doc, part and the packed positions that are settled, of each document that has any."""
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    settled = dealt.mapInArrow(lambda b: compare(b, everyone, slots, buckets), SETTLED)
    return settled.repartitionById(slots, F.col("slot")).sortWithinPartitions("slot").mapInArrow(gather, FOUND)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc, part and text (bytes).  part is 0 but for rows that share their doc_id, or have none."""
    last, none = F.lit((1 << 63) - 1), F.lit(0).cast("long")
    again = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    part = none
    if not again.isEmpty():
        again = again.select(F.col("doc_id").alias("_again"))
        docs = docs.join(again, F.col("doc_id").eqNullSafe(F.col("_again")) & F.col("doc_id").isNotNull(), "left")
        part = F.when(F.col("doc_id").isNull() | F.col("_again").isNotNull(), F.xxhash64("text")).otherwise(none)
    return docs.select(F.coalesce(F.col("doc_id"), last).alias("doc"), part.alias("part"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def deduplicate(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the digest (or text) of what is left, for every row of `docs`."""
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS * slots
    keyed = _keyed(docs.select("doc_id", "text"))
    marked = _compared(keyed.mapInArrow(lambda b: anchors(b, buckets), ROWS), True, slots, buckets)
    # the same exchange of texts stands below both joins
    dealt = keyed.repartition("doc", "part")
    candidates = dealt.join(marked.hint("shuffle_hash"), ["doc", "part"]).select("doc", "part", "text", "found")
    repeated = _compared(candidates.mapInArrow(lambda b: windows(b, buckets), ROWS), False, slots, buckets)
    joined = dealt.join(repeated.hint("shuffle_hash"), ["doc", "part"], "left")
    schema = RESULT.replace("kept_sha256", "text") if texts else RESULT
    rows = joined.select("doc", "part", "text", F.nullif("doc", F.lit((1 << 63) - 1)).alias("doc_id"), "found")
    return rows.mapInArrow(lambda b: removed(b, texts), schema)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
