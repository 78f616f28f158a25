"""Exact n-gram Jaccard self-join, as classes of linked documents, by set-relation skipping.

A document is the set of its distinct shingles of N words (lower-cased A-Z; one shingle of all words where
there are fewer).  Two documents link when their Jaccard similarity is at least 80 %.  Equal sets are one
node.

1. Filter.  In the order of their hashes, two linked sets share the first elements of what they share
   within their first 20 % + EXTRA (`prefix`), so a linked set has EXTRA * 80 % of its size of those in other
   nodes as well.  Nodes that haven't are finished.  These elements travel sorted and packed, a row for each
   range of hashes; of equal ones within a task, one is sent.
2. One row of each node that passes is read again for its whole set; sets are never shuffled to find
   equal ones.
3. Elements are ordered by how many nodes have them, the rare ones first; a node is listed under the elements
   of its prefix, with its size and the element's position.  An element that only one node has lists nothing.
4. Index lists.  In each list one set leads, the one with the largest share of repeated elements.  Its
   overlap with each member is computed.  From these answers those between two members of the list are
   derived: with the leader L, |a & b| is at most min(|a & L|, |b & L|) + min(|a - L|, |b - L|) and at least
   |a & L| + |b & L| - |L|, which mostly settles the pair without a look at it.
5. What is left are pairs in different components that share a list.  A list is cut into blocks by size and
   by what remains behind the element's position.  A set meets the blocks of sets that are no larger, but for
   those in which too little remains to reach its own size: they are skipped as a whole.  The pairs that
   bounds don't settle are verified.
6. Components of all links.

A leader makes one pair a member.  Beyond that only members of different components in blocks within reach
meet.  Lists of more than LIST_CELL nodes are dealt to several tasks, in a grid where pairs meet, and so are
the sets that many pairs name.  Counts are partial before shuffles, and there is no cap anywhere.  Sets are
compared by 64-bit hashes of shingles, and nodes are 64-bit hashes of sets.

Defined results: a null or empty text has no shingles and is its own component.  A row with a null doc_id
links with nothing and has a null component.  Rows that repeat a doc_id are one vertex each (with the same
id) and all are returned.  Further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.llm.common import cut, table
from recordspark.llm.components import components
from recordspark.llm.packed import pack_buckets, runs, unpack_bucket
from recordspark.llm.words import Words, grams, mix, pieces, split

N = 5
#: Filter: this share of a set is looked at beyond the 20 % that linked sets may differ in.
EXTRA_PERCENT = 10
#: Bits of a shingle's hash and of a node's in the filter, where a chance collision costs work and nothing else.
FILTER_BITS, REF_BITS = 48, 40
#: Shingles that a task holds before it sends them on; ranges of hashes for each shuffle partition.
HELD, BUCKETS = 1 << 20, 4
#: Nodes (or other longs) are broadcast up to this many (8 to 16 bytes each), and shuffled beyond.
BROADCAST_IDS = 4_000_000
#: Nodes of a list that one task gets; longer lists are dealt to several.
LIST_CELL = 512


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted by text and hash; and the ends of the texts' runs."""
    hashes = words.hashes()
    n, rows = words.counts, len(words.counts)
    text = words.texts_of_words()
    m = len(text) - N + 1
    start = np.flatnonzero(text[:m] == text[N - 1 :]) if m > 0 else np.zeros(0, dtype=np.int64)
    key, owner = grams(hashes, N)[start] if len(start) else np.zeros(0, dtype=np.uint64), text[start]
    short = np.flatnonzero((n > 0) & (n < N))
    whole = np.array([mix(grams(hashes[words.first[i] : words.first[i + 1]], int(n[i])) + np.uint64(n[i]))[0] for i in short], dtype=np.uint64)
    key, owner = np.concatenate([key, whole]), np.concatenate([owner, short])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[keep], owner[keep]
    return key, np.searchsorted(owner, np.arange(rows + 1))


def nodes_of(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each set; `first` has the ends of their runs in `key`."""
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(key), dtype=np.uint64)))
    return mix((total[first[1:]] - total[first[:-1]]) + np.diff(first).astype(np.uint64))


def slack(n):
    """How many elements of a set of n a linked set may lack."""
    return n - (80 * n + 99) // 100


def prefix(n):
    return np.minimum(n, slack(n) + np.maximum(1, (EXTRA_PERCENT * n + 99) // 100))


def needed() -> Column:
    """Repeated elements in the prefix of a linked set of n: as many as the smaller set's extra part."""
    return F.greatest(F.lit(1), F.ceil(EXTRA_PERCENT * F.ceil(80 * F.col("n") / 100) / 100))


def ref_of(node: Column) -> Column:
    return F.greatest(F.shiftrightunsigned(node, 64 - REF_BITS), F.lit(1))


#: bucket and packed: elements of a range of hashes and whose they are; or a row of a document, where `repeated` is what its task has settled.
SENT = "bucket int, packed binary, ref long, repeated int, doc long, mark long, n int, node long"
MET = "ref long, repeated int, doc long, mark long, n int, node long"


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, dtype=np.int64)


def filter_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, mark, text) rows to SENT."""
    names = [x.split()[0] for x in SENT.split(", ")]

    def flush(held: list) -> Iterator[pa.RecordBatch]:
        key, row, docs, marks, sizes, nodes = (np.concatenate(x) for x in zip(*held, strict=True))
        refs = np.maximum(nodes >> np.uint64(64 - REF_BITS), np.uint64(1))
        # of equal nodes one sends
        leads = np.zeros(len(nodes), dtype=bool)
        leads[np.unique(nodes, return_index=True)[1]] = True
        sends = leads[row]
        key, ref = key[sends], refs[row[sends]]
        order = np.argsort(key, kind="stable")
        key, ref = key[order], ref[order]
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        times = np.diff(np.append(np.flatnonzero(first), len(key)))
        several = np.repeat(times > 1, times)
        known_ref, known = np.unique(ref[several], return_counts=True)
        repeated = np.zeros(len(nodes), dtype=np.int32)
        if len(known_ref):
            at = np.minimum(np.searchsorted(known_ref, refs), len(known_ref) - 1)
            repeated[leads] = np.where(known_ref[at] == refs, known[at], 0)[leads]
        # the first of several stands for all of them elsewhere, as nobody's
        key, ref = key[first], np.where(times > 1, np.uint64(0), ref[first])
        bucket, packed = pack_buckets(key, FILTER_BITS, buckets, ref.view(np.int64))
        n = len(packed)
        for i in range(0, n, 64):
            m = min(64, n - i)
            rest = [pa.nulls(m, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[i : i + m], pa.int32()), pa.array(packed[i : i + m], pa.binary()), *rest], names)
        # evenly, whatever the nodes: these rows only pass
        dealt = ((mix(marks.view(np.uint64) + np.arange(len(marks), dtype=np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        m = len(nodes)
        yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), pa.nulls(m, pa.binary()), pa.array(refs.view(np.int64)), pa.array(repeated), pa.array(docs), pa.array(marks), pa.array(sizes.astype(np.int32)), pa.array(nodes.view(np.int64))], names)

    held, size, texts = [], 0, 0
    for b in batches:
        for a, z, data, offsets in pieces(b, "text"):
            key, first = shingles(split(data, offsets, lower=True))
            n = np.diff(first)
            owner = np.repeat(np.arange(z - a), n)
            chosen = np.arange(len(key)) - first[owner] < prefix(n)[owner]
            held.append((key[chosen] >> np.uint64(64 - FILTER_BITS), owner[chosen] + texts, b.column(0).slice(a, z - a).to_numpy(), b.column(1).slice(a, z - a).to_numpy(), n, nodes_of(key, first)))
            size, texts = size + int(chosen.sum()), texts + z - a
            if size >= HELD:
                yield from flush(held)
                held, size, texts = [], 0, 0
    if held:
        yield from flush(held)


def meet(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """SENT sorted by bucket to MET: how many elements of each node are repeated between tasks, and the documents' rows."""
    names = [x.split()[0] for x in MET.split(", ")]
    held, rows = [], []

    def ranges() -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows.append(b.filter(b.column(4).is_valid()))
            rest = b.filter(b.column(1).is_valid())
            yield pa.RecordBatch.from_arrays([rest.column(0), rest.column(1)], ["bucket", "packed"])

    def send() -> Iterator[pa.RecordBatch]:
        if held:
            ref, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for i in range(0, len(ref), 1 << 16):
                m = len(ref[i : i + (1 << 16)])
                rest = [pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(ref[i : i + m].view(np.int64)), pa.array(times[i : i + m], pa.int32()), *rest], names)

    for bucket, packed in runs(ranges()):
        for key, ref in unpack_bucket(bucket, packed, 2, FILTER_BITS, buckets):
            ref = ref.view(np.uint64)
            order = np.lexsort((ref, key))
            key, ref = key[order], ref[order]
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]) | (ref[1:] != ref[:-1])
            key, ref = key[fresh], ref[fresh]
            times = np.diff(np.append(_starts(key), len(key)))
            held.append(ref[np.repeat(times > 1, times) & (ref > 0)])
        for b in rows:
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(2, 8)], names)
        rows.clear()
        if sum(map(len, held)) >= HELD:
            yield from send()
    for b in rows:
        yield pa.RecordBatch.from_arrays([b.column(i) for i in range(2, 8)], names)
    yield from send()


SETS = "node long, n int, elements array<long>"


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) rows to whole sets."""
    for b in batches:
        for a, z, data, offsets in pieces(b, "text"):
            key, first = shingles(split(data, offsets, lower=True))
            elements = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(key.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes_of(key, first).view(np.int64)), pa.array(np.diff(first).astype(np.int32)), elements], ["node", "n", "elements"])


def small(df: DataFrame) -> DataFrame:
    """`df`, to be broadcast if it has at most BROADCAST_IDS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def sized(docs: DataFrame) -> DataFrame:
    """MET of the rows (doc_id, mark, text), none of which has a null doc_id or text."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(lambda b: filter_rows(b, buckets), SENT)
    return cut(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda b: meet(b, buckets), MET))


def passing(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """node, n, first and least of every node with elements; and node, first of those that the filter passes.

    first is a node's smallest (doc, mark, times), where times tells how often these rows are repeated entirely; least its smallest doc."""
    each = met.where("node is not null and n > 0").groupBy("node", "doc", "mark").agg(F.first("n").alias("n"), F.count("*").alias("times"))
    nodes = cut(each.groupBy("node").agg(F.first("n").alias("n"), F.min(F.struct("doc", "mark", "times")).alias("first"), F.min("doc").alias("least")))
    repeated = met.groupBy("ref").agg(F.sum("repeated").alias("repeated")).where("repeated > 0")
    return nodes, nodes.withColumn("ref", ref_of(F.col("node"))).join(repeated, "ref").where(F.col("repeated") >= needed()).select("node", "first")


def whole_sets(docs: DataFrame, passed: DataFrame) -> DataFrame:
    """The sets of the nodes in `passed`, from one row of `docs` (mark, text) each."""
    passed = cut(passed.select(F.col("first.mark").alias("mark"), F.col("first.times").alias("times")))
    read = lambda which: docs.join(small(passed.where(which).select("mark")), "mark", "left_semi")
    out = read("times = 1").select("text").mapInArrow(set_rows, SETS)
    if not passed.where("times > 1").isEmpty():
        # rows repeated entirely become one before their texts are split
        out = out.union(read("times > 1").groupBy("mark").agg(F.first("text").alias("text")).select("text").mapInArrow(set_rows, SETS))
    return cut(out)


def attach(pairs: DataFrame, sets: DataFrame, side: str, other: str, size: str, elements: str) -> DataFrame:
    """`pairs` with the sets that `side` names.  A pair's `salts` tells over how many tasks those that name the same set are dealt."""
    need = pairs.select(F.col(side).alias("node"), "salts").distinct()
    copies = sets.join(small(need), "node").select(F.col("node").alias(side), "salts", F.col("n").alias(size), F.col("elements").alias(elements), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("_i"))
    return pairs.withColumn("_i", F.pmod(F.xxhash64(other), F.col("salts")).cast("int")).join(copies, [side, "salts", "_i"]).drop("_i")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, the sizes na and nb, and the overlap of each pair (a, b, salts) of nodes."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column(4), b.column(5)
            found = [len(np.intersect1d(x[i].values.to_numpy(), y[i].values.to_numpy(), assume_unique=True)) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(found, pa.int32())], ["a", "b", "na", "nb", "overlap"])

    both = attach(attach(pairs.select("a", "b", "salts"), sets, "a", "b", "na", "x"), sets, "b", "a", "nb", "y")
    return both.select("a", "b", "na", "nb", "x", "y").mapInArrow(counted, "a long, b long, na int, nb int, overlap int")


def linked(overlap: Column | str, na: Column | str, nb: Column | str) -> Column:
    o, x, y = (F.col(c).cast("long") if isinstance(c, str) else c.cast("long") for c in (overlap, na, nb))
    return 100 * o >= 80 * (x + y - o)


def index_lists(sets: DataFrame) -> DataFrame:
    """The entries of the lists: h, node, n, pos (the element's position, from 0), weight (share of repeated elements) and salts.

    h begins with 4 times the logarithm of the number of nodes that have the element, so its order is that of the
    elements; 56 bits of the shingle's hash follow.  salts is how many tasks the list is dealt to."""
    entries = sets.select("node", "n", F.explode("elements").alias("h")).withColumn("h", F.shiftrightunsigned("h", 8))
    times = entries.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    code = F.least(F.floor(F.log2("df") * 4), F.lit(127)).cast("long")
    per = entries.join(times, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.shiftleft(code, 56).bitwiseOR(F.col("h")))).alias("e"))
    unique = F.col("n") - F.size("e")
    length = F.col("n") - F.ceil(80 * F.col("n") / 100) + 1
    listed = per.where(unique < length).select("node", "n", unique.alias("u"), (F.size("e") / F.col("n")).alias("weight"), F.posexplode(F.slice("e", F.lit(1), (length - unique).cast("int"))).alias("i", "h"))
    most = F.pow(F.lit(2.0), (F.shiftright("h", 56) + 1) / 4)
    return listed.select("h", "node", "n", (F.col("u") + F.col("i")).alias("pos"), "weight", F.ceil(most / LIST_CELL).cast("int").alias("salts"))


def spread(per_list: DataFrame) -> DataFrame:
    """Rows for each list (h, salts) to all tasks `_i` that it is dealt to."""
    return per_list.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def links(sets: DataFrame) -> DataFrame:
    """a, b of links that connect all linked nodes."""
    own = F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")
    lists = cut(index_lists(sets)).withColumnRenamed("node", "a").withColumn("_i", own)
    best = lists.groupBy("h", "salts").agg(F.max(F.struct("weight", "a", "n")).alias("l"), F.count("*").alias("many")).where("many > 1").select("h", "salts", F.col("l.a").alias("leader"), F.col("l.n").alias("nl"))
    lists = lists.join(spread(best), ["h", "salts", "_i"])
    led = cut(lists.where("a <> leader").groupBy("a", F.col("leader").alias("b")).agg(F.max("salts").alias("salts")))
    answers = cut(overlaps(led, sets))
    direct = answers.where(linked("overlap", "na", "nb")).select("a", "b")
    roots = components(direct).select(F.col("node").alias("a"), "root")
    known = answers.select("a", F.col("b").alias("leader"), "overlap")
    lists = lists.join(known, ["a", "leader"], "left").join(roots, "a", "left")
    lists = cut(lists.select("h", "salts", "_i", "a", "n", "pos", "nl", F.coalesce("root", "a").alias("root"), F.when(F.col("a") == F.col("leader"), F.col("n")).otherwise(F.col("overlap")).alias("o")))
    # lists whose members are all in one component have nothing left to find
    mixed = lists.groupBy("h", "salts").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("h", "salts")
    lists = cut(lists.join(spread(mixed), ["h", "salts", "_i"], "left_semi"))
    # blocks of size and of what remains from the position on, two for each factor of 1.25
    block = lambda c: F.floor(2 * F.log(c) / F.lit(float(np.log(1.25)))).cast("int")
    size, rest = block(F.col("n")), block(F.col("n") - F.col("pos"))
    every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    # x is the larger; linked, the smaller's rest is at least 80 % of x, which is two blocks
    within = F.array(*[F.struct((F.col("_size") - i).alias("size"), (F.col("_size") - j).alias("rest")) for i in range(3) for j in range(i, 3)])
    x = lists.select("h", "salts", *[F.col(c).alias(f"x_{c}") for c in ("a", "n", "pos", "root", "o", "nl")], "_i", every.alias("_j"), size.alias("_size"))
    x = x.withColumn("_b", F.explode(within)).select("*", "_b.size", "_b.rest").drop("_b", "_size")
    y = lists.select("h", *[F.col(c).alias(f"y_{c}") for c in ("a", "n", "pos", "root", "o")], every.alias("_i"), F.col("_i").alias("_j"), size.alias("size"), rest.alias("rest"))
    # overlap that links the two: 80 / 180 of their sizes, rounded up
    wanted = F.ceil(80 * (F.col("x_n") + F.col("y_n")) / F.lit(180) - F.lit(1e-9))
    behind = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    larger = (F.col("x_n") > F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_a") > F.col("y_a")))
    # the first shared element of a linked pair has all that they share behind it
    met = x.join(y, ["h", "_i", "_j", "size", "rest"]).where(larger & (F.col("x_root") != F.col("y_root"))).where(behind >= wanted)
    most = F.least("x_o", "y_o") + F.least(F.col("x_n") - F.col("x_o"), F.col("y_n") - F.col("y_o"))
    least = F.col("x_o") + F.col("y_o") - F.col("x_nl")
    pairs = cut(met.where(most >= wanted).groupBy(F.col("x_a").alias("a"), F.col("y_a").alias("b")).agg(F.max(least >= wanted).alias("sure"), F.max("salts").alias("salts")))
    verified = overlaps(pairs.where("not sure"), sets).where(linked("overlap", "na", "nb")).select("a", "b")
    return cut(direct.union(pairs.where("sure").select("a", "b")).union(verified))


def smallest_of_class(nodes: DataFrame, value: str) -> DataFrame:
    """node and the smallest `value` of its class, of nodes (node, root, value), where root is null for a class's root.

    Members of classes of more than LIST_CELL nodes meet their class in a broadcast, as such a class would be
    one task's in a shuffle; there is at most one for each LIST_CELL nodes.
    """
    members = nodes.where("root is not null").select("node", "root", value)
    per = cut(members.groupBy("root").agg(F.min(value).alias("_v"), F.count("*").alias("_n")))
    heads = nodes.where("root is null").join(per.select(F.col("root").alias("node"), "_v", "_n"), "node", "left").select("node", F.least(value, "_v").alias(value), F.coalesce("_n", F.lit(0)).alias("_n"))
    heads = cut(heads)
    of = lambda which: heads.where(which).select(F.col("node").alias("root"), value)
    large = small(of(f"_n > {LIST_CELL}"))
    members = members.drop(value)
    rest = members.join(large, "root").union(members.join(large.select("root"), "root", "left_anti").join(of(f"_n > 0 and _n <= {LIST_CELL}"), "root"))
    return heads.select("node", value).union(rest.select("node", value))


def labelled(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (doc_id, mark, text) with doc_id: MET, and node, root (null for a class's root), least and first of the nodes with elements."""
    met = sized(named)
    nodes, passed = passing(met)
    roots = components(links(whole_sets(named.select("mark", "text"), passed)))
    return met, cut(nodes.join(roots, "node", "left").select("node", "root", "least", "first"))


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, mark (a hash of the two that parts rows) and text."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs`."""
    texts = marked(docs)
    met, labels = labelled(texts.where("doc_id is not null"))
    labels = smallest_of_class(labels, "least").withColumnRenamed("least", "component_id")
    out = met.where("doc is not null").select(F.col("doc").alias("doc_id"), "n", "node").join(labels, "node", "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    unnamed = texts.where("doc_id is null").select("text").mapInArrow(set_rows, SETS)
    return out.union(unnamed.select(F.lit(None).cast("long"), F.col("n").cast("long"), F.lit(None).cast("long")))


def one_row_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with all their columns, but of each class of linked rows only one: that of the smallest (doc_id, hash of id and text).

    A row goes only if it is linked with the one that stays.  Rows that share a doc_id and are not linked all stay."""
    met, labels = labelled(marked(docs).where("doc_id is not null"))
    labels = smallest_of_class(labels.withColumn("stays", F.struct("first.doc", "first.mark")), "stays")
    rows = met.where("doc is not null and n > 0").groupBy("doc", "mark", "node").agg(F.count("*").alias("rows"))
    found = rows.join(labels, "node").select("doc", "mark", "rows", (F.struct("doc", "mark") == F.col("stays")).alias("stays"))
    found = cut(found.where("not stays or rows > 1"))
    losers = small(found.where("not stays").select("doc", "mark"))
    # the whole row by position, so that no name of a column is in the way
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row")
    left = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("doc_id", "text").alias("mark"), row).join(losers, ["doc", "mark"], "left_anti")
    again, columns = found.where("stays").select("doc", "mark"), [F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    if again.isEmpty():
        return left.select(*columns)
    # rows that repeat doc_id and text: one of them stays, by all their columns
    one = left.join(again, ["doc", "mark"], "left_semi").groupBy("doc", "mark").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.join(again, ["doc", "mark"], "left_anti").select("row").unionByName(one.select("row")).select(*columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
