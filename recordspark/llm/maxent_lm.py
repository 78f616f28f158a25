"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | context) = P(class | context) * P(word | class, context).  The MODEL_WORDS most frequent words
(and the end of a text) are in CLASSES - 1 classes by rank; all other words, unseen ones too, are in the
tail class.  Unseen words have 0.5 / (N_tail + 0.5 * (V_tail + 1)) of it.  The counted ones are the leaves of
a tree of classes: a word goes down by the bits of its hash, up to 5 a level, each step a softmax over the
branches given the context, to a group of about LEAF words; there it has its smoothed share (c + 0.5).  The
number of levels and groups follows from the number of distinct words, up to MOST_BITS bits (2 MB of masses): with
more than LEAF words for each of these, groups grow, as their masses are in every worker.  What the context
doesn't move is a word's share within its group, which its own count gives, so every word stays a word of its own,
whatever the size of its group.  So the model sums to 1 over the same events
as the unigram base.  Class and word logits are sums of rows of weight tables, picked by hashed features of
the context: the word before, the one before that (a skip), and both together; within a class or at a node
of the tree, the first two with the class or node.  The tables' rows grow with the square root of the number
of distinct words, to MOST_ROWS for each kind of feature (59 MB in all), so neither the driver nor a worker holds
what grows with the vocabulary beyond that.

Counting: every task counts the words of its rows, and the counts of all words meet by hash.  Training:
ROUNDS disjoint slices of the training rows, each read once by as many tasks as it has TASK_TOKENS (whatever
the cluster); a task starts from the tables of the last round, takes AdaGrad steps over its rows, and sends
its changes in blocks.  A block's changes are summed in a tree, FAN at a time, and averaged over the tasks
that touched a row.  So are the mean squares of a row's gradients, with which the next round's steps begin.  Only the finished tables (32 numbers a row, with 3, 2 and 2 kinds of features) and the
masses of the groups come to the driver.  Scoring: up to HEAD of the most frequent words with counts travel
with the tables; all other words of a text meet their counts in a join by hash, where no hash is frequent.

Words are met by 64-bit hashes, and rows by doc_id and a 64-bit hash of the text.  Defined results: a null or empty text has the end token alone.  Rows with
a null doc_id are held out.  Repeated rows are scored one by one, and learned from as often as they occur.
Without training rows all counts are 0 and both scores are those of an unseen word.  Further columns don't
matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.llm.common import cut, held_out, table
from recordspark.llm.words import Words, mix, pieces, split

CLASSES, CLASS_WORDS = 32, 33
MODEL_WORDS = (CLASSES - 1) * CLASS_WORDS
HEAD = 1 << 16
#: Rows of the tables for each kind of feature, at least; ROWS_ROOT times the root of the number of distinct words.
CLASS_ROWS, WORD_ROWS = 1 << 12, 1 << 12
ROWS_ROOT = 8
CLASS_KINDS, WORD_KINDS, NODE_KINDS = 3, 2, 2
#: Counted words of the tail in a group, about; and the most bits of a level of the tail's tree.
LEAF, LEVEL_BITS = 16, 5
#: The most bits that lead to a group, and rows of a kind of feature: what the driver, closures and workers hold is bounded by them.
MOST_BITS, MOST_ROWS = 18, 1 << 16
ROUNDS, RATE, BATCH, BLOCK = 3, 0.12, 1 << 15, 32
#: Tokens that a training task learns from, about (or a partition's, where these are larger); and sums of changes that one task adds.
TASK_TOKENS, FAN = 1 << 22, 64
END, START = np.uint64(0xE5D5E5D5E5D5E5D5), np.uint64(0x0B5A0B5A0B5A0B5A)
RESULT = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text followed by its end; and the index of each token's text."""
    n = words.counts
    text = np.repeat(np.arange(len(n)), n + 1)
    out = np.full(len(text), END)
    out[np.arange(len(words.start)) + words.texts_of_words()] = words.hashes()
    return out, text


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        for i in range(0, len(word), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(word[i : i + (1 << 16)].view(np.int64)), pa.array(n[i : i + (1 << 16)])], ["word", "c"])

    for b in batches:
        for _, _, data, offsets in pieces(b, b.schema.names[-1]):
            held.append(tokens(split(data, offsets, lower=True))[0])
            size += len(held[-1])
            if size >= 1 << 22:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def prefix_of(bits: int) -> Column:
    """The first bits of the column `word`."""
    return F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")


def prefixes(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), dtype=np.int64)


@dataclass
class Vocabulary:
    """Totals, and the most frequent words: `word` sorted by hash, with rank (0 is the most frequent) and count.

    `groups` has the smoothed mass of the tail's counted words by the first bits of their hashes."""

    n: int
    v: int
    word: np.ndarray
    rank: np.ndarray
    c: np.ndarray
    groups: np.ndarray | None = None

    @staticmethod
    def of(counts: DataFrame) -> Vocabulary:
        n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        # words by bins of their counts; whole bins from the top, as long as the head holds them
        bins = counts.groupBy(F.floor(F.log2("c") * 64).alias("bin")).count().orderBy(F.desc("bin")).collect()  # 64 for each doubling
        least, held = None, 0
        for r in bins:
            held += r["count"]
            if held > HEAD:
                break
            least = r["bin"]
        top = counts.where(F.floor(F.log2("c") * 64) >= least if least is not None else F.lit(False)).toArrow()
        word, c = top["word"].to_numpy().view(np.uint64), top["c"].to_numpy()
        by_count = np.lexsort((word, -c))
        word, c = word[by_count], c[by_count]
        order = np.argsort(word)
        out = Vocabulary(n, v, word[order], order.astype(np.int64), c[order])
        model = out.rank < MODEL_WORDS
        bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, v - int(model.sum())) / LEAF))))
        met = counts.groupBy(prefix_of(bits).alias("g")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).toArrow()
        sums = np.zeros((2, 1 << bits), dtype=np.int64)
        sums[:, met["g"].to_numpy()] = met["c"].to_numpy(), met["v"].to_numpy()
        for i, x in enumerate((out.c[model], 1)):
            np.subtract.at(sums[i], prefixes(out.word[model], bits), x)
        out.groups = sums[0] + 0.5 * sums[1]
        return out

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and count of each hash; rank -1 for those that aren't in the head."""
        if not len(self.word):
            return np.full(len(h), -1), np.zeros(len(h), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        hit = self.word[at] == h
        return np.where(hit, self.rank[at], -1), np.where(hit, self.c[at], 0)

    @property
    def rows(self) -> int:
        """Rows of the tables for each kind of feature: a power of 2."""
        return min(MOST_ROWS, max(CLASS_ROWS, 1 << math.ceil(math.log2(ROWS_ROOT * math.sqrt(max(1, self.v))))))

    @property
    def levels(self) -> list[tuple[int, int]]:
        """For each level of the tail's tree, the bits above it and its own."""
        bits = int(len(self.groups)).bit_length() - 1 if self.groups is not None else 0
        n = -(-bits // LEVEL_BITS)
        ends = [-(-bits * i // n) for i in range(n + 1)] if n else [0]
        return [(a, z - a) for a, z in zip(ends[:-1], ends[1:], strict=True)]

    def branches(self) -> list[np.ndarray]:
        """For each level, the log shares of the branches of each node; those without counted words have none."""
        out = []
        for above, own in self.levels:
            mass = self.groups.reshape(1 << (above + own), -1).sum(axis=1).reshape(1 << above, 1 << own)
            whole = np.maximum(mass.sum(axis=1, keepdims=True), 0.5)
            out.append(np.where(mass > 0, np.log(np.maximum(mass, 0.5) / whole), -1e9).astype(np.float32))
        return out

    @property
    def base_total(self) -> float:
        return self.n + 0.5 * (self.v + 1)

    def tail_total(self) -> float:
        """What the tail class's words sum to, unseen ones included."""
        model = self.rank < MODEL_WORDS
        return (self.n - int(self.c[model].sum())) + 0.5 * (self.v - int(model.sum()) + 1)

    def priors(self) -> tuple[np.ndarray, np.ndarray]:
        """Log shares of the classes, and of the words within each class."""
        c = np.zeros(MODEL_WORDS)
        model = self.rank < MODEL_WORDS
        c[self.rank[model]] = self.c[model]
        inner = c.reshape(CLASSES - 1, CLASS_WORDS) + 1e-3
        mass = np.concatenate(([self.tail_total()], inner.sum(axis=1)))
        within = np.vstack([np.zeros(CLASS_WORDS), np.log(inner / inner.sum(axis=1, keepdims=True))])
        return np.log(mass / mass.sum()).astype(np.float32), within.astype(np.float32)


@dataclass
class Tables:
    """Weights of the classes (a row for each class feature), of the words of a class, and of the branches in the tail's tree."""

    classes: np.ndarray
    words: np.ndarray
    nodes: np.ndarray

    @staticmethod
    def blank(rows: int = CLASS_ROWS) -> Tables:
        return Tables(*(np.zeros((kinds * rows, width), np.float32) for kinds, width in ((CLASS_KINDS, CLASSES), (WORD_KINDS, CLASS_WORDS), (NODE_KINDS, 1 << LEVEL_BITS))))

    @property
    def all(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.classes, self.words, self.nodes

    @property
    def rows(self) -> int:
        return len(self.classes) // CLASS_KINDS


def context(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token, the hashes of the one before and of the one before that."""
    one, two = np.full(len(h), START), np.full(len(h), START)
    same = text[1:] == text[:-1]
    one[1:][same] = h[:-1][same]
    same = text[2:] == text[:-2]
    two[2:][same] = h[:-2][same]
    return one, two


def class_features(one: np.ndarray, two: np.ndarray, rows: int) -> list[np.ndarray]:
    keys = (one, two * np.uint64(3) + np.uint64(1), mix(one + two * np.uint64(5)))
    return [((k >> np.uint64(20)) % np.uint64(rows)).astype(np.int64) + i * rows for i, k in enumerate(keys)]


def word_features(one: np.ndarray, two: np.ndarray, group: np.ndarray, rows: int) -> list[np.ndarray]:
    c = group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = (mix(one + c), mix(two * np.uint64(7) + c))
    return [((k >> np.uint64(20)) % np.uint64(rows)).astype(np.int64) + i * rows for i, k in enumerate(keys)]


def exponentials(logits: np.ndarray) -> np.ndarray:
    """exp of the logits, in their place; and their sums.  Priors sum to 1, so the sums don't vanish."""
    np.exp(np.minimum(logits, 60.0, out=logits), out=logits)
    return np.maximum(logits @ np.ones(logits.shape[1], dtype=logits.dtype), 1e-30)


def log_share(logits: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Log softmax of each row's label; the logits are used up."""
    own = logits[np.arange(len(logits)), label]
    return own - np.log(exponentials(logits))


def gradient(logits: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Of minus the log softmax by the logits, which are used up."""
    total = exponentials(logits)
    logits /= total[:, None]
    logits[np.arange(len(logits)), label] -= 1
    return logits


class Model:
    def __init__(self, vocabulary: Vocabulary, tables: Tables):
        self.vocabulary, self.tables = vocabulary, tables
        self.class_prior, self.word_prior = vocabulary.priors()
        self.branches = vocabulary.branches()

    def parts(self, h: np.ndarray, text: np.ndarray):
        rank, c = self.vocabulary.look_up(h)
        inner = (rank >= 0) & (rank < MODEL_WORDS)
        group = np.where(inner, rank // CLASS_WORDS + 1, 0)
        one, two = context(h, text)
        return rank, c, inner, group, one, two

    def class_logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.take(self.tables.classes, rows[0], axis=0)
        out += self.class_prior
        for r in rows[1:]:
            out += np.take(self.tables.classes, r, axis=0)
        return out

    def word_logits(self, rows: list[np.ndarray], group: np.ndarray) -> np.ndarray:
        out = np.take(self.word_prior, group, axis=0)
        for r in rows:
            out += np.take(self.tables.words, r, axis=0)
        return out

    def steps(self, h: np.ndarray, one: np.ndarray, two: np.ndarray):
        """For each level of the tail's tree: the features, the logits of the branches and the branch of each word."""
        for (above, own), prior in zip(self.vocabulary.levels, self.branches, strict=True):
            node = prefixes(h, above)
            rows = word_features(one, two, node + (1 << above), self.tables.rows)
            logits = np.take(prior, node, axis=0)
            for r in rows:
                logits += np.take(self.tables.nodes, r, axis=0)[:, : 1 << own]
            yield rows, logits, prefixes(h, above + own) & ((1 << own) - 1)

    def tail_log10(self, h: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For the tokens `at`, of the tail class: log10 of the probability, within the class, of a counted word divided by its c + 0.5."""
        v, (one, two) = self.vocabulary, context(h, text)
        groups = v.groups if v.groups is not None else np.array([v.tail_total() - 0.5])
        bits = len(groups).bit_length() - 1
        out = np.log(np.maximum(v.tail_total() - 0.5, 0.5) / v.tail_total()) - np.log(np.maximum(groups[prefixes(h[at], bits)], 0.5))
        for i in range(0, len(at), BATCH):
            x = at[i : i + BATCH]
            for _, logits, branch in self.steps(h[x], one[x], two[x]):
                out[i : i + BATCH] += log_share(logits, branch)
        return out / np.log(10)

    def log10(self, h: np.ndarray, text: np.ndarray):
        """Rank and count of each token, and its log10 probability; for tail words the one of the class alone."""
        rank, c, inner, group, one, two = self.parts(h, text)
        out = np.empty(len(h))
        for i in range(0, len(h), BATCH):
            s = slice(i, i + BATCH)
            out[s] = log_share(self.class_logits(class_features(one[s], two[s], self.tables.rows)), group[s])
            x = np.flatnonzero(inner[s])
            if len(x):
                g = group[s][x]
                out[s][x] += log_share(self.word_logits(word_features(one[s][x], two[s][x], g, self.tables.rows), g), rank[s][x] % CLASS_WORDS)
        return rank, c, out / np.log(10)


class Learner:
    """AdaGrad steps on a copy of the tables."""

    def __init__(self, model: Model, before: list[np.ndarray] | None = None):
        """before: for each row of each table, the mean square of its gradients in the rounds before."""
        self.model = Model(model.vocabulary, Tables(*(t.copy() for t in model.tables.all)))
        self.squares = Tables(*(np.zeros_like(t) for t in model.tables.all))
        for s, b in zip(self.squares.all, before or [], strict=bool(before)):
            s += b[:, None]

    @staticmethod
    def _step(table_: np.ndarray, squares: np.ndarray, rows: list[np.ndarray], gradient_: np.ndarray) -> None:
        width = gradient_.shape[1]
        columns = np.ascontiguousarray(gradient_.T, dtype=np.float64)
        for r in rows:
            # the touched rows get numbers, and each column its sums by them
            base = int(r.min())
            touched = np.bincount(r - base) > 0
            used = np.flatnonzero(touched) + base
            number = (np.cumsum(touched) - 1)[r - base]
            g = np.array([np.bincount(number, c, len(used)) for c in columns], dtype=np.float32).T
            total = squares[used, :width] + g * g
            squares[used, :width] = total
            table_[used, :width] -= RATE * g / np.sqrt(total + 1e-6)

    def learn(self, h: np.ndarray, text: np.ndarray) -> None:
        m = self.model
        rank, _, inner, group, one, two = m.parts(h, text)
        for i in range(0, len(h), BATCH):
            s = slice(i, i + BATCH)
            rows = class_features(one[s], two[s], m.tables.rows)
            self._step(m.tables.classes, self.squares.classes, rows, gradient(m.class_logits(rows), group[s]))
            x = np.flatnonzero(inner[s])
            if len(x):
                k = group[s][x]
                rows = word_features(one[s][x], two[s][x], k, m.tables.rows)
                self._step(m.tables.words, self.squares.words, rows, gradient(m.word_logits(rows, k), rank[s][x] % CLASS_WORDS))
            x = np.flatnonzero(~inner[s])
            for rows, logits, branch in m.steps(h[s][x], one[s][x], two[s][x]) if len(x) else ():
                self._step(m.tables.nodes, self.squares.nodes, rows, gradient(logits, branch))


def _blocks(changes: np.ndarray, squares: np.ndarray, first: int, block: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    for i in range(0, len(changes), block):
        q = squares[i : i + block]
        if q.any():
            yield first + i // block, changes[i : i + block].astype(np.float16).tobytes(), (q > 0).astype(np.uint8).tobytes(), q.astype(np.float32).tobytes()


#: change: sums of changes (of a task's own: 16-bit floats); touched: how many tasks touched each row (of a task's own: a byte each); square: sums of the rows' mean squares.
BLOCKS = "block int, task int, change binary, touched binary, square binary"


def _summed(met: pa.Table, block_rows: int) -> pa.Table:
    """One row for the changes to one block of up to FAN tasks or sums of tasks."""
    n = np.zeros(block_rows, dtype=np.int64)
    total: np.ndarray | float = 0.0
    squares = np.zeros(block_rows)
    for c, t, q in zip(*(met[x].to_pylist() for x in ("change", "touched", "square")), strict=True):
        own = len(t) == block_rows
        n += np.frombuffer(t, dtype=np.uint8 if own else np.int32)
        total = total + np.frombuffer(c, dtype=np.float16 if own else np.float32).astype(np.float64)
        squares += np.frombuffer(q, dtype=np.float32)
    columns = [pa.array([met[c][0].as_py()], pa.int32()) for c in ("block", "task")]
    return pa.table([*columns, *[pa.array([x.tobytes()], pa.binary()) for x in (total.astype(np.float32), n.astype(np.int32), squares.astype(np.float32))]], names=["block", "task", "change", "touched", "square"])


def train(docs: DataFrame, learn: str, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Model:
    """The model after `rounds` rounds over disjoint slices of the rows for which `learn` holds."""
    tables, tasks = Tables.blank(vocabulary.rows), max(1, math.ceil(vocabulary.n / rounds / TASK_TOKENS))
    block_rows = BLOCK * (tables.rows // CLASS_ROWS)  # as many blocks whatever the rows
    firsts = [0, *np.cumsum([len(t) // block_rows for t in tables.all]).tolist()]
    before = [np.zeros(len(t), dtype=np.float32) for t in tables.all]

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(Model(vocabulary, tables), before)
        for b in batches:
            for _, _, data, offsets in pieces(b, "text"):
                learner.learn(*tokens(split(data, offsets, lower=True)))
        each = zip(learner.model.tables.all, tables.all, learner.squares.all, before, firsts[:-1], strict=True)
        rows = [x for new, old, s, b, first in each for x in _blocks(new - old, np.where((new != old).any(axis=1), np.maximum(s.mean(axis=1) - b, 1e-30), 0), first, block_rows)]
        if rows:
            block, change, touched, square = zip(*rows, strict=True)
            task = pa.array(np.full(len(block), TaskContext.get().partitionId()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), task, pa.array(change, pa.binary()), pa.array(touched, pa.binary()), pa.array(square, pa.binary())], ["block", "task", "change", "touched", "square"])

    for i in range(rounds):
        own = docs.where(learn).where(F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == i).select("text")
        met, left = own.coalesce(tasks).mapInArrow(learned, BLOCKS), tasks
        while True:  # sums of FAN, and of FAN sums
            met = met.withColumn("task", (F.col("task") / FAN).cast("int")).groupBy("block", "task").applyInArrow(lambda t: _summed(t, block_rows), BLOCKS)
            left = math.ceil(left / FAN)
            if left == 1:
                break
        new, squares = Tables(*(t.copy() for t in tables.all)), [b.copy() for b in before]
        for r in met.toArrow().to_pylist():  # the numbers of the tables, at most
            k = int(np.searchsorted(firsts, r["block"], side="right")) - 1
            at = (r["block"] - firsts[k]) * block_rows
            n = np.maximum(np.frombuffer(r["touched"], dtype=np.int32), 1)
            new.all[k][at : at + block_rows] += np.frombuffer(r["change"], dtype=np.float32).reshape(block_rows, -1) / n[:, None]
            squares[k][at : at + block_rows] += np.frombuffer(r["square"], dtype=np.float32) / n
        tables, before = new, squares
    return Model(vocabulary, tables)


SCORED = "word long, doc long, part long, n int, held_out boolean, n_tokens long, n_known long, base double, score double, path double"


def score_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(doc, part, held_out, text) rows to one row each (n is null), and one for each of its words outside the head."""
    v = model.vocabulary
    base_total = np.log10(v.base_total)
    names = [x.split()[0] for x in SCORED.split(", ")]
    for b in batches:
        for a, z, data, offsets in pieces(b, "text"):
            h, text = tokens(split(data, offsets, lower=True))
            doc, part = (b.column(i).slice(a, z - a).to_numpy() for i in (0, 1))
            rank, c, p = model.log10(h, text)
            rows = z - a
            inner, out = (rank >= 0) & (rank < MODEL_WORDS), rank < 0
            own = np.where(out, 0.0, np.log10(c + 0.5))
            base = np.bincount(text, own - base_total, rows)
            # a counted word of the tail is p, path and c + 0.5; an unseen one p and 0.5 of the tail; outside the head, `score` decides
            at = np.flatnonzero(~inner)
            path = np.zeros(len(h))
            path[at] = model.tail_log10(h, text, at)
            score = np.bincount(text, p + np.where(inner | out, 0.0, own + path), rows)
            per = [np.bincount(text, minlength=rows), np.bincount(text, rank >= 0, rows).astype(np.int64)]
            spread = mix(doc.astype(np.uint64) + part.astype(np.uint64)).view(np.int64)
            nulls = lambda kind, m: pa.nulls(m, kind)
            yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(doc), pa.array(part), nulls(pa.int32(), rows), b.column(2).slice(a, rows), pa.array(per[0]), pa.array(per[1]), pa.array(base), pa.array(score), nulls(pa.float64(), rows)], names)
            # words outside the head, by text and word
            h, text, path = h[out], text[out], path[out]
            order = np.lexsort((h, text))
            h, text, path = h[order], text[order], path[order]
            starts = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))) if len(h) else np.zeros(0, dtype=np.int64)
            n = np.diff(np.append(starts, len(h))).astype(np.int32)
            path = np.add.reduceat(path, starts) if len(h) else path
            h, text = h[starts].view(np.int64), text[starts]
            for i in range(0, len(h), 1 << 16):
                s, m = slice(i, i + (1 << 16)), len(h[i : i + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.array(h[s]), pa.array(doc[text[s]]), pa.array(part[text[s]]), pa.array(n[s]), nulls(pa.bool_(), m), nulls(pa.int64(), m), nulls(pa.int64(), m), nulls(pa.float64(), m), nulls(pa.float64(), m), pa.array(path[s])], names)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Scores of every row of `docs` (doc_id, held_out, text)."""
    last = F.lit((1 << 63) - 1)
    keyed = docs.select(F.coalesce("doc_id", last).alias("doc"), F.xxhash64("text").alias("part"), "held_out", F.coalesce("text", F.lit("")).alias("text"))
    rows = keyed.mapInArrow(lambda b: score_rows(b, model), SCORED)
    met = rows.join(counts, "word", "left")
    whole = F.col("n").isNull()
    share_ = F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)
    unseen = F.col("n") * F.lit(float(-np.log10(model.vocabulary.tail_total())))
    within = F.when(F.col("c") > 0, F.col("path")).otherwise(unseen)
    per = met.groupBy("doc", "part").agg(
        F.count_if(whole).alias("times"),
        F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("known"),
        F.max("base").alias("base"),
        F.max("score").alias("score"),
        F.coalesce(F.sum(F.when(~whole, share_)), F.lit(0.0)).alias("more"),
        F.coalesce(F.sum(F.when(~whole, within)), F.lit(0.0)).alias("within"),
        F.coalesce(F.sum(F.when(~whole & (F.col("c") > 0), F.col("n"))), F.lit(0)).alias("more_known"),
    )
    # rows repeated entirely have met each word that often
    each = per.withColumn("more", F.col("more") / F.col("times")).withColumn("within", F.col("within") / F.col("times")).withColumn("more_known", (F.col("more_known") / F.col("times")).cast("long"))
    each = each.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return each.select(F.nullif("doc", last).alias("doc_id"), "held_out", "n_tokens", (F.col("known") + F.col("more_known")).alias("n_known"), F.lit(model.vocabulary.n).cast("long").alias("train_tokens"), (F.col("base") + F.col("more")).alias("base_score"), (F.col("score") + F.col("more") + F.col("within")).alias("score"))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out("doc_id", 5, 1))
    learned = docs.where("not held_out").select(F.coalesce("text", F.lit("")).alias("text"))
    counts = cut(learned.mapInArrow(count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    model = train(docs, "not held_out", Vocabulary.of(counts))
    return score(docs, model, counts)
