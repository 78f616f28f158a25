"""Cheapest repairs of conversations by A* on the edit lattice.

A node is a number of rows read and the role last written; edges keep, rerole or delete the next row or insert an
empty one.  The heuristic is a suffix sum: three for each row that must be deleted, one for each truncated row,
which costs that or more whether it stays or goes.  The queue is ordered by (cost plus heuristic, audit), so the
first path to the goal is the cheapest and, of equals, the one with the least audit.  Given the audit, roles
are determined: the grammar leaves one role for each inserted or reroled row.

Rows come sorted, a conversation at a time.  Long ones are cut into blocks of `BLOCK` rows.  The costs between the
four states at a block's ends are sums of small matrices; from the end backwards they give the exact cost to
go at each block's end, and A* then runs in one block after the other.  Rows inserted between two blocks belong
to the later one, so no audit of a block continues another, and the least audit of a block is the start of
the least whole.  Conversations of more than `WHOLE` rows are cut by ranges over many tasks (`repair_long`): each
range gives its cost matrix, costs to go and entry states are passed along the ranges of a conversation (16
numbers a range), and each range is repaired by itself.  Nothing but the SHA-256 of the whole conversation, which can
only be computed from its first to its last byte, and the audit, one value, is made in one place.

Defined results: rows are in the order of turn (nulls first), then role, then text (both after damage).  A null
role or text counts as one space, in `conv_id:turn` too; a null conv_id is a conversation, and is given back as
null.  A role's initial is its first character, none for an empty role.  Repeated rows are duplicates.  A
conversation without rows has zeros, an empty audit and the hash of the empty string.  Role and text are compared by a
64-bit hash where a conversation is cut by ranges, else as they are.  Further columns don't matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from recordspark.llm.common import cut, slices, stored, table

BLOCK, WHOLE = 256, 20_000
#: Long conversations whose ids are broadcast; more are joined by a shuffle.
FEW = 100_000
ORDER = ("turn", "role", "text")
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 60
SPACE = " \t\n\x0b\f\r"
#: What was last written: nothing, a system, a user or an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a role's initial leads to, from each state.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What an inserted or reroled row becomes in each state.
WRITES = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The cost of ending in each state: what must be inserted.
END = (0, 2 * INSERT, INSERT, 0)
#: Role pairs that may follow each other.
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Fact:
    """What repairs need of a row: the initial, and the fault (blank, duplicate, truncated or none)."""

    initial: str
    fault: str

    @property
    def goes(self) -> bool:
        return self.fault in ("blank", "duplicate")

    @property
    def least(self) -> int:
        return DELETE if self.goes else TRUNCATED if self.fault == "truncated" else 0


def fault_of(text: str, seen: bool) -> str:
    kept = text.rstrip(SPACE)
    return "blank" if not kept else "duplicate" if seen else "truncated" if kept[-1] not in ".!?" else ""


def steps(fact: Fact, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, state after, cost) of the edits that read the row."""
    yield "D", state, DELETE
    if not fact.goes:
        charge = TRUNCATED if fact.fault == "truncated" else 0
        if (after := NEXT[state].get(fact.initial)) is not None:
            yield "K", after, charge
        yield "R", WRITES[state], REROLE + charge


def a_star(facts: Sequence[Fact], entry: int, to_go: Sequence[int] | None = None) -> tuple[int, str, int]:
    """Cost, audit and last state of the cheapest edits of the rows, of equals the least audit.

    to_go: what each state costs beyond these rows, where more follow; without it the conversation ends here.
    """
    rest = [0] * (len(facts) + 1)
    for i in range(len(facts) - 1, -1, -1):
        rest[i] = rest[i + 1] + facts[i].least
    n, done, queue = len(facts), set(), [(rest[0], "", 0, entry)]
    while queue:
        value, audit, i, state = heapq.heappop(queue)
        if i > n:
            return value, audit, state
        if (i, state) in done:
            continue
        done.add((i, state))
        cost = value - rest[i]
        if i == n and (to_go[state] < FAR if to_go else END[state] == 0):
            heapq.heappush(queue, (cost + (to_go[state] if to_go else 0), audit, n + 1, state))
        if i < n or not to_go:
            heapq.heappush(queue, (cost + INSERT + rest[i], audit + "I", i, WRITES[state]))
        for edit, after, charge in steps(facts[i], state) if i < n else ():
            heapq.heappush(queue, (cost + charge + rest[i + 1], audit + edit, i + 1, after))
    raise ValueError("a conversation can always be repaired")


def cost_matrix(facts: Iterable[Fact]) -> list[list[int]]:
    """The least cost from each state before the rows to each after them; no rows are inserted behind the last."""
    out = [[0 if a == b else FAR for b in range(4)] for a in range(4)]
    for fact in facts:
        for line in out:
            for state in (SYSTEM, START, USER, ASSISTANT, USER):  # inserted before the row; user and assistant take turns
                line[WRITES[state]] = min(line[WRITES[state]], line[state] + INSERT)
            new = [FAR] * 4
            for state in range(4):
                for _, after, charge in steps(fact, state):
                    new[after] = min(new[after], line[state] + charge)
            line[:] = new
    return out


def before(matrix: Sequence[Sequence[int]], to_go: Sequence[int]) -> list[int]:
    """Costs to go before rows from those behind them."""
    return [min(FAR, *(c + g for c, g in zip(line, to_go, strict=True))) for line in matrix]


def repair(facts: Sequence[Fact], entry: int = START, to_go: Sequence[int] | None = None) -> tuple[int, str, int]:
    """As `a_star`, for any number of rows."""
    if len(facts) <= BLOCK:
        return a_star(facts, entry, to_go)
    blocks = [facts[i : i + BLOCK] for i in range(0, len(facts), BLOCK)]
    behind: list[Sequence[int] | None] = [to_go]
    for b in reversed(blocks[1:]):
        behind.append(before(cost_matrix(b), behind[-1] or END))
    audits, state, total = [], entry, None
    for b, g in zip(blocks, reversed(behind), strict=True):
        cost, audit, state = a_star(b, state, g)
        total = cost if total is None else total
        audits.append(audit)
    return total, "".join(audits), state


def written(rows: Iterator[tuple[str, str]], audit: str, state: int = START) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows."""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = NEXT[state][role[:1]] if edit == "K" else WRITES[state]
        yield role if edit == "K" else NAMES[state], text


def illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Conversation and rows of sorted batches whose first column is the conversation."""
    rows = (r for b in slices(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=lambda r: r[0])


def _facts(rows: list[tuple[str, str]]) -> list[Fact]:
    seen, out = set(), []
    for row in rows:
        out.append(Fact(row[0][:1], fault_of(row[1], row in seen)))
        seen.add(row)
    return out


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def gaps(turns: set[int]) -> int:
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0


def _reports(kind: pa.DataType) -> Callable:
    names = ["conv_id", *(x.split()[0] for x in REPORT.split(", "))]
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _conversations(batches):
            there = [r for r in group if not r[4]]
            rows = [(r[2], r[3]) for r in there]
            facts = _facts(rows)
            cost, audit, _ = repair(facts)
            digest = hashlib.sha256()
            for i, (role, text) in enumerate(written(iter(rows), audit)):
                digest.update(f"{chr(10) if i else ''}{role}:{text}".encode())
            faults = [sum(f.fault == x for f in facts) for x in ("blank", "duplicate", "truncated")]
            values = [key, gaps({r[1] for r in there} - {None}), *faults, illegal([f.initial for f in facts]), cost, audit, digest.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    return run


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for conv, group in _conversations(batches):
        rows = [(r[2], r[3]) for r in group if not r[4]]
        yield conv, 0, written(iter(rows), repair(_facts(rows))[1])


def _sorted(rows: DataFrame) -> DataFrame:
    spread = rows.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("conv_id", *ORDER)])
    return spread.select("conv_id", *ORDER, "gone")


def repair_short(rows: DataFrame) -> DataFrame:
    """One row a conversation from rows (conv_id, turn, role, text, gone), of which those gone only name their conversation."""
    return _sorted(rows).mapInArrow(_reports(_arrow(rows)), f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {REPORT}")


def _arrow(rows: DataFrame) -> pa.DataType:
    return to_arrow_type(rows.schema["conv_id"].dataType)


# Conversations over many ranges


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range (conv_id, turn, role, text, h) with the range, the place in it, and whether role and text are new in the conversation's part."""
    part, place, key, seen = TaskContext.get().partitionId(), 0, (), set()
    for b in slices(batches):
        new = []
        for conv, h in zip(b.column(0).to_pylist(), b.column(4).to_pylist(), strict=True):
            if (conv,) != key:
                key, seen = (conv,), set()
            new.append(h not in seen)
            seen.add(h)
        columns = [pa.array([part] * b.num_rows, pa.int64()), pa.array(range(place, place + b.num_rows), pa.int64()), pa.array(new, pa.bool_())]
        yield pa.RecordBatch.from_arrays([*b.columns, *columns], [*b.schema.names, "p", "i", "new"])
        place += b.num_rows


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, range), and facts and rows of each conversation's part of a range; batches are (conv_id, p, turn, role, text, dup)."""
    rows = (r for b in slices(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for key, group in groupby(rows, key=lambda r: r[:2]):
        own = list(group)
        yield key, [Fact(r[3][:1], fault_of(r[4], r[5])) for r in own], own


def _matrices(kind: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, p), facts, _ in _pieces(batches):
            faults = [sum(f.fault == x for f in facts) for x in ("blank", "duplicate", "truncated")]
            values = [conv, p, [c for line in cost_matrix(facts) for c in line], *faults, illegal([f.initial for f in facts]), facts[0].initial, facts[-1].initial]
            types = [kind, pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], PIECE.replace(",", " ").split()[::2])

    return run


PIECE = "conv_id X, p long, costs array<long>, blank long, duplicate long, truncated long, illegal long, head string, tail string"


def _costs_to_go(kind: pa.DataType) -> Callable:
    """(conv_id, p, costs), ranges of a conversation from the last to the first: what each state costs behind the range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, behind = (), END
        for b in slices(batches):
            out = []
            for conv, costs in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                key, behind = (conv,), behind if (conv,) == key else END
                out.append(list(behind))
                behind = before([costs[i : i + 4] for i in range(0, 16, 4)], behind)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "p", "to_go"])

    return run


def _audits(kind: pa.DataType) -> Callable:
    """For each part of a conversation and each state before it: cost, audit and state behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in slices(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for (conv, p), group in groupby(rows, key=lambda r: r[:2]):
            own = list(group)
            facts, to_go, last = [Fact(r[3][:1], fault_of(r[4], r[5])) for r in own], own[0][6], own[0][7]
            found = [repair(facts, s, None if last else to_go) for s in range(4)]
            columns = [pa.array([conv], kind), pa.array([p])] + [pa.array([[f[k] for f in found]]) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "p", "cost", "audit", "after"])

    return run


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, p, cost, audit, after), ranges in order: each one's state before it, its audit, and the cost that is left."""
    key, state = (), START
    for b in slices(batches, 16):
        before_, cost, audit = [], [], []
        for conv, costs, audits, after in zip(b.column(0).to_pylist(), *(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            key, state = (conv,), state if (conv,) == key else START
            before_.append(state)
            cost.append(costs[state])
            audit.append(audits[state])
            state = after[state]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(before_, pa.int64()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())], ["conv_id", "p", "state", "cost", "audit"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Conversation, range, repaired rows of sorted batches (conv_id, p, role, text, state, audit), of which the first of a part has its audit and the others its rows."""
    rows = (r for b in slices(batches) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for (conv, p), part in groupby(rows, key=lambda r: r[:2]):
        head = next(part)
        yield conv, p, written(((r[2], r[3]) for r in part), head[5], head[4])


def _hashed(kind: pa.DataType) -> Callable:
    """The SHA-256 of each conversation, one row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, parts in groupby(_parts(batches), key=lambda x: x[0]):
            digest, first = hashlib.sha256(), True
            for role, text in (r for _, _, rows in parts for r in rows):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return run


def _rows(kind: pa.DataType, found: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]) -> Callable:
    """conv_id, part, place, role and text of the repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, p, rows in found(batches):
            numbered = enumerate(rows)
            while some := list(islice(numbered, 512)):
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array([conv] * n, kind), pa.array([p] * n, pa.int64()), pa.array([i for i, _ in some]), pa.array([r for _, (r, _) in some]), pa.array([t for _, (_, t) in some])], ["conv_id", "part", "place", "role", "text"])

    return run


@dataclass(frozen=True)
class Ranges:
    """Long conversations in ranges: their rows with faults, each range's counts and cost matrix, and what was chosen for it."""

    rows: DataFrame
    pieces: DataFrame
    chosen: DataFrame

    def lines(self) -> DataFrame:
        """For `_parts`: each part's state and audit as its first row, then its rows."""
        nothing = lambda kind: F.lit(None).cast(kind)
        heads = self.chosen.select("conv_id", "p", F.lit(-1).cast("long").alias("i"), nothing("string").alias("role"), nothing("string").alias("text"), "state", "audit")
        return heads.unionByName(self.rows.select("conv_id", "p", "i", "role", "text", nothing("long").alias("state"), nothing("string").alias("audit")))


def in_ranges(rows: DataFrame, size: int = WHOLE) -> Ranges:
    """Repair long conversations in ranges of about `size` rows."""
    name, kind = rows.schema["conv_id"].dataType.simpleString(), _arrow(rows)
    by = [F.col(c).asc_nulls_first() for c in ("conv_id", *ORDER)]
    told = stored(rows.select("conv_id", *ORDER, F.xxhash64("role", F.lit(":"), "text").alias("h"), F.monotonically_increasing_id().alias("_id")))
    ranges = told.repartitionByRange(max(1, -(-told.count() // size)), *by, "_id").sortWithinPartitions(*by, "_id").drop("_id")
    parts = cut(ranges.mapInArrow(_marked, f"conv_id {name}, turn long, role string, text string, h long, p long, i long, new boolean"))
    # of the parts in which role and text are new, only the first keeps them
    first = parts.where("new").groupBy(F.col("conv_id").alias("_c"), F.col("h").alias("_h")).agg(F.min("p").alias("least"))
    later = parts.where("new").join(first, (F.col("h") == F.col("_h")) & F.col("conv_id").eqNullSafe(F.col("_c"))).where(F.col("p") > F.col("least")).select(F.col("p").alias("_p"), F.col("i").alias("_i"))
    marked = parts.join(later, (F.col("p") == F.col("_p")) & (F.col("i") == F.col("_i")), "left")
    facts = cut(marked.select("conv_id", "p", "i", "turn", "role", "text", (~F.col("new") | F.col("_p").isNotNull()).alias("dup")).repartition("p").sortWithinPartitions("p", "i"))
    pieces = cut(facts.select("conv_id", "p", "turn", "role", "text", "dup").mapInArrow(_matrices(kind), PIECE.replace("X", name)))
    along = lambda df, p: df.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), p)  # noqa: E731  one row a range
    behind = along(pieces.select("conv_id", "p", "costs"), F.desc("p")).mapInArrow(_costs_to_go(kind), f"conv_id {name}, p long, to_go array<long>")
    final = pieces.groupBy(F.col("conv_id").alias("_c")).agg(F.max("p").alias("last"))
    ahead = behind.join(final, F.col("conv_id").eqNullSafe(F.col("_c"))).select(F.col("conv_id").alias("_k"), F.col("p").alias("_p"), "to_go", (F.col("p") == F.col("last")).alias("_last"))
    known = facts.join(ahead, (F.col("p") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_k"))).repartition("p").sortWithinPartitions("p", "i")
    audits = known.select("conv_id", "p", "turn", "role", "text", "dup", "to_go", "_last").mapInArrow(_audits(kind), f"conv_id {name}, p long, cost array<long>, audit array<string>, after array<long>")
    chosen = cut(along(audits, "p").mapInArrow(_chosen, f"conv_id {name}, p long, state long, cost long, audit string"))
    return Ranges(facts, pieces, chosen)


def repair_long(rows: DataFrame, size: int = WHOLE) -> DataFrame:
    """As `repair_short`, for rows that are there, in ranges of about `size` rows."""
    name, kind, found = rows.schema["conv_id"].dataType.simpleString(), _arrow(rows), in_ranges(rows, size)
    ordered = found.lines().repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "p", "i")
    digests = ordered.drop("i").mapInArrow(_hashed(kind), f"conv_id {name}, repaired_sha256 string")
    turns = found.rows.groupBy("conv_id", "turn").count().groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("g"))
    counts = found.pieces.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.array_sort(F.collect_list(F.struct("p", "head", "tail"))).alias("ends"))
    pairs = F.transform(F.col("ends"), lambda x, i: (i > 0) & ~F.concat(F.get("ends", i - 1)["tail"], x["head"]).isin(*LEGAL))
    whole = found.chosen.groupBy("conv_id").agg(F.min_by("cost", "p").alias("cost"), F.array_sort(F.collect_list(F.struct("p", "audit"))).alias("audits"))
    out = counts
    for k, t in enumerate((turns, digests, whole)):
        out = out.join(t.withColumnRenamed("conv_id", f"_c{k}"), F.col("conv_id").eqNullSafe(F.col(f"_c{k}")))
    meets = F.size(F.filter(pairs, lambda x: F.coalesce(x, F.lit(False))))
    return out.select("conv_id", F.coalesce("g", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", (F.col("illegal") + meets).alias("illegal"), "cost", F.array_join(F.col("audits.audit"), "").alias("audit"), "repaired_sha256")


def _by_length(rows: DataFrame, whole: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations of at most `whole` rows, and the rows that are there of longer ones, if any."""
    long = cut(rows.groupBy("conv_id").agg(F.count_if(~F.col("gone")).alias("n")).where(F.col("n") > whole).select(F.col("conv_id").alias("_c")))
    n = long.limit(FEW + 1).count()
    if not n:
        return rows, None
    long, is_long = F.broadcast(long) if n <= FEW else long, F.col("conv_id").eqNullSafe(F.col("_c"))
    return rows.join(long, is_long, "left_anti"), rows.join(long, is_long, "left_semi").where("not gone")


def report(rows: DataFrame, whole: int = WHOLE) -> DataFrame:
    """One row for each conversation of rows (conv_id, turn, role, text, gone): its faults, the cheapest repair and the hash of the repaired rows."""
    short, long = _by_length(rows, whole)
    return repair_short(short) if long is None else repair_short(short).unionByName(repair_long(long, whole))


def repaired(rows: DataFrame, whole: int = WHOLE) -> DataFrame:
    """The repaired rows themselves: conv_id, part and place (their order), role and text."""
    short, long = _by_length(rows, whole)
    schema, kind = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, part long, place long, role string, text string", _arrow(rows)
    out = _sorted(short).mapInArrow(_rows(kind, _short), schema)
    if long is None:
        return out
    lines = in_ranges(long, whole).lines().repartition("p").sortWithinPartitions("p", F.col("conv_id").asc_nulls_first(), "i")
    return out.unionByName(lines.drop("i").mapInArrow(_rows(kind, _parts), schema))


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, gone) of the query: one in five or so spoilt, by crc32(conv_id:turn) % 20."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(how == 1, F.lit("")).when(how == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    out = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(how == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"), (how == 0).alias("gone"), F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_times"))
    return out.withColumn("_times", F.explode("_times")).drop("_times")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(damage(table(spark, sf_dir, "conversations")))
