"""Sharding, conversation repair and vector codes against brute force on small tables of odd cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordspark.llm import conversation_repair, queries, sharding, vector_codes
from recordspark.llm.conversation_repair import Fact

# 11


def placed_by_brute_force(rows, shards, slack):
    """(doc_id, size, crc, hash) in order: shard and slot of each, with groups of (hash, size, crc)."""
    rows = sorted(rows, key=lambda r: (r[3], r[1], r[2], r[0] is not None, r[0] or 0))
    starts, at = [], 0
    for r in rows:
        starts.append(at)
        at += r[1]
    extent = {}
    for r, b in zip(rows, starts):
        first, _ = extent.get(r[1:], (b, 0))
        extent[r[1:]] = first, b + r[1]
    cuts = []
    for k in range(1, shards):
        t = at * k // shards
        i = max(j for j, b in enumerate(starts) if b <= t)
        low, high = starts[i], starts[i] + rows[i][1]
        g = extent[rows[i][1:]]
        if g[1] - g[0] <= slack * at / shards:
            low, high = g
        cuts.append(low if t - low <= high - t else high)
    out, slots = [], {}
    for r, b in zip(rows, starts):
        shard = sum(c <= b for c in cuts)
        out.append((r[0], r[1], r[2], shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
    return out


def check_shards(spark, docs, shards):
    facts = [tuple(r) for r in sharding.text_facts(docs).collect()]
    want = placed_by_brute_force(facts, shards, sharding.SLACK)
    got = [tuple(r) for r in sharding.shard_documents(docs, shards).collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_shards(spark, docs, rows, none, monkeypatch):
    for shards in (1, 3, 8, 200):
        got = check_shards(spark, docs, shards)
        assert len(got) == len(rows)
    sizes = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows}
    assert {r[:3] for r in got} == sizes
    assert sharding.shard_documents(none).count() == 0
    monkeypatch.setattr(sharding, "RANGE", 5)  # many ranges
    check_shards(spark, docs, 8)


def test_shards_of_hot_groups_are_even(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE", 200)
    rows = [(i, f"text {i} " + "word " * (i % 30)) for i in range(1200)] + [(2000 + i, "one text of many") for i in range(600)] + [(None, "x")] * 300 + [(5000 + i // 3, f"copy {i // 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = check_shards(spark, docs, 8)
    total, per = sum(r[1] for r in got), {}
    for r in got:
        per.setdefault(r[3], []).append(r)
    assert all(abs(sum(r[1] for r in p) - total / 8) <= total / 8 * sharding.SLACK + 200 for p in per.values())
    assert all(sorted(r[4] for r in p) == list(range(len(p))) for p in per.values())
    where = {}
    for r in got:
        where.setdefault((r[1], r[2]), set()).add(r[3])
    assert all(len(where[k]) == 1 for k in where if k[1] in {zlib.crc32(f"copy {i}".encode()) for i in range(300)})


def test_written_shards_hold_the_rows_in_order(spark, docs, rows, tmp_path):
    other = docs.withColumnsRenamed({"_row": "size"})  # a name that the operator uses
    sharding.write_shards(other, f"file://{tmp_path}/shards", 4)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    assert set(back.columns) == {*other.columns, "shard", "slot"} and back.count() == len(rows)
    assert sorted(map(str, back.select(*other.columns).collect())) == sorted(map(str, other.collect()))
    for shard in {r[0] for r in back.select("shard").distinct().collect()}:
        assert sorted(r[0] for r in back.where(F.col("shard") == shard).select("slot").collect()) == list(range(back.where(F.col("shard") == shard).count()))
    with pytest.raises(ValueError, match="slot"):
        sharding.write_shards(docs.withColumnRenamed("_row", "slot"), f"file://{tmp_path}/other", 4)


# 12
AFTER = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
WRITES = {0: 2, 1: 2, 2: 3, 3: 2}
NAMES = {2: "user", 3: "assistant"}


def cheapest(facts):
    """(cost, audit) by dynamic programming over whole audits."""

    def inserted(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                best[WRITES[s]] = min(best.get(WRITES[s], (1 << 40, "")), (c + 2, a + "I"))
        return best

    best = {0: (0, "")}
    for initial, fault in facts:
        best, new = inserted(best), {}
        for s, (c, a) in best.items():
            edits = [(s, c + 3, "D")]
            if fault not in ("blank", "duplicate"):
                c += fault == "truncated"
                edits += [(AFTER[s][initial], c, "K")] if initial in AFTER[s] else []
                edits.append((WRITES[s], c + 2, "R"))
            for t, cost, e in edits:
                new[t] = min(new.get(t, (1 << 40, "")), (cost, a + e))
        best = new
    best = inserted(best)
    return min(best[s] for s in (0, 3) if s in best)


def reports(rows):
    text = lambda x: " " if x is None else str(x)
    conversations, out = {}, {}
    for conv, turn, role, body in rows:
        how, own = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20, conversations.setdefault(conv, [])
        body = "" if how == 1 else re.sub("[.!?]", "", text(body)) if how == 2 else text(body)
        own += [(turn, "user" if how == 4 else text(role), body)] * (0 if how == 0 else 2 if how == 3 else 1)
    for conv, own in conversations.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, facts, lines, state, it = set(), [], [], 0, iter(own)
        for _, role, body in own:
            kept = re.findall(r"[^\x20\x09-\x0D]", body)
            facts.append((role[:1], "blank" if not kept else "duplicate" if (role, body) in seen else "truncated" if kept[-1] not in ".!?" else ""))
            seen.add((role, body))
        cost, audit = cheapest(facts)
        for e in audit:
            _, role, body = ("", "", "") if e == "I" else next(it)
            if e != "D":
                state = AFTER[state][role[:1]] if e == "K" else WRITES[state]
                lines.append(f"{role if e == 'K' else NAMES[state]}:{body}")
        turns = {t for t, _, _ in own if t is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[sum(f == x for _, f in facts) for x in ("blank", "duplicate", "truncated")])
        out[conv] += sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(facts, facts[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return out


def test_cheapest_edits(monkeypatch):
    rng = random.Random(3)
    for block in (1, 2, 3, 256):
        monkeypatch.setattr(conversation_repair, "BLOCK", block)
        for _ in range(400):
            facts = [(rng.choice(["s", "u", "a", "x", ""]), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(15))]
            cost, audit, _ = conversation_repair.repair([Fact(*f) for f in facts])
            assert (cost, audit) == cheapest(facts)


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(4)
    rows = [(None, None, None, None), (None, None, "user", "x"), (None, 3, "user", "same."), (7, None, "", ""), (7, 1, "system", "Hi."), (7, 1, "user", "Hi."), (7, 2, "tool", "run"), (7, 1, "system", "Hi.")]
    rows += [(8, rng.choice([None, *range(60)]), rng.choice(["user", "assistant", "system", None, "x"]), rng.choice(["a.", "b!", "c", " ", None, "long ú?", "\n"])) for _ in range(300)]
    rows += [(9, 1, "user", "the same row.")] * 150 + [(10, 1, "user", "long " * 20_000)]
    gone = next(i for i in range(100, 500) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "dropped.")]


@pytest.mark.parametrize("whole", [20_000, 60, 5])
def test_conversations(spark, talks, whole):
    df = conversation_repair.damage(spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").repartition(3))
    want = reports(talks)
    assert {r[0]: tuple(r[1:]) for r in conversation_repair.report(df, whole).collect()} == want
    lines = {}
    for r in sorted(conversation_repair.repaired(df, whole).collect(), key=lambda r: (r["part"], r["place"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(lines.get(k, [])).encode()).hexdigest() == want[k][-1] for k in want)


def test_conversations_of_the_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in queries.QUERIES["op12_conversation_repair"](spark, sf).collect()} == reports(rows)
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string, gone boolean")
    assert conversation_repair.report(conversation_repair.damage(empty)).count() == 0


# 13
def lloyd(rows, parts=8, entries=16, rounds=6):
    """(key, vector, label) of whole vectors: code, error, label error and digest by plain rounds."""
    width = max((len(v) for _, v, _ in rows), default=0)
    x = [[int(np.floor(4096 * float(c))) for c in v] + [0] * (width - len(v)) for _, v, _ in rows]
    cuts = [(j * width // parts, (j + 1) * width // parts) for j in range(parts)]
    firsts = {}
    for (k, _, _), v in zip(rows, x):
        firsts[k] = min(firsts.get(k, v), v)
    first = [firsts[k] for k in sorted(firsts, key=lambda k: (k is None, k or 0))[:entries]]
    books = [[v[a:z] for v in first] for a, z in cuts]
    far = lambda p, q: sum((s - t) ** 2 for s, t in zip(p, q))
    nearest = lambda: [[min(range(len(first)), key=lambda e: (far(v[a:z], books[j][e]), e)) for j, (a, z) in enumerate(cuts)] for v in x]
    for _ in range(rounds):
        codes = nearest()
        for j, (a, z) in enumerate(cuts):
            for e in range(len(first)):
                own = [v[a:z] for v, c in zip(x, codes) if c[j] == e]
                books[j][e] = [sum(p) // len(own) for p in zip(*own)] if own else books[j][e]
    codes = nearest()
    errors = [sum(far(v[a:z], books[j][c[j]]) for j, (a, z) in enumerate(cuts)) for v, c in zip(x, codes)]
    per = {}
    for (_, _, label), e in zip(rows, errors):
        per[label] = per.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(k), bytes(c).hex(), e, per[label], digest) for (k, _, label), c, e in zip(rows, codes, errors))


def coded(df):
    found, books = vector_codes.encode(df.select("vec_id", "label", "embedding"))
    flat = found.select(F.col("row.c0").alias("vec_id"), F.col("row.c1").alias("label"), F.lower(F.hex("code")).alias("code"), "error")
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], books.digest()) for r in vector_codes.with_label_error(flat).collect()), books


def test_vector_codes(spark):
    rng = np.random.default_rng(7)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=24).round(1)], int(i % 3) if i % 5 else None) for i in range(150)]
    good += [good[3], good[3], (2, good[9][1], 1), (None, good[11][1], 2)] + [(200 + i, good[0][1], 7) for i in range(60)]
    bad = [(300, None, 1), (301, [None, *good[0][1][1:]], 1), (302, [float("nan")] + good[0][1][1:], 1), (303, [float("-inf")] + good[0][1][1:], None)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>, label int").repartition(4)
    got, books = coded(df)
    assert got == lloyd(good)
    assert len(books.decode(got[0][1])) == 24
    short = [(i, [float(c) for c in rng.normal(size=1 + i % 13)], None) for i in range(9)] + [(3, [], None)]
    assert coded(spark.createDataFrame(short, "vec_id long, embedding array<double>, label int"))[0] == lloyd(short)
    assert coded(df.limit(0))[0] == [] and coded(spark.createDataFrame(bad, df.schema))[0] == []
    huge, _ = coded(spark.createDataFrame([(1, [1e30, -1e300], 1), (2, [0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int"))
    assert len(huge) == 2  # beyond the limit, but defined


def test_bounds_save_scans_and_keep_ties():
    rng = np.random.default_rng(2)
    centres = rng.integers(-3000, 3000, (4, 6, 8))
    x = np.concatenate([centres[:, rng.integers(0, 6)][None] + rng.integers(-200, 200, (1, 4, 8)) for _ in range(500)])
    book, before, state, scans = centres + rng.integers(-300, 300, centres.shape), None, (None, None, None), []
    for _ in range(6):
        *state, scanned = vector_codes.Step(book, before).assign(x, *state)
        scans.append(scanned)
        far = ((x[:, :, None] - book[None]) ** 2).sum(3)
        assert (state[0] == far.argmin(2)).all()
        assert (state[1].astype(float) ** 2 >= far.min(2)).all() and (state[2].astype(float) <= np.sqrt(np.sort(far, 2)[:, :, 1])).all()
        before, book = book, book.copy()
        for j in range(4):
            for e in range(6):
                if (state[0][:, j] == e).any():
                    book[j, e] = x[state[0][:, j] == e, j].sum(0) // (state[0][:, j] == e).sum()
    assert scans[0] == 2000 and sum(scans[1:]) < 0.2 * 5 * 2000


def test_queries_of_the_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = queries.QUERIES["op13_vector_codes"](spark, sf).collect()
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == lloyd(rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = placed_by_brute_force([tuple(r) for r in sharding.text_facts(docs).collect()], 8, sharding.SLACK)
    got = queries.QUERIES["op11_sharding"](spark, sf).collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "size", "text_crc32", "shard", "slot")) for r in got) == sorted(want)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("bytes", None)}
