"""Operators against brute force on a small fixture of odd cases, and on empty tables."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from recordspark.llm import jaccard_join, language_id, maxent_lm, mixing, nearest, packed, quality_model, quality_rules, secret_scan, segmentation, substring_dedup
from recordspark.llm.common import held_out

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def by_row(df):
    return collections.Counter(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())


# 5
def test_quality_counts(docs, rows, none, spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    want = collections.Counter()
    for doc_id, t, *_ in rows:
        w, t = words(t), t or ""
        g = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j + k for j, x in enumerate(zip(w, w[1:], w[2:])) if g[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want[(doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed, not failed)] += 1
    assert by_row(quality_rules.judge(docs, labels)) == want
    assert by_row(quality_rules.keep(docs, labels)) == collections.Counter(r for r in rows if len(words(r[1])) >= 50 and not want[(r[0],)] and any(k[0] == r[0] and k[1] == len(words(r[1])) and k[7] for k in want))
    assert quality_rules.judge(none, labels).count() == 0
    assert quality_rules.judge(docs, labels.limit(0)).where("kept").count() == sum(n for k, n in want.items() if k[7])


def test_binomial_tail(spark):
    for k, n, p in ((0, 10, 0.1), (3, 50, 0.02), (40, 5000, 0.01), (700, 100000, 0.0075)):
        exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        assert got == pytest.approx(exact, rel=1e-7)


def test_thresholds_reject_only_what_is_safe(spark):
    # 4,000 good documents without symbols, 400 bad ones with many
    texts = [(i, " ".join(["word", "other", "thing", "more"][j % 4] + str((i * 7 + j) % 900) + ("#|" if i % 11 == 0 else "") for j in range(60)), int(i % 11 != 0)) for i in range(4400)]
    df = spark.createDataFrame(texts, "doc_id long, text string, quality int").repartition(4)
    got = quality_rules.judge(df.select("doc_id", "text"), df.select("doc_id", "quality")).collect()
    assert all(r["kept"] == (r["doc_id"] % 11 != 0) for r in got)


def test_thresholds_act_and_keep_the_risk_on_held_out_labels(spark):
    """Cutoffs from half of the labels: they reject low quality, and of the other half's good documents no more than the risk."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").cache()
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    counted = quality_rules.cut(quality_rules.features(docs.select("doc_id", "text")).select("doc_id", *quality_rules.FEATURES))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    cutoffs = quality_rules.cut(quality_rules.thresholds(counted, labels.where(half == 0)))
    assert cutoffs.count() == quality_rules.STRATA and cutoffs.where("_cut > 0").count() == quality_rules.STRATA
    seen = quality_rules.with_verdict(counted, cutoffs).where("not _failed").join(labels.where(half == 1), "doc_id").groupBy("quality").agg(F.count_if(~F.col("_kept")).alias("rejected"), F.count("*").alias("n"))
    seen = {r["quality"]: (r["rejected"], r["n"]) for r in seen.collect()}
    assert seen[1][0] <= quality_rules.RISK * seen[1][1] and seen[0][0] >= 0.9 * seen[0][1]


def test_thin_strata_are_merged(spark):
    grid = lambda *n: spark.createDataFrame([(i, 1, x) for i, x in enumerate(n)], "stratum int, step int, good long")
    groups = lambda *n: [r["group"] for r in quality_rules.merged(grid(*n), 228).orderBy("stratum").collect()]
    assert groups(300, 300, 300, 300, 300) == [4, 3, 2, 1, 0]
    assert groups(300, 300, 300, 200, 44) == [3, 2, 1, 0, 0]
    assert groups(10, 300, 300, 0, 44) == [1, 1, 0, 0, 0]
    assert groups(5, 5, 5, 5, 5) == [0] * 5


# 10
def test_language_id(spark, docs, rows, none):
    rng = np.random.default_rng(1)
    de, en = ["der", "und", "nicht", "straße", "kleine", "über", "haus"], ["the", "and", "not", "street", "little", "over", "house"]
    texts = [(i, " ".join(rng.choice(de if i % 2 else en, 40)), "de" if i % 2 else "en") for i in range(80)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumn("held_out", held_out("doc_id", 3, 1))
    contents = language_id.dictionaries(df, "not held_out")
    assert [x for x, _ in contents] == ["de", "en"]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(df, contents).collect()}
    assert got == {i: lang for i, _, lang in texts}
    # plain zstandard, one dictionary after the other
    for i, t, _ in texts[:20]:
        size = {}
        for lang, content in contents:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            size[lang] = len(zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=d, write_content_size=False).compress(language_id.PRIME + t.lower().encode() + b" "))
        assert min(size, key=size.get) == got[i] and abs(size["de"] - size["en"]) > language_id.NARROW * min(size.values())
    # a common header doesn't fill the dictionaries
    header = df.withColumn("text", F.concat(F.lit("same header again " * 400), "text"))
    assert all(len(set(c.split())) > 5 for _, c in language_id.dictionaries(header, "not held_out"))
    odd = language_id.identify(docs.withColumn("held_out", F.lit(False)), contents).collect()
    assert len(odd) == len(rows) and all((r["lang_pred"] == "und") == (r["score"] == 0 and r["lang_pred"] not in ("de", "en")) for r in odd)
    assert language_id.dictionaries(none.withColumn("held_out", F.lit(False)), "not held_out") == []
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("held_out", F.lit(False)), []).collect()} == {"und"}


# 3
def test_secrets_planted_in_documents(spark):
    """Free-standing random strings are found by the method, without a word that names them; documents without one stay clean."""
    rng = np.random.default_rng(31)
    syllables = "an be cor dif er fu ga hi jo ki lo mu na op qu re si ta un vo wi xe ya zo".split()
    prose = lambda n: ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)]
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    rows, planted = [], {}
    for i in range(240):
        w = prose(120)
        if i % 3 == 0:
            planted[i] = "".join(rng.choice(letters, int(rng.integers(20, 41))))
            w.insert(int(rng.integers(0, 120)), planted[i])
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found, clean, base = 0, 0, 0
    for r in secret_scan.scan(docs, secret_scan.train(docs)).collect():
        text, spans = rows[r["doc_id"]][1], [x.split(":") for x in r["spans"].split(",") if x]
        markov = [text[int(a) : int(z)] for kind, a, z in spans if kind == "markov"]
        base += r["n_assign"] + r["n_access"]
        if r["doc_id"] in planted:
            found += planted[r["doc_id"]] in markov
        else:
            clean += not spans
    assert base == 0 and found >= 0.95 * len(planted) and clean == 160


def test_secrets(docs, rows, none, spark):
    rng = np.random.default_rng(8)
    syllables = "an be cor dif er fu ga hi jo ki lo mu na op qu re si ta un vo wi xe ya zo".split()
    corpus = spark.createDataFrame([(" ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(400)),) for _ in range(40)], "text string")
    odds = secret_scan.train(corpus.union(docs.select("text")))
    for r in secret_scan.scan(docs, odds).collect():
        texts = [t or "" for i, t, *_ in rows if i == r["doc_id"]]
        found = []
        for t in texts:
            spans = []
            for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
                spans += [(m.start(), 0, f"assign:{m.start()}:{m.end()}")] if len(m[2]) >= 12 else []
            spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
            spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
            base = ",".join(x[2] for x in sorted(spans))
            found.append((hashlib.sha256(base.encode()).hexdigest(), set(base.split(",")) - {""}))
        mine = [b for h, b in found if h == r["base_sha256"]]
        assert mine and any(b <= set(r["spans"].split(",")) for b in mine)
    random_key = next(i for i, t, *_ in rows if t and t.startswith("key q9Zk"))
    assert "markov" in next(r["spans"] for r in secret_scan.scan(docs, odds).collect() if r["doc_id"] == random_key)
    mean = lambda x: (lambda c: odds[c[:-1], c[1:]].mean())(secret_scan.codes(x))
    held_words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(500)]
    assert np.mean([mean(x) > secret_scan.CUTOFF for x in secret_scan.generated(1000, seed=99)]) >= 0.97
    assert max(mean(x) for x in secret_scan.compounds(held_words, 1000, seed=98) if len(x) >= secret_scan.MIN_CHARS) < secret_scan.CUTOFF
    # the ratio alone decides: no digit is needed, short strings have a larger cutoff, and paths are ordinary
    marks = lambda t: [t[a:z] for a, _, z in secret_scan.find(t, odds)[1]]
    letters = "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), 32))
    short = "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), 16))
    assert marks(f"see {letters} and {short}") == [letters, short]
    assert marks("/".join(held_words[:6]) + "/17 " + "+".join(held_words[6:12]) + " " + "".join(held_words[12:20])) == []
    assert secret_scan.cutoff_of(16) > secret_scan.cutoff_of(20) == secret_scan.cutoff_of(200)
    clean = [r for r in secret_scan.scan(docs, odds).collect() if r["doc_id"] is not None and r["doc_id"] < 14]
    assert all(r["spans"] == "" for r in clean)
    out = secret_scan.redact(docs, odds)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert out.where("text like '%0123456789abcdef%' or text like '%hunter2%'").count() == 0
    assert secret_scan.scan(none, secret_scan.train(none)).count() == 0 and secret_scan.redact(none, odds).count() == 0


# 4
def sets_of(rows):
    out = []
    for i, t, *_ in rows:
        w = words(lower(t))
        out.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    return out


def test_jaccard_components(docs, rows, none):
    vertices = sets_of(rows)
    parent = list(range(len(vertices)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(vertices)):
        for b in range(a):
            (i, x), (j, y) = vertices[a], vertices[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(vertices):
        if i is not None:
            low[find(a)] = min(i, low.get(find(a), i))
    want = collections.Counter((i, len(x), low[find(a)] if i is not None else None) for a, (i, x) in enumerate(vertices))
    assert by_row(jaccard_join.classes(docs)) == want
    # one row of each class stays, and all rows that have no shingles or no doc_id
    kept = jaccard_join.one_row_of_each(docs)
    assert kept.columns == docs.columns
    alone = [i for i, x in vertices if i is None or not x]
    one = [low[c] for c in {find(a) for a, (i, x) in enumerate(vertices) if i is not None and x}]
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(alone + one)
    assert jaccard_join.classes(none).count() == 0 and jaccard_join.one_row_of_each(none).count() == 0


def test_columns_with_names_of_the_join_s_own_stay_as_they_are(docs):
    names = ["_mark", "mark", "doc", "row", "stays", "rows", "node", "first", "least"]
    odd = docs.withColumns({c: F.lit(i) for i, c in enumerate(names)})
    kept = jaccard_join.one_row_of_each(odd)
    assert kept.columns == odd.columns and all(tuple(r[c] for c in names) == tuple(range(len(names))) for r in kept.collect())
    assert kept.count() == jaccard_join.one_row_of_each(docs).count()


def test_what_is_settled_of_rows_without_an_id_is_spread():
    rng, last = np.random.default_rng(4), (1 << 63) - 1
    sender = substring_dedup._Sender(True, 64)
    key = np.repeat(rng.integers(0, 1 << 62, 2000, dtype=np.int64).view(np.uint64), 2)
    list(sender.add(key, np.full(4000, last), rng.integers(-(1 << 62), 1 << 62, 4000), rng.integers(0, 100, 4000)))
    sent = [b for b in sender.flush() if b.column(4).null_count == 0]
    buckets = collections.Counter(x for b in sent for x in b.column(0).to_pylist())
    assert sum(buckets.values()) == 4000 and len(buckets) == 64 and max(buckets.values()) < 3 * 4000 / 64


def test_near_duplicates_keep_unlinked_rows_of_one_id(spark):
    """A doc_id with many different texts loses only what is linked with another row."""
    import corpus_pipeline

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(5, text(k), "s1") for k in range(30)] + [(i, text(100 + i), "s2") for i in range(10, 30)]
    rows += [(3, text(0) + " tail", "s1"), (5, text(110), "s1"), (6, text(1), "s1"), (5, text(2), "s1"), (5, "", "s1"), (5, None, "s1"), (None, text(3), "s1"), (None, text(3), "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    gone = collections.Counter([(5, text(0), "s1"), (10, text(110), "s2"), (6, text(1), "s1"), (5, text(2), "s1")])
    assert by_row(kept) == collections.Counter(rows) - gone


@pytest.mark.parametrize("cell", [512, 3])
def test_jaccard_near_the_threshold(spark, monkeypatch, cell):
    """Random sets of shared and own words around 80 %; with long lists dealt to several tasks, too."""
    monkeypatch.setattr(jaccard_join, "LIST_CELL", cell)
    import random

    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(50)}"
        rows.append((i, " ".join(w[: rng.randrange(90, 121)])))
    v = sets_of(rows)
    label = {i: i for i, _ in v}
    changed = True
    while changed:
        changed = False
        for i, x in v:
            for j, y in v:
                if label[j] < label[i] and 100 * len(x & y) >= 80 * len(x | y):
                    label[i], changed = label[j], True
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == label


# 2
def test_packed_buckets():
    """Buckets come back whole, in one part or in several."""
    rng = np.random.default_rng(7)
    for bits in (48, 64):
        key = np.sort(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) >> np.uint64(64 - bits))
        bucket, blocks = packed.pack_buckets(key, bits, 6, np.arange(5000))
        assert bucket.tolist() == list(range(6))
        for most in (1 << 23, 100):
            parts = [list(packed.unpack_bucket(b, [p, p], 2, bits, 6, most)) for b, p in zip(bucket.tolist(), blocks, strict=True)]
            got = sorted((int(k), int(i)) for x in parts for k_, i_ in x for k, i in zip(k_, i_, strict=True))
            assert got == sorted(2 * list(zip(key.tolist(), range(5000), strict=True)))
            assert all(len(x) == 1 for x in parts) if most > 100 else all(len(x) > 10 and max(len(k) for k, _ in x) < 300 for x in parts)


def test_substring_dedup(docs, rows, none):
    keyed = {}
    for i, t, *_ in rows:
        keyed.setdefault((i is None, i or 0, t), (i, t))
    # rows that share an id (or have none) are told apart; which comes first among them is not checked
    clear = [r for r in keyed.values() if r[0] is not None and sum(k[1] == r[0] and not k[0] for k in keyed) == 1]
    got = {}
    for r in substring_dedup.deduplicate(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], r["n_removed"], r["kept_sha256"]))
    assert sum(map(len, got.values())) == len(rows)
    seen = {}
    for k in sorted(keyed, key=lambda k: (k[0], k[1], k[2] or "")):
        i, t = keyed[k]
        w, gone = words(t), set()
        for j in range(len(w) - 19):
            x = tuple(w[j : j + 20])
            if x in seen:
                gone.update(range(j, j + 20))
            seen.setdefault(x, i)
        if (i, t) in clear:
            kept = " ".join(x for j, x in enumerate(w) if j not in gone)
            assert set(got[i]) == {(len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())}
    assert substring_dedup.deduplicate(none).count() == 0
    assert substring_dedup.deduplicate(docs, texts=True).columns == ["doc_id", "n_words", "n_removed", "text"]


# 1
def test_language_model(docs, rows, none):
    d = docs.select("doc_id", "text").withColumn("held_out", held_out("doc_id", 5, 1))
    counts = maxent_lm.cut(d.where("not held_out").select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(maxent_lm.count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    model = maxent_lm.train(d, "not held_out", maxent_lm.Vocabulary.of(counts))
    got = maxent_lm.score(d, model, counts).collect()
    c, texts = collections.Counter(), []
    for i, t, *_ in rows:
        held = i is None or zlib.crc32(str(i).encode()) % 5 == 1
        w = [*words(lower(t)), None]
        texts.append((i, held, w))
        if not held:
            c.update(w)
    n, v = sum(c.values()), len(c)
    want = collections.Counter((i, held, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4)) for i, held, w in texts)
    assert collections.Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 4)) for r in got) == want
    assert sum(r["score"] for r in got if not r["held_out"]) > sum(r["base_score"] for r in got if not r["held_out"])
    e = none.select("doc_id", "text").withColumn("held_out", held_out("doc_id", 5, 1))
    empty = maxent_lm.Vocabulary.of(counts.limit(0))
    assert maxent_lm.score(e, maxent_lm.train(e, "not held_out", empty), counts.limit(0)).count() == 0
    assert maxent_lm.score(d, maxent_lm.train(e, "not held_out", empty), counts.limit(0)).count() == len(rows)


def test_language_model_learns_words_outside_the_classes(spark):
    """4,000 words less frequent than MODEL_WORDS others, in fixed pairs: pairs as learned score better than the same words paired anew."""
    rng = np.random.default_rng(1)
    line = lambda first, then: " ".join(f"a{i} b{j}" for i, j in zip(first, then, strict=True))
    common = " ".join(f"f{i}" for i in range(1100))  # they fill the classes
    lines = [f"{common} {line(x, x)}" for x in (rng.permutation(2000)[:500] for _ in range(240))]
    x = rng.permutation(2000)[:500]
    learned = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string").withColumn("held_out", F.lit(False))
    counts = maxent_lm.cut(learned.select("text").mapInArrow(maxent_lm.count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    model = maxent_lm.train(learned, "not held_out", maxent_lm.Vocabulary.of(counts))
    asked = spark.createDataFrame([(0, line(x, x)), (1, line(x, np.roll(x, 1)))], "doc_id long, text string").withColumn("held_out", F.lit(True))
    got = {r["doc_id"]: r["score"] for r in maxent_lm.score(asked, model, counts).collect()}
    assert got[0] > got[1] + 50


@pytest.mark.parametrize("most", [18, 4])
def test_language_model_tree_sums_to_one(spark, monkeypatch, most):
    """Over all counted words and one unseen word, whatever the weights, and however large the groups are."""
    monkeypatch.setattr(maxent_lm, "MOST_BITS", most)
    rng = np.random.default_rng(2)
    c = rng.integers(1, 500, 20000)
    word = rng.integers(-(1 << 63), 1 << 63, 20000, dtype=np.int64)
    v = maxent_lm.Vocabulary.of(maxent_lm.cut(spark.createDataFrame(list(zip(word.tolist(), c.tolist(), strict=True)), "word long, c long")))
    assert 1 < len(v.groups) <= 1 << most and v.groups.sum() == pytest.approx(v.tail_total() - 0.5)
    t = maxent_lm.Tables.blank(v.rows)
    for x in t.all:
        x += rng.normal(0, 1, x.shape).astype(np.float32)
    m = maxent_lm.Model(v, t)
    h = np.column_stack([np.full(20001, word[3]), np.append(word, 1)]).ravel().view(np.uint64)
    text = np.repeat(np.arange(20001), 2)
    rank, _, p = m.log10(h, text)
    tail = np.flatnonzero((rank < 0) | (rank >= maxent_lm.MODEL_WORDS))
    path = np.zeros(len(h))
    path[tail] = m.tail_log10(h, text, tail)
    p[tail] += path[tail] + np.log10(np.repeat(np.append(c, 0), 2)[tail] + 0.5)
    p[-1] += np.log10(0.5 / v.tail_total()) - path[-1] - np.log10(0.5)
    assert (10 ** p[1::2]).sum() == pytest.approx(1, abs=1e-3)


def test_language_model_scores_are_those_of_a_plain_softmax(spark):
    """Token by token, class by class and branch by branch."""
    rng = np.random.default_rng(12)
    lines = [" ".join(f"w{int(i)}" for i in np.minimum(rng.zipf(1.3, 60), 5000)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").withColumn("held_out", F.lit(False))
    counts = maxent_lm.cut(df.select("text").mapInArrow(maxent_lm.count_words, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")))
    model = maxent_lm.train(df, "not held_out", maxent_lm.Vocabulary.of(counts))
    v, t = model.vocabulary, model.tables
    c = {np.int64(r["word"]).view(np.uint64): r["c"] for r in counts.collect()}
    rank = dict(zip(v.word.tolist(), v.rank.tolist(), strict=True))
    class_prior, word_prior = v.priors()
    assert sum(np.abs(x).sum() > 0 for x in t.all) == 3 and len(v.groups) > 1

    def share(logits, i):
        e = [math.exp(float(x)) for x in logits]
        return math.log(e[i] / sum(e))

    asked = [*lines[:12], "unseen words w1 w2", ""]
    got = {r["doc_id"]: r["score"] for r in maxent_lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").withColumn("held_out", F.lit(True)), model, counts).collect()}
    for i, text in enumerate(asked):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        h, owner = maxent_lm.tokens(maxent_lm.split(data, np.array([0, len(data)]), lower=True))
        one, two = maxent_lm.context(h, owner)
        total = 0.0
        for j, w in enumerate(h):
            s = slice(j, j + 1)
            r = rank.get(int(w), -1)
            group = r // maxent_lm.CLASS_WORDS + 1 if 0 <= r < maxent_lm.MODEL_WORDS else 0
            total += share(class_prior + sum(t.classes[k[0]] for k in maxent_lm.class_features(one[s], two[s], t.rows)), group)
            if group:
                rows = maxent_lm.word_features(one[s], two[s], np.array([group]), t.rows)
                total += share(word_prior[group] + sum(t.words[k[0]] for k in rows), r % maxent_lm.CLASS_WORDS)
                continue
            if w not in c:
                total += math.log(0.5 / v.tail_total())
                continue
            total += math.log((v.tail_total() - 0.5) / v.tail_total())
            for (above, own), prior in zip(v.levels, v.branches(), strict=True):
                node, branch = int(w) >> (64 - above) if above else 0, (int(w) >> (64 - above - own)) & ((1 << own) - 1)
                rows = maxent_lm.word_features(one[s], two[s], np.array([node + (1 << above)]), t.rows)
                total += share(prior[node] + sum(t.nodes[k[0], : 1 << own] for k in rows), branch)
            total += math.log((c[w] + 0.5) / v.groups[int(w) >> (64 - (len(v.groups).bit_length() - 1))])
        assert got[i] == pytest.approx(total / math.log(10), rel=1e-4)


def test_language_model_keeps_texts_of_one_id_apart(spark):
    """Different texts under a null doc_id, and under one that repeats, have their own rows."""
    lines = [(i, " ".join(["w"] * (1 + i // 50) + [f"u{i}"])) for i in range(3000)]
    d = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in lines], "doc_id long, text string").withColumn("held_out", held_out("doc_id", 5, 1))
    counts = maxent_lm.cut(spark.createDataFrame([(1, 1)], "word long, c long"))
    v = maxent_lm.Vocabulary.of(counts)
    got = maxent_lm.score(d, maxent_lm.Model(v, maxent_lm.Tables.blank()), counts).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in got) == collections.Counter((None if i % 2 else 7, len(t.split()) + 1) for i, t in lines)
    assert all(r["base_score"] == pytest.approx(r["n_tokens"] * math.log10(0.5 / v.base_total)) for r in got)


def test_language_model_sums_to_one():
    """Over the words of the model, the counted tail and one unseen word."""
    rng = np.random.default_rng(0)
    word = np.sort(rng.integers(0, 1 << 63, 1500, dtype=np.uint64))
    c = rng.integers(1, 500, 1500)
    rank = np.empty(1500, dtype=np.int64)
    rank[np.argsort(-c, kind="stable")] = np.arange(1500)
    v = maxent_lm.Vocabulary(int(c.sum()), 1500, word, rank, c)
    t = maxent_lm.Tables.blank()
    t.classes += rng.normal(0, 1, t.classes.shape).astype(np.float32)
    t.words += rng.normal(0, 1, t.words.shape).astype(np.float32)
    m = maxent_lm.Model(v, t)
    h = np.column_stack([np.full(1501, word[3]), np.append(word, np.uint64(1))]).ravel()
    rank_, c_, p = m.log10(h, np.repeat(np.arange(1501), 2))
    tail = (rank_ < 0) | (rank_ >= maxent_lm.MODEL_WORDS)
    p = p + np.where(tail, np.log10((c_ + 0.5) / v.tail_total()), 0)
    assert (10 ** p[1::2]).sum() == pytest.approx(1, abs=1e-4)


# 9
def test_quality_model(spark, docs, rows, none):
    rng = np.random.default_rng(2)
    text = lambda good: " ".join(rng.choice(["calm", "river", "stone", "light"] if good else ["buy", "now!!", "$$$", "CLICK"], 60))
    data = [(i, text(i % 3 > 0), int(i % 3 > 0)) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, quality int").withColumn("held_out", held_out("doc_id", 4, 2))
    model = quality_model.train(df, df.select("doc_id", "quality"), "not held_out")
    got = {r["doc_id"]: r["predicted"] for r in quality_model.score(df, model).collect()}
    assert sum(got[i] == q for i, _, q in data) >= 298
    odd = quality_model.score(docs.withColumn("held_out", F.lit(True)), model).collect()
    assert len(odd) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in odd)
    blank = quality_model.train(none.withColumn("held_out", F.lit(False)), df.select("doc_id", "quality").limit(0), "not held_out")
    assert {r["score"] for r in quality_model.score(docs.withColumn("held_out", F.lit(True)), blank).collect()} == {0.5}


def plain_quality_features(text, n_chars):
    """index: value, counted word by word and character by character."""
    data = (text or "").encode()
    w = [x.encode() for x in words(text)]
    parted = quality_model.split(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    h = [int(x) for x in parted.hashes()]
    per = collections.Counter(x % quality_model.BUCKETS for x in h)
    x = {i: math.sqrt(c / len(w)) for i, c in per.items()}
    size, n = max(1, len(data)), max(1, len(w))
    share = lambda chars: sum(b in chars for b in data) / size
    dense = [math.log1p(size) / 12, math.log1p(len(w)) / 10, sum(map(len, w)) / n / 10, len(per) / n]
    dense += [share(c) for c in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".", b"!?", b",;:", bytes(range(128, 256)))]
    dense += [sum(p == q for p, q in zip(w, w[1:])) / n, min(1.0, (data.count(b"\n") + 1) / n), math.log1p(n_chars or 0) / 12, float(n_chars is None), 1.0]
    return x | {quality_model.BUCKETS + i: v for i, v in enumerate(dense)}


def test_quality_scores_are_those_of_all_pairs(docs, rows):
    """Features counted plainly, and every pair of them."""
    rng = np.random.default_rng(6)
    m = quality_model.Machine.blank()
    m.bias, m.weight = 0.3, rng.normal(0, 0.5, len(m.weight)).astype(np.float32)
    m.factors = rng.normal(0, 0.3, m.factors.shape).astype(np.float32)
    want = collections.defaultdict(list)
    for doc_id, text, _, _, n_chars, _ in rows:
        x = sorted(plain_quality_features(text, n_chars).items())
        index, value = np.array([i for i, _ in x]), np.array([v for _, v in x])
        pairs = m.factors[index].astype(float) @ m.factors[index].astype(float).T * np.outer(value, value)
        raw = m.bias + float(m.weight[index].astype(float) @ value) + sum(pairs[i, j] for i in range(len(x)) for j in range(i + 1, len(x)))
        want[doc_id].append(1 / (1 + math.exp(-raw)))
    got = collections.defaultdict(list)
    for r in quality_model.score(docs.withColumn("held_out", F.lit(True)), m).collect():
        got[r["doc_id"]].append(r["score"])
    assert set(got) == set(want) and all(sorted(got[k]) == pytest.approx(sorted(want[k]), abs=2e-4) for k in want)


def test_quality_model_of_a_repeated_document_and_metadata(spark):
    """One labelled doc_id with many texts stays within the bound; n_chars tells where the text doesn't."""
    rows = [(i, "same words here", 50 if i % 2 else 5000) for i in range(200)] + [(1000, f"same words here {i}", 50) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("held_out", F.lit(False))
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1000, 1)], "doc_id long, quality int")
    model = quality_model.train(df, labels, "not held_out", 210)
    got = {r["doc_id"]: r["score"] for r in quality_model.score(df, model).collect()}
    assert min(got[i] for i in range(1, 200, 2)) > max(got[i] for i in range(0, 200, 2))


def test_factorisation_identity():
    m = quality_model.Machine.blank()
    m.weight += np.random.default_rng(1).normal(size=m.weight.shape).astype(np.float32)
    x = quality_model.Sparse(np.array([0, 3]), np.array([5, 9, 77]), np.array([0.5, 2.0, -1.0], dtype=np.float32))
    pairs = sum(float(m.factors[x.index[a]] @ m.factors[x.index[b]]) * x.value[a] * x.value[b] for a in range(3) for b in range(a))
    assert m.raw(x)[0][0] == pytest.approx(m.bias + float((m.weight[x.index] * x.value).sum()) + pairs, abs=1e-5)


# 6
def test_mixing(docs, rows, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for i, t, _, s, *_ in rows:
        sizes[s] += len(words(t))
    total, weight = sum(sizes.values()), {s: [5, 2, 1][k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, full = {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in sizes if x not in full) for s in sizes}
        over = {s for s in sizes if target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            break
        full |= over
    assert collections.Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in got) == collections.Counter((i, len(words(t)), sizes[s], round(target[s], 6)) for i, t, _, s, *_ in rows)
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in got)
    assert by_row(mixing.mix(docs.repartition(7))) == by_row(mixing.mix(docs))
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in got)
    assert by_row(mixing.apply_mix(docs.repartition(5))) == by_row(out)
    # rows that differ in further columns alone, and some that don't
    alike = docs.limit(1).select("doc_id", F.lit("x y z " * 9).alias("text"), "lang", F.lit("s7").alias("source"), "n_chars", F.explode(F.expr("sequence(0, 8)")).alias("_row"))
    alike = docs.union(alike).union(alike.where("_row < 3"))
    assert by_row(mixing.apply_mix(alike)) == by_row(mixing.apply_mix(alike.repartition(6)))
    assert mixing.apply_mix(alike).count() == mixing.mix(alike).agg(F.sum("copies")).first()[0]
    assert mixing.mix(none).count() == 0 and mixing.apply_mix(none).count() == 0


def test_mixed_words_come_near_the_targets(spark):
    """Of every source, but for its residual document; many sources and sizes."""
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 90)), f"s{int(rng.integers(0, 9)) ** 2 % 7}") for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).withColumn("source_size", F.col("source_size"))
    per = got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"), F.sum("size").alias("size")).collect()
    assert all(r["size"] == r["source_size"] and abs(r["taken"] - r["target"]) <= r["most"] for r in per) and len(per) >= 3


def test_settling_keeps_words_and_expectations():
    rng = np.random.default_rng(4)
    sizes, start, totals = rng.integers(1, 50, 40).tolist(), rng.random(40).tolist(), np.zeros(40)
    for seed in range(400):
        p, held = mixing.settle([seed * 1000 + i for i in range(40)], sizes, start)
        assert sum(0 < x < 1 for x in p) <= 1 and (held < 0 or 0 < p[held] < 1)
        assert np.dot(p, sizes) == pytest.approx(np.dot(start, sizes))
        totals += p
    assert np.abs(totals / 400 - start).max() < 0.12


# 7
def test_nearest(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 16))
    x = centres[rng.integers(0, 6, 2400)] + 0.3 * rng.normal(size=(2400, 16))
    rows = [(i, v.astype(float).tolist(), 0) for i, v in enumerate(x)]
    rows += [(2400, None, 1), (2401, [0.0] * 16, 1), (2402, [float("nan")] * 16, 1), (2403, [None] * 16, 1), (None, rows[0][1], 1), (2420, [], 1), (2440, [1.0, 2.0], 1), (2441, [2.0, 1.0], 1), rows[20], rows[21]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = {}
    for r in nearest.neighbours(df, 20, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {*range(0, 2400, 20), 2440}
    hits = 0
    for q in range(0, 2400, 20):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(2400), -s))[:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert [(-c, v) for _, v, c in mine] == sorted((-c, v) for _, v, c in mine)
        assert all(c == pytest.approx(s[v]) for _, v, c in mine)
        hits += len(set(best) & {v for _, v, _ in mine})
    assert hits >= 0.9 * 20 * 120
    assert got[2440] == [(1, 2441, 4.0)]
    assert nearest.neighbours(df.limit(0), 20, 20).count() == 0


def test_nearest_in_many_small_cells(spark, monkeypatch):
    """64 cells and blocks of few queries; many equal vectors, ids with several vectors, and clashing columns."""
    monkeypatch.setattr(nearest, "CELL", 64)
    monkeypatch.setattr(nearest, "QUERIES", 8)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 3000)] + 0.5 * rng.normal(size=(3000, 24))
    x[rng.permutation(3000)[:700]] = x[40] = 3 * x[40]  # one large group of equal vectors, a query among them
    x = x.astype(np.float32).astype(np.float64)
    owner = np.arange(3000)
    owner[[7, 9, 11]] = 5  # an id with four vectors
    rows = [(int(owner[i]), v.tolist(), i, [0.0], "c", "s") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, vec array<double>, cell string, salt string").repartition(5)
    got = collections.defaultdict(list)
    for r in nearest.neighbours(df, 20, 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 3000, 20))
    hits = 0
    for q, found in got.items():
        best = {}
        for i, score in zip(owner, np.einsum("j,ij->i", x[q], x), strict=True):
            if i != q:
                best[i] = max(score, best.get(i, -np.inf))
        want = sorted(best.items(), key=lambda t: (-t[1], t[0]))[:20]
        assert len({i for i, _ in found}) == 20 and all(c == pytest.approx(best[i]) for i, c in found)
        assert [(-c, i) for i, c in found] == sorted((-c, i) for i, c in found)
        hits += sum(c >= want[-1][1] - 1e-9 for _, c in found)
    assert hits >= 0.9 * 20 * len(got)
    equal = sorted({int(owner[i]) for i in range(3000) if (x[i] == x[40]).all()} - {40})
    assert [i for i, _ in got[40]] == equal[:20]


def test_chi_square_quantile():
    assert nearest.chi_square_quantile(0.95, 8) == pytest.approx(15.5073, abs=1e-3)


# 8
def test_segmentation(docs, rows, none):
    import sentencepiece

    v = segmentation.Vocabulary.load()
    import public_tokenizers

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = segmentation.sample(docs, v, 3)
    got = collections.defaultdict(set)
    texts = collections.defaultdict(set)
    for i, t, *_ in rows:
        texts[i].add(t or "")
    for r in out.collect():
        assert r["round_trip"] and r["log_prob"] <= 0 and r["log_inclusion"] <= 0
        assert sp.decode(list(r["ids"])) in texts[r["doc_id"]]
        got[(r["doc_id"], sp.decode(list(r["ids"])))].add(tuple(r["ids"]))
    assert all(len(x) == (1 if not t else 3) for (_, t), x in got.items())
    assert {r["text"] for r in segmentation.decode(out, v).collect()} == {t for x in texts.values() for t in x}
    assert by_row(segmentation.sample(docs.repartition(5), v, 3, digest=True)) == by_row(segmentation.sample(docs, v, 3, digest=True))
    assert segmentation.sample(none, v).count() == 0


def test_the_query_gives_segmentations_themselves(spark, tmp_path):
    import hashlib

    texts = {1: "plain words and plain words", 2: None, 3: "", 4: "été \U0001f600\n\nx  y", 5: "word " * 3000}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    v, got = segmentation.Vocabulary.load(), segmentation.op8_segmentation(spark, str(tmp_path)).collect()
    assert len(got) == 2 * 3 + 2 and {r["doc_id"] for r in got} == set(texts)
    for r in got:
        assert r["n_pieces"] == len(r["ids"]) and hashlib.sha256(np.array(r["ids"], dtype="<i4")).hexdigest() == r["ids_sha256"]
        assert v.decode(np.array(r["ids"], dtype=np.int64)) == (texts[r["doc_id"]] or "") if r["ids"] else not texts[r["doc_id"]]


def test_round_trip_is_of_the_original_text():
    v = segmentation.Vocabulary.load()
    v.prepare()
    texts = ["a\u2581b", "plain words", "", " two  spaces ", "\u2581", "\U0001f600 é"]
    s = segmentation.segment(texts, np.arange(len(texts), dtype=np.uint64), v, 2)
    for i, t in enumerate(s.text):
        assert s.round_trip[i] == (v.decode(s.ids[s.first[i] : s.first[i + 1]]) == texts[t])
    assert not s.round_trip[s.text == 0].any() and not s.round_trip[s.text == 4].any() and s.round_trip[(s.text != 0) & (s.text != 4)].all()
    # a text that decodes to another length leaves the others' bytes compared
    pieces, v.bytes = v.bytes.copy(), v.bytes.copy()
    v.bytes[v.byte_start[s.ids[s.first[list(s.text).index(1)]]] + 3] ^= 1
    assert not segmentation.segment(texts, np.arange(len(texts), dtype=np.uint64), v, 1).round_trip[1]
    v.bytes = pieces


def test_a_lattice_has_all_pieces_and_their_shares():
    v = segmentation.Vocabulary.load()
    v.prepare()
    ids = {p: i for i, p in enumerate(v.pieces) if p}
    texts = ["hello the hello\n\nthere  are", "", "\u00e9t\u00e9 \U0001f600\u4e2d\ud800", "a" * 40, " "]
    s = segmentation.read(texts, v)
    x = s.lattice
    for t, text in enumerate(texts):
        whole = ""
        for u in range(s.first[t], s.first[t + 1]):
            at, unit = [int(x.start[s.unit[u]])], ""
            while at[-1] >= 0:  # a position's first arc is that of one character
                arc = x.first[at[-1]]
                unit += v.pieces[x.piece[arc]] if x.piece[arc] >= 0 else chr(-1 - x.piece[arc])
                at.append(int(x.end[arc]))
            whole, n, mass = whole + unit, len(unit), {len(unit): 0.0}
            for i in reversed(range(n)):
                arcs = {i + k: (ids[unit[i : i + k]], v.weights[ids[unit[i : i + k]]]) for k in range(1, n - i + 1) if unit[i : i + k] in ids}
                arcs.setdefault(i + 1, (-1 - ord(unit[i]), v.byte_weight * len(unit[i].encode("utf-8", "surrogatepass"))))
                mass[i] = np.logaddexp.reduce([w + mass[j] for j, (_, w) in arcs.items()])
                a, z = x.first[at[i]], x.first[at[i] + 1]
                assert x.piece[a:z].tolist() == [arcs[j][0] for j in sorted(arcs)] and x.end[a:z].tolist() == [at[j] for j in sorted(arcs)]
                assert (x.position[a:z] == at[i]).all() and x.log_p[a:z] == pytest.approx([arcs[j][1] + mass[j] - mass[i] for j in sorted(arcs)])
                assert x.upto[a : z - 1] == pytest.approx(np.cumsum(np.exp(x.log_p[a:z]))[:-1])
        assert whole == ("\u2581" + text.replace(" ", "\u2581") if text else "")


def test_work_of_lattices_and_draws(monkeypatch):
    """Arcs are put in order without a sort, and a drawn arc takes one mixing of bits."""
    v = segmentation.Vocabulary.load()
    v.prepare()
    texts = [" ".join(f"international{i}understanding{j}" for i in range(30)) for j in range(4)]
    work, sort, mix = collections.Counter(), np.argsort, segmentation.mix
    monkeypatch.setattr(np, "argsort", lambda a, **b: (work.update(sorted=len(a)), sort(a, **b))[1])
    x = segmentation.read(texts, v)
    assert work["sorted"] <= len(x.unit) < len(x.lattice.piece)
    monkeypatch.setattr(segmentation, "mix", lambda a: (work.update(mixed=len(a)), mix(a))[1])
    drawn = segmentation.Paths(x, np.arange(len(texts), dtype=np.uint64), 0)
    assert work["mixed"] <= len(drawn.arcs) + len(x.unit) + 2 * len(texts)


def test_segmentations_of_texts_side_by_side_are_those_of_each_alone(monkeypatch):
    """Also where heads are of different length; the heads of all texts are made in k rounds."""
    v = segmentation.Vocabulary.load()
    v.prepare()
    texts = ["plain words " * 400, "", "a", " ", "\U0001f600" * 300, "\u4e2d " * 500, "hello the", "x" * 700]
    keys, rounds, heads = np.arange(len(texts), dtype=np.uint64) * np.uint64(77), [], segmentation.heads
    alone = [segmentation.segment([t], keys[i : i + 1], v, 3) for i, t in enumerate(texts)]
    monkeypatch.setattr(segmentation, "heads", lambda *a: (rounds.append(1), heads(*a))[1])
    s = segmentation.segment(texts, keys, v, 3)
    assert len(rounds) == 3
    assert s.ids.tolist() == [i for one in alone for i in one.ids.tolist()] and s.text.tolist() == [i for i, one in enumerate(alone) for _ in one.text]
    assert s.log_prob == pytest.approx(np.concatenate([one.log_prob for one in alone])) and s.log_inclusion == pytest.approx(np.concatenate([one.log_inclusion for one in alone]))


def test_segmentation_inclusion_weights():
    """Over many keys, sums weighted by log_prob - log_inclusion come to the whole, 1."""
    v = segmentation.Vocabulary.load()
    v.prepare()
    total = []
    for key in range(800):
        s = segmentation.segment(["hello the"], np.array([key * 11 + 5], dtype=np.uint64), v, 2)
        total.append(np.exp(s.log_prob - s.log_inclusion).sum())
    assert np.mean(total) == pytest.approx(1, abs=4 * np.std(total) / len(total) ** 0.5 + 1e-6)


def test_segmentation_without_replacement():
    """First and second samples have the frequencies of drawing without replacement."""
    v = segmentation.Vocabulary.load()
    v.prepare()
    text, n, seen = ["hello the"], 1500, [collections.Counter(), collections.Counter()]
    for key in range(n):
        s = segmentation.segment(text, np.array([key * 7 + 1], dtype=np.uint64), v, 2)
        for j in range(2):
            seen[j][tuple(s.ids[s.first[j] : s.first[j + 1]].tolist()), round(math.exp(s.log_prob[j]), 9)] += 1
    p = {ids: x for (ids, x) in {**seen[0], **seen[1]}}
    for ids, x in p.items():
        assert seen[0][ids, x] / n == pytest.approx(x, abs=0.05)
        assert seen[1][ids, x] / n == pytest.approx(sum(y * x / (1 - y) for k, y in p.items() if k != ids), abs=0.06)
