"""The pipeline and the registered queries over small folders of tables."""

import collections
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordspark.llm import common, queries, segmentation
from .test_operators import lower, sets_of, words

WORDS = "calm river stone light meadow paper lantern north harbour copper willow thunder marble velvet orchard canyon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing"]) + rng.choice(["", "x", "q", "v"]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with copies, near copies, junk, secrets and odd rows; labels of half of them; a clashing column."""
    rng = random.Random(11)
    texts = [prose(rng, rng.randrange(60, 240)) for _ in range(60)]
    texts += [texts[0], texts[1] + " tail", texts[2].upper(), texts[3] + ' token = "0123456789abcdef0123456789abcdef"', "short text", "", None, "spam | & % " * 40, "same same same " * 30]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], None if t is None else len(t), i % 4) for i, t in enumerate(texts)]
    rows += [rows[5], (None, prose(rng, 80), "en", "a", 3, 1), (None, None, None, None, None, None), (7, prose(rng, 90), "en", "b", 4, 2)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _h int").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 70, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_pipeline_equals_brute_force(spark, folder):
    path, rows = folder
    # base rules alone act: the labels are too few for cutoffs
    kept = []
    for r in rows:
        w = words(r[1])
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j + k for j, x in enumerate(zip(w, w[1:], w[2:])) if grams[x] > 1 for k in range(3)}
        if len(w) >= 50 and 100 * len(covered) <= 50 * len(w):
            kept.append(r)
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = common.stored(stage(spark, docs, path))
        out[name] = docs
        assert name == "segmentation" or docs.columns == columns
    as_rows = lambda name: collections.Counter(map(tuple, out[name].collect()))
    assert as_rows("quality_rules") == collections.Counter(kept)
    # of linked rows one stays: that of the smallest doc_id
    sets, gone = sets_of(kept), set()
    for a in range(len(kept)):
        for b in range(len(kept)):
            (i, x), (j, y) = sets[a], sets[b]
            if a != b and i is not None and j is not None and 100 * len(x & y) >= 80 * len(x | y) and (j, b) < (i, a):
                gone.add(a)
    left = [r for a, r in enumerate(kept) if a not in gone]
    assert len(left) < len(kept) - 3 and as_rows("jaccard_join") == collections.Counter(left)
    # the secret is masked, all else is as it was
    masked = as_rows("secret_scan")
    secret = re.compile(r'token = "0123456789abcdef0123456789abcdef')
    assert masked == collections.Counter((r[0], secret.sub("[secret]", r[1]), *r[2:4], len(secret.sub("[secret]", r[1])) if r[4] is not None else None, r[5]) for r in left)
    # words of each source come near its target, but for one document
    sizes, source = collections.Counter(), collections.defaultdict(list)
    for r, n in masked.items():
        source[r[3]].append(len(words(r[1])))
        sizes[r[3]] += len(words(r[1])) * n
    total, weight = sum(sizes.values()), {s: [5, 2, 1][k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, full = {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(weight[x] for x in sizes if x not in full) for s in sizes}
        if not (over := {s for s in sizes if target[s] > 3 * sizes[s] + 1e-9}):
            break
        full |= over
    mixed = as_rows("mixing")
    assert set(mixed) <= set(masked) and max(mixed.values()) <= 3
    for s in sizes:
        assert abs(sum(len(words(r[1])) * n for r, n in mixed.items() if r[3] == s) - target[s]) <= max(source[s])
    # two samples of each document, and every sample decodes to its text
    v = segmentation.Vocabulary.load()
    found = collections.Counter((r["doc_id"], r["text"]) for r in segmentation.decode(out["segmentation"], v).collect())
    assert found == collections.Counter({k: 2 * n for k, n in sum((collections.Counter({(r[0], r[1]): n}) for r, n in mixed.items()), collections.Counter()).items()})
    again = corpus_pipeline.run(spark, path)
    mark = lambda df: collections.Counter((r["doc_id"], r["sample"], tuple(r["ids"])) for r in df.collect())
    assert mark(again) == mark(out["segmentation"])


def test_pipeline_of_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_learn_from_their_folds_alone(spark, folder, tmp_path):
    """Labels and texts of held-out rows change nothing for the others, and op1's counts follow the folds."""
    path, rows = folder
    held = lambda i, folds, fold: i is None or zlib.crc32(str(i).encode()) % folds == fold
    docs, labels = (spark.read.parquet(f"{path}/{n}.parquet") for n in ("documents", "labels"))
    part = lambda folds, fold: F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(True))
    read = lambda name, where: spark.createDataFrame(queries.QUERIES[name](spark, where).toArrow()).collect()
    rounded = lambda found, ids: collections.Counter(tuple(round(x, 4) if isinstance(x, float) else x for x in r) for r in found if r["doc_id"] in ids)
    every = {i for i, *_ in rows}
    new = {
        ("op1_lm_score", 5, 1): (docs.withColumn("text", F.when(part(5, 1), F.concat(F.lit("new words "), F.col("text"))).otherwise(F.col("text"))), labels, {i for i in every if not held(i, 5, 1)}),
        ("op9_quality_model", 4, 2): (docs, labels.withColumn("quality", F.when(part(4, 2), 1 - F.col("quality")).otherwise(F.col("quality"))), every),
        ("op10_language_id", 3, 1): (docs.withColumn("lang", F.when(part(3, 1), F.lit("zz")).otherwise(F.col("lang"))), labels, every),
    }
    for (name, folds, fold), (d, q, same) in new.items():
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        q.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        got = read(name, path)
        assert rounded(got, same) == rounded(read(name, f"{tmp_path}/{name}"), same) and len(same) > 40
        assert len(got) == len(rows) and all(r["held_out"] == held(r["doc_id"], folds, fold) for r in got)
    c = collections.Counter(x for i, t, *_ in rows if not held(i, 5, 1) for x in [*words(lower(t)), None])
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t, *_ in rows:
        w = [*words(lower(t)), None]
        want[i, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4)] += 1
    got = queries.QUERIES["op1_lm_score"](spark, path).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
