"""Language identification by compression.

For each language a raw-content zstandard dictionary is made of sampled training texts.  A text goes
to the language whose dictionary lets it be compressed to the fewest bytes.  The prediction is marked
as rejected when the runner-up is nearly as small.

Fitting takes a bounded sample: about SAMPLE_DOCS texts a language, drawn by a hash of doc_id and text, of
which each gives at most SHARE_BYTES, a slice at a hashed place, and all together DICTIONARY_BYTES.  Scoring compresses every whole text,
case-folded, with every dictionary.  The dictionaries (languages x DICTIONARY_BYTES) travel in the tasks'
closure; there are as many as the training rows have languages.

Defined results: null texts and texts without a letter are `und` with score 0.  Ties go to the language
that sorts first.  With no training rows every text is `und`.  Rows with a null doc_id are held out and
predicted like others; repeated rows are predicted one by one; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordspark.llm.common import held_out, share, slices, table

SAMPLE_DOCS, SHARE_BYTES, DICTIONARY_BYTES = 96, 3072, 96 << 10
LEVEL = 6
#: A prediction is rejected if the runner-up is larger by less than this share of the smallest size.
MARGIN = 0.01
#: Below this margin the words are compressed one by one as well.
NARROW = 0.005
#: A run before each text: without it zstandard stores short texts as they are, whatever the dictionary.
PRIME = b"\n" * 127 + b" "
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


def dictionaries(docs: DataFrame, learn: str, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, bytes]]:
    """(language, dictionary content) of the rows for which the SQL condition `learn` holds."""
    rows = docs.where(f"({learn}) and lang is not null and text is not null and text <> ''").select("doc_id", "lang", "text")
    # twice the sample's share of each language, then exactly the first of those by the same order
    n = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    drawn = rows.join(F.broadcast(n), "lang").where(share("doc_id", "text") < F.lit(2.0 * sample_docs + 64) / F.col("_n"))
    first = Window.partitionBy("lang").orderBy(share("doc_id", "text"), "doc_id", F.xxhash64("text"))
    # a slice of the whole text, from anywhere in it
    start = F.floor(share("text", F.lit("slice")) * F.greatest(F.length("text") - SHARE_BYTES, F.lit(0))).cast("int") + 1
    drawn = drawn.withColumn("_i", F.row_number().over(first)).withColumn("text", F.substr("text", start, F.lit(SHARE_BYTES))).where(F.col("_i") <= sample_docs)
    parts: dict[str, list[tuple[int, bytes]]] = {}
    for r in drawn.select("lang", "_i", "text").collect():  # languages x sample_docs rows
        parts.setdefault(r["lang"], []).append((r["_i"], r["text"].lower().encode()[:SHARE_BYTES]))
    # what comes last in a dictionary is cheapest to refer to, so the sample's first texts go there
    return [(lang, b"\n".join(x for _, x in sorted(p, reverse=True))[-DICTIONARY_BYTES:]) for lang, p in sorted(parts.items())]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Compressors:
    """One prepared compressor for each language."""

    def __init__(self, contents: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in contents]
        self.made = []
        for _, content in contents:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in [0, 1] and whether the margin is too narrow."""
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0, True
        data = PRIME + text.lower().encode("utf-8", "surrogatepass") + b" "
        sizes = sorted((len(c.compress(data)), i) for i, c in enumerate(self.made))
        if len(sizes) > 1 and sizes[1][0] - sizes[0][0] < NARROW * sizes[0][0]:
            # whole sizes are too coarse to tell: each distinct word by itself, with its neighbours' spaces
            words = [PRIME + w + b" " for w in dict.fromkeys(data[len(PRIME) :].split())]
            sizes = sorted((size + sum(len(c.compress(w)) for w in words), i) for (size, i), c in ((x, self.made[x[1]]) for x in sizes))
        best, i = sizes[0]
        margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
        return self.langs[i], min(1.0, margin / (margin + 0.05)) if margin > 0 else 0.0, margin < MARGIN


def identify(docs: DataFrame, contents: list[tuple[str, bytes]]) -> DataFrame:
    """Predictions for every row of `docs` (doc_id, held_out, text)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(contents)
        for b in slices(batches):
            found = [compressors.predict(t) for t in b.column(2).to_pylist()]
            lang, score, rejected = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(scored, SCHEMA)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id", 3, 1))
    return identify(docs, dictionaries(docs, "not held_out"))
