"""Secrets in texts: fixed patterns, and strings that look random under character Markov models.

Two bigram models over the characters of candidate strings are compared: one of random strings, one of
ordinary identifiers.  A candidate is a maximal run of `[A-Za-z0-9+/_=-]` of at least MIN_CHARS characters;
it becomes a `markov` span if its log-likelihood ratio, a character, exceeds the cutoff for its length and
it overlaps no span of the fixed patterns.  The cutoff is CUTOFF from SURE_CHARS characters on, and larger
for shorter ones, whose mean strays further: by the root of the ratio of lengths.

Both models are trained from labelled strings.  Random: the values that the fixed patterns find in the
training rows, and GENERATED seeded strings over the usual secret alphabets.  Ordinary: all words of the
training rows outside those values, and compounds of them joined the way identifiers are (snake, kebab,
camel, paths, sums and assignments, mostly with a number behind), one for each COMPOUND_WORDS words of a row, seeded by its text: the models
don't depend on how rows are dealt to tasks.  The training rows are a bounded sample: about SAMPLE_ROWS rows
drawn by a hash of their text.  The models are two small tables of bigram counts.  On labelled samples that
were held out, no ordinary identifier exceeds 0 and 98 in 100 random strings of 16 characters exceed the
cutoff (of 40 characters, all).

Defined results: a null or empty text has no spans and the digest of the empty string.  Rows are scanned
one by one, so repeated rows, null doc_ids and further columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordspark.llm.common import share, slices, table

#: The fixed patterns; letters of the keywords are ASCII in either case.
PATTERNS = {
    "assign": (re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
#: Equal to the hex pattern where 16 characters are needed, and faster.
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = (*PATTERNS, "markov")
MIN_CHARS, SURE_CHARS, CUTOFF = 16, 20, 0.6
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_CHARS},}}")
SAMPLE_ROWS, GENERATED, COMPOUND_WORDS, SEED = 2000, 4000, 16, 11
_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789")
_CODE = np.zeros(256, dtype=np.int64)
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
for _i, _c in enumerate(_SYMBOLS):
    _CODE[ord(_c)] = _i
SIZE = len(_SYMBOLS)
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find, in the order of start and kind."""
    out = []
    for kind, (pattern, group, least) in enumerate(PATTERNS.values()):
        for m in (_LONG_HEX if kind == 2 else pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def codes(string: str) -> np.ndarray:
    return _CODE[np.frombuffer(string.encode("latin-1", "replace"), dtype=np.uint8)]


def counts(strings: list[str]) -> np.ndarray:
    """Bigram counts over all strings."""
    if not strings:
        return np.zeros((SIZE, SIZE))
    c, ends = codes("".join(strings)), np.cumsum([len(s) for s in strings])
    within = np.ones(len(c), dtype=bool)
    within[ends - 1] = False  # no bigram reaches from one string into the next
    first = np.flatnonzero(within)
    return np.bincount(c[first] * SIZE + c[first + 1], minlength=SIZE * SIZE).reshape(SIZE, SIZE)


def log_odds(random: np.ndarray, ordinary: np.ndarray, smooth: float = 0.5) -> np.ndarray:
    """For each bigram, how much likelier a random string continues this way, as a logarithm."""
    p, q = ((x + smooth) / (x + smooth).sum(axis=1, keepdims=True) for x in (random, ordinary))
    return np.log(p) - np.log(q)


def generated(n: int = GENERATED, seed: int = SEED) -> list[str]:
    """Labelled samples of random strings."""
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(_ALPHABETS[i % len(_ALPHABETS)]), int(rng.integers(20, 65)))) for i in range(n)]


def compounds(words: list[str], n: int = GENERATED, seed: int | list[int] = SEED) -> list[str]:
    """Labelled samples of ordinary identifiers."""
    if not words:
        return []
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        parts = [words[j] for j in rng.integers(0, len(words), int(rng.integers(2, 5)))]
        tail = str(int(rng.integers(0, 10 ** int(rng.integers(1, 5)))))
        styles = ("_".join(parts) + "_" + tail, "-".join(parts) + "-" + tail, "".join(x.capitalize() for x in parts) + tail, "_".join(parts).upper() + "_" + tail, "/".join([*parts, tail]), "/" + "/".join(parts), "+".join(parts), "=".join((parts[0], "-".join(parts[1:]) + tail)))
        out.append(styles[i % len(styles)])
    return out


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """The log odds of bigrams.  Counting runs where the rows are; two small tables a task come back."""
    n = docs.where("text is not null").count()
    rows = docs.where("text is not null").select("text").where(share("text") < F.lit(sample_rows / max(n, 1)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE, SIZE))
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                secret, words, at = [], [], 0
                for m in sorted((m.span(2) if k == "assign" else m.span() for k, (p, g, least) in PATTERNS.items() for m in p.finditer(text) if m.end(g) - m.start(g) >= least)):
                    words += re.findall(r"[A-Za-z]{2,}", text[at : m[0]])
                    secret += re.findall(r"[A-Za-z0-9+/_=-]{12,}", text[m[0] : m[1]])
                    at = max(at, m[1])
                words += re.findall(r"[A-Za-z]{2,}", text[at:])
                total[0] += counts(secret)
                total[1] += counts(words + compounds(words, -(-len(words) // COMPOUND_WORDS), [SEED, zlib.crc32(text.encode("utf-8", "replace"))]))
        found = total.ravel().astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["cell", "n"])

    cells = rows.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(2 * SIZE * SIZE)
    for r in cells.collect():  # two tables
        total[r["cell"]] = r["n"]
    random, ordinary = total.reshape(2, SIZE, SIZE)
    return log_odds(random + counts(generated()), ordinary)


def cutoff_of(n: int) -> float:
    """The log-likelihood ratio a character that strings of n characters must exceed."""
    return CUTOFF * max(1.0, SURE_CHARS / n) ** 0.5


def markov_spans(text: str, odds: np.ndarray, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that look random and overlap none of the spans in `taken`."""
    out = []
    for m in CANDIDATE.finditer(text):
        c = codes(m.group())
        if odds[c[:-1], c[1:]].mean() > cutoff_of(len(c)) and not any(a < m.end() and m.start() < z for a, _, z in taken):
            out.append((m.start(), len(PATTERNS), m.end()))
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def find(text: str | None, odds: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The spans of the fixed patterns, and all spans."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(base + markov_spans(text, odds, base))


def scan(docs: DataFrame, odds: np.ndarray) -> DataFrame:
    """Counts, digest and spans of every row of `docs`."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                base, spans = find(text, odds)
                n = [sum(k == i for _, k, _ in spans) for i in range(len(KINDS))]
                rows.append((doc_id, n[0], n[1], n[2], hashlib.sha256(written(base).encode()).hexdigest(), written(spans), n[3]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names)

    return docs.select("doc_id", "text").mapInArrow(scanned, SCHEMA)


def redact(docs: DataFrame, odds: np.ndarray, mask: str = "[secret]") -> DataFrame:
    """`docs` with every span in `text` replaced by the mask; n_chars, where there is one, follows the new text."""
    schema = docs.schema
    at = schema.fieldNames().index("text")

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts, sizes = [], []
            for text in b.column(at).to_pylist():
                if text:
                    parts, last = [], 0
                    for a, _, z in find(text, odds)[1]:
                        if a >= last:
                            parts += [text[last:a], mask]
                        last = max(last, z)
                    text = "".join([*parts, text[last:]]) if parts else text
                texts.append(text)
                sizes.append(None if text is None else len(text))
            columns = list(b.columns)
            columns[at] = pa.array(texts, b.schema.field(at).type)
            if "n_chars" in b.schema.names:
                i = b.schema.names.index("n_chars")
                old = columns[i].to_pylist()
                columns[i] = pa.array([x if x is None or s is None else s for x, s in zip(old, sizes, strict=True)], b.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(masked, schema)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(docs))
