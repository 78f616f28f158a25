"""Search indexes: postings of the terms of text columns, so that full-text conditions read no text.

A posting is a term of a field of a record, with its positions.  Where the texts are read, the postings of a term are put
together in blocks, so that only blocks are shuffled.  They are written in folders by a hash of the term, sorted by term
in each file, with Bloom filters: a search prunes to the folders of its terms and, in their files, to row groups that hold them.  Several terms are an intersection of their postings by key; a phrase is one
by key and position.

Defined results: terms are those of the analyser, in searches too.  A null text has none.  Keys must be unique and
not null, as a posting tells its record by the key.  A search without a term finds every record with a text, as a
scan does; it isn't for the index.  The index holds the texts as they were.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDERS = 64


@dataclass(frozen=True)
class Analyser:
    """Words are runs of Unicode letters, digits and `_`.  lower: case doesn't matter; plain: nor do accents; stop: words left out; least: of so many characters at least."""

    lower: bool = True
    plain: bool = False
    stop: tuple[str, ...] = ()
    least: int = 1

    def words(self, text: Column) -> Column:
        """The array of a text's terms, in order; what is left out leaves no gap."""
        if self.plain:  # accents that are marks of their own, and letters that have one
            letters = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
            text = F.translate(F.regexp_replace(text, r"\p{M}+", ""), letters + letters.upper(), "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYY")
        text = F.lower(text) if self.lower else text
        return F.filter(F.split(text, r"(?U)\W+"), lambda w: (F.length(w) >= max(1, self.least)) & ~w.isin(list(self.stop)) if self.stop else F.length(w) >= max(1, self.least))


@dataclass(frozen=True)
class SearchIndex:
    path: str
    fields: tuple[str, ...]
    analyser: Analyser
    #: The type and the name of the key.
    key: str = "bigint"
    column: str = "id"

    def terms(self, spark: SparkSession, text: str) -> list[str]:
        return list(spark.range(1).select(self.analyser.words(F.lit(text))).first()[0])

    def _blocks(self, spark: SparkSession, field: str, terms: Sequence[str]) -> DataFrame:
        folders = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "term string").select(_folder(F.col("term"))).distinct().collect()]
        df = spark.read.schema(f"{_form(self.key)}, _folder int").parquet(f"{self.path}/postings")
        return df.where(F.col("_folder").isin(folders) & F.col("term").isin(list(terms)) & (F.col("field") == field))

    def postings(self, spark: SparkSession, field: str, terms: Sequence[str]) -> DataFrame:
        """key, term and positions of some terms, from their folders."""
        each = self._blocks(spark, field, terms).select("term", F.explode(F.arrays_zip("keys", "positions")).alias("p"))
        return each.select(F.col("p.keys").alias("key"), "term", "p.positions")

    def matching(self, spark: SparkSession, field: str, text: str, phrase: bool = False) -> DataFrame | None:
        """`key` of the records whose field has all terms of the text, or has them one after the other; None if it has no term."""
        if field not in self.fields:
            raise ValueError(f"not a field of the index: {field}")
        terms = self.terms(spark, text)
        if not terms:
            return None
        if not phrase or len(terms) == 1:  # positions aren't read
            found = self._blocks(spark, field, sorted(set(terms))).select(F.explode("keys").alias("key"))
            if len(set(terms)) == 1:
                return found
            return found.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(set(terms))).select("key")
        found = self.postings(spark, field, sorted(set(terms)))
        places: dict[str, list[int]] = {}
        for i, t in enumerate(terms):
            places.setdefault(t, []).append(i)
        at = F.create_map(*[x for t, i in places.items() for x in (F.lit(t), F.lit(i))])
        starts = found.select("key", "positions", F.explode(at[F.col("term")]).alias("i")).select("key", F.explode("positions").alias("p"), "i")
        return starts.groupBy("key", (F.col("p") - F.col("i")).alias("start")).agg(F.count("*").alias("n")).where(F.col("n") == len(terms)).select("key").distinct()


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int").alias("_folder")


def build(rows: DataFrame, key: str, fields: Sequence[str], path: str, analyser: Analyser | None = None) -> SearchIndex:
    """Write an index of text columns to a new folder."""
    analyser = analyser or Analyser()
    _check(rows, key)
    _write(rows, key, fields, analyser, path)
    kind = rows.schema[key].dataType.simpleString()
    told = json.dumps({"fields": list(fields), "analyser": asdict(analyser), "key": kind, "column": key})
    rows.sparkSession.createDataFrame([(told,)], "told string").coalesce(1).write.text(f"{path}/index")
    return SearchIndex(path, tuple(fields), analyser, kind, key)


def add(index: SearchIndex, rows: DataFrame) -> SearchIndex:
    """The index with the texts of more records; their keys must be new."""
    _check(rows, index.column)
    there = rows.sparkSession.read.schema(f"keys array<{index.key}>, _folder int").parquet(f"{index.path}/postings").select(F.explode("keys").alias("key"))
    again = rows.select(F.col(index.column).alias("key")).join(there, "key", "left_semi").take(1)
    if again:
        raise ValueError(f"the index has the record {again[0][0]}")
    _write(rows, index.column, index.fields, index.analyser, index.path)
    return index


def _check(rows: DataFrame, key: str) -> None:
    odd = rows.groupBy(key).agg(F.count("*").alias("n")).where(f"n > 1 or `{key}` is null").select(key).take(1)
    if odd:
        raise ValueError(f"a search index needs a key for each record: {odd[0][0]}")


def _form(kind: str) -> str:
    return f"term string, field string, keys array<{kind}>, positions array<array<int>>"


def _put_together(fields: Sequence[str]) -> Callable:
    """Blocks of postings from rows of a key and the words of each field: one of each term of each field and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, field in enumerate(fields, 1):
                n = b.column(i).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                words = b.column(i).flatten().dictionary_encode()
                if not len(words):
                    continue
                code, row = words.indices.to_numpy(), np.repeat(np.arange(len(n)), n)
                place = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
                order = np.argsort(code, kind="stable")  # by row and place within a term
                code, row, place = code[order], row[order], place[order]
                new = np.concatenate(([True], code[1:] != code[:-1]))
                posting = np.flatnonzero(new | np.concatenate(([True], row[1:] != row[:-1])))
                block = np.flatnonzero(new)
                at, inner = np.append(np.searchsorted(posting, block), len(posting)), np.append(posting, len(code))
                keys = pa.ListArray.from_arrays(pa.array(at, pa.int32()), b.column(0).take(pa.array(row[posting])))
                places = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(place, pa.int32()))
                terms = words.dictionary.take(pa.array(code[block]))
                yield pa.RecordBatch.from_arrays([terms, pa.array([field] * len(terms), pa.string()), keys, pa.ListArray.from_arrays(pa.array(at, pa.int32()), places)], ["term", "field", "keys", "positions"])

    return run


def _write(rows: DataFrame, key: str, fields: Sequence[str], analyser: Analyser, path: str) -> None:
    words = rows.select(F.col(key).alias("key"), *[analyser.words(F.col(f)).alias(f"w{i}") for i, f in enumerate(fields)])
    blocks = words.mapInArrow(_put_together(list(fields)), _form(rows.schema[key].dataType.simpleString()))
    postings = blocks.withColumn("_folder", _folder(F.col("term")))
    # a folder with very frequent terms is split over several files
    spread = postings.hint("rebalance", "_folder").sortWithinPartitions("_folder", "term")
    spread.write.mode("append").option("parquet.bloom.filter.enabled#term", "true").partitionBy("_folder").parquet(f"{path}/postings")


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """An index that `build` wrote."""
    told = json.loads(spark.read.text(f"{path}/index").first()[0])
    return SearchIndex(path, tuple(told["fields"]), Analyser(**{**told["analyser"], "stop": tuple(told["analyser"]["stop"])}), told["key"], told["column"])
