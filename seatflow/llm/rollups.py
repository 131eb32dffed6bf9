"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A batch holds inserted, deleted and revised documents with their token counts. Committing it looks up what earlier batches
left for the documents that it names, writes signed rows (what goes, what comes) and their sums, and only then
adds its name to the commits. Totals are the sums of all committed deltas; nothing is counted again. A batch name that is
committed already changes nothing, so a batch may be sent again after any failure; what a failed attempt wrote is never read.
Batches are committed one after the other, by one writer.

Counts come from a byte-pair vocabulary file, whose path is a parameter. Texts are cut by the vocabulary's pattern, and
each distinct piece is encoded once per task.

NULL and empty texts have 0 tokens and count as documents; NULL sources and languages are groups of their own. Every row of a batch counts:
rows that share an id and version, of whatever source, are that document together, and replace all that earlier batches
left for it. Deleting a document that is not there is ignored, revising it inserts it; where a batch both deletes an id and brings rows of it, the
rows count. A row without an id is a document of its own that no later batch can name: it is added, and deleting it is ignored.
Long texts are read whole. Other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.runtime import stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are cut into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CACHED = 200_000
#: Folders of signed rows by hash of the id: a commit reads those of the documents that it names.
BUCKETS = 64
GROUP = ("source", "lang", "version")


class Counter:
    """Counts tokens; holds a bounded number of pieces and their counts."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.core = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.cut = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for piece in self.cut.findall(text):
            n = known.get(piece)
            if n is None:
                n = len(self.core.encode_single_piece(piece.encode()))
                if len(piece) < 64:
                    if len(known) >= _CACHED:
                        known.clear()
                    known[piece] = n
            total += n
        return total


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)


def counted(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, lang, version, tokens) of the whole texts; the version is the vocabulary's name."""
    version = os.path.basename(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            tokens = pa.array([own.count(text.as_py()) for text in batch.column(3)], pa.int64())
            names = pa.array([version] * len(batch), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], names, tokens], ["doc_id", "source", "lang", "version", "tokens"])

    doc_id = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "source", "lang", "text").mapInArrow(
        count, f"doc_id {doc_id}, source string, lang string, version string, tokens long")


class Rollup:
    """Totals in a folder that all executors share: commits, signed rows per document, and their sums."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _committed(self) -> list[tuple[str, str]]:
        try:
            rows = self.spark.read.schema("batch string, attempt string, at timestamp").parquet(f"{self.folder}/commits/*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [(r.batch, r.attempt) for r in rows]

    def _read(self, kind: str, schema: str, commits: list[tuple[str, str]]) -> DataFrame:
        paths = [f"{self.folder}/{kind}/attempt={attempt}" for _, attempt in commits]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.folder}/{kind}").schema(f"{schema}, attempt string")
        return reader.parquet(*paths).drop("attempt")

    def _signed(self, doc_id: str) -> str:
        return f"doc_id {doc_id}, source string, lang string, version string, docs long, tokens long, bucket int"

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply `changes` (doc_id, op, source, lang, version, tokens); op is insert, delete or revise.

        Returns whether the batch is new. Of earlier batches only the buckets of the named documents are read.
        """
        commits = self._committed()
        if batch in {name for name, _ in commits}:
            return False
        doc_id = dict(changes.dtypes)["doc_id"]
        bucket = F.pmod(F.xxhash64("doc_id", "version"), F.lit(BUCKETS)).cast("int")
        sums = [F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")]
        change = changes.groupBy("doc_id", *GROUP, (F.col("op") == "delete").alias("gone")).agg(
            F.count("*").alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))
        change = stored(change.withColumn("bucket", bucket), "changes")
        named = change.where(F.col("doc_id").isNotNull()).select("doc_id", "version", "bucket").distinct()
        touched = [r.bucket for r in named.select("bucket").distinct().collect()]  # at most BUCKETS rows
        earlier = self._read("signed", self._signed(doc_id), commits).where(F.col("bucket").isin(touched) & F.col("doc_id").isNotNull())
        same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["version"].eqNullSafe(b["version"])
        there = earlier.alias("e").join(named.alias("c"), same(earlier, named), "left_semi")
        there = there.groupBy("doc_id", *GROUP, "bucket").agg(*sums).where("docs > 0")
        goes = there.withColumns({"docs": -F.col("docs"), "tokens": -F.col("tokens")})
        comes = change.where("NOT gone").drop("gone")
        attempt = f"{uuid.uuid4().hex}"
        rows = goes.unionByName(comes).hint("rebalance", "bucket")
        rows.write.partitionBy("bucket").parquet(f"{self.folder}/signed/attempt={attempt}")
        written = self._read("signed", self._signed(doc_id), [(batch, attempt)])
        sums = written.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.parquet(f"{self.folder}/deltas/attempt={attempt}")
        row = self.spark.range(1).select(F.lit(batch).alias("batch"), F.lit(attempt).alias("attempt"), F.current_timestamp().alias("at"))
        name = batch.encode().hex()  # a folder per batch: a second writer of the same batch fails here
        row.write.mode("error").parquet(f"{self.folder}/commits/{name}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) over all committed batches."""
        deltas = self._read("deltas", "source string, lang string, version string, docs long, tokens long", self._committed())
        sums = deltas.groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def document_batches(docs: DataFrame, path: str = VOCABULARY) -> list[tuple[str, DataFrame]]:
    """Three batches over a whole table: all documents come; of equal texts one stays; texts that hold an
    e-mail address are revised to what they count without it.

    A document is known by its id and two 64-bit hashes of its text, so rows that share an id, or have none, are told apart. Of equal
    texts that of the smallest id stays, a NULL id last, and then the smallest source and language. NULL texts are no copies.
    """
    text_hash = lambda salt: F.when(F.col("text").isNotNull(), F.xxhash64("text", F.lit(salt)))
    known = F.struct(F.col("doc_id").alias("id"), text_hash(1).alias("a"), text_hash(2).alias("b"))
    keyed = docs.select(known.alias("doc_id"), "source", "lang", "text")
    every = stored(counted(keyed, path), "token-counts-of-texts")
    order = lambda: F.struct(F.col("doc_id.id").isNull(), F.col("doc_id"), F.col("source").isNull(), "source", F.col("lang").isNull(), "lang", "version", "tokens")
    equal = every.where("doc_id.a IS NOT NULL").groupBy(F.col("doc_id.a").alias("_a"), F.col("doc_id.b").alias("_b"))
    equal = stored(equal.agg(F.count("*").alias("_n"), F.min(order()).alias("_first")).where("_n > 1"), "equal-texts")
    same = (F.col("doc_id.a") == F.col("_a")) & (F.col("doc_id.b") == F.col("_b"))
    copies = every.join(equal, same).where(~F.col("doc_id").eqNullSafe(F.col("_first.doc_id"))).select(*every.columns)
    columns = ["doc_id", "source", "lang", "version", "tokens"]
    kept = equal.select(*[F.col(f"_first.{c}").alias(c) for c in columns])
    op = lambda rows, name: rows.select(*columns, F.lit(name).alias("op"))
    mailed = keyed.where(F.contains("text", F.lit("@")) & F.col("text").rlike(EMAIL)).withColumn("text", F.regexp_replace("text", EMAIL, ""))
    mailed = counted(mailed, path).join(copies.select(F.col("doc_id").alias("_gone")).distinct(), F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
    mailed = mailed.groupBy("doc_id").agg(F.min(order()).alias("_first")).select(*[F.col(f"_first.{c}").alias(c) for c in columns])
    return [("all", op(every, "insert")), ("copies", op(copies, "delete").unionByName(op(kept, "revise"))), ("cleaned", op(mailed, "revise"))]
