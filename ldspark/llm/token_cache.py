"""Token counts through a cache keyed by content and tokenizer digests.

Contents are joined with stored counts on their digest; only distinct contents without a count are encoded, and
their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ldspark.session import scratch_path

from .common import SPACE, map_text, text_of, whole_row, write_scratch

CACHE_SCHEMA = "content STRING, n_tokens BIGINT"
KEPT_WORDS = 400_000
_counters: dict[str, "WordCounter"] = {}


class WordCounter:
    """Counts a text's tokens by its words.

    The tokenizer must drop white space and never join what it separates, as ``word_bpe_49k`` does; a count is then
    the sum over the words. Counts of at most ``KEPT_WORDS`` words are kept, the rest is encoded again when met.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        known = self.known
        split = [t.encode().split() for t in texts]
        new = list({w for words in split for w in words if w not in known})
        if len(known) + len(new) > KEPT_WORDS:
            known.clear()
            new = list({w for words in split for w in words})
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            known.update(zip(part, (len(e.ids) for e in encoded)))
        counts = [sum(map(known.__getitem__, words)) for words in split]
        if len(known) > KEPT_WORDS:
            known.clear()
        return counts


def word_counter(path: str) -> WordCounter:
    if path not in _counters:
        _counters[path] = WordCounter(path)
    return _counters[path]


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file and of the normalisation that content digests are made after."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + SPACE.encode()).hexdigest()


def _folder(cache_dir: str, version: str) -> str:
    return f"{cache_dir}/tokenizer={version}"


def read_cache(spark, cache_dir: str, version: str) -> DataFrame:
    """Counts that earlier runs stored for one tokenizer version, one row per content; empty when there are none.

    Runs that raced may both have stored a content; their counts are equal and one is taken.
    """
    path = _folder(cache_dir, version)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(f"{path}/*")
    return write_scratch(stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "known-counts")


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_dir: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``row`` (all columns but the text), ``id``, ``n_bytes``, ``content`` (digest), ``n_tokens``; one row per row.

    * Contents are told apart after every run of ASCII white space became one space, which leaves the counts of a
      tokenizer that drops white space as they are. The digest is SHA-256 with the length of the text.
    * Texts are shuffled once, by digest and after one copy per task is left, so copies, however many, meet as
      one row per task. The join of rows with counts moves digests and other columns only.
    * ``cache_dir`` is any folder Spark can write; without one the counts live in the shared scratch folder for
      this call. Misses are appended in a folder of their own, so a run that ends early loses nothing stored, and
      the join finds each content once without aggregating again: its hot keys can be split.
    * Null text counts as empty, with no tokens; an empty table gives no rows; rows and identifiers may repeat.
    """
    spark = docs.sparkSession
    cache_dir = cache_dir or scratch_path(spark, "token-counts")
    version = tokenizer_digest(tokenizer_path)
    others = [c for c in docs.columns if c != text_col]
    text = text_of(text_col)
    norm = F.regexp_replace(text, SPACE, " ")
    digest = F.concat(F.sha2(norm, 256), F.lit("-"), F.octet_length(norm).cast("string"))

    known = read_cache(spark, cache_dir, version)
    misses = (
        docs.select(digest.alias("content"), norm.alias("text"))
        .groupBy("content")
        .agg(F.first("text").alias("text"))
        .join(known, "content", "left_anti")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = word_counter(tokenizer_path)
        for batch in batches:
            counts = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    fresh = f"{_folder(cache_dir, version)}/run={uuid.uuid4().hex}"
    map_text(misses, {"content": F.col("content"), "text": F.col("text")}, encode, CACHE_SCHEMA).write.parquet(fresh)
    counts = known.union(spark.read.schema(CACHE_SCHEMA).parquet(fresh))
    rows = docs.select(
        whole_row(docs.select(*others)).alias("row"),
        F.col(id_col).alias("id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        digest.alias("content"),
    )
    return rows.join(counts, "content", "left").select("row", "id", "n_bytes", "content", "n_tokens")
