"""Token counts through a digest cache.

Texts are joined by the digest of their content, and of the tokenizer's file,
to counts that earlier runs have stored; only distinct texts without a
stored count are encoded, and their counts are appended to the cache.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm.common import byte_texts, stored
from martline.session import scratch_path

#: Counts above this mark a document as over the limit.
LIMIT = 4096
CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: Session setting that names a lasting cache folder; without it each call has its own.
CACHE_SETTING = "martline.tokens.cache"


def tokenizer_path(tokenizer: str) -> str:
    """The file itself, or the place of a public tokenizer of that name."""
    if os.path.isabs(tokenizer):
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def tokenizer_digest(tokenizer: str) -> str:
    with open(tokenizer_path(tokenizer), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def counter(tokenizer: str) -> Callable[[str], int]:
    """A function that counts the tokens of a whole text with the library of the file's kind."""
    path = tokenizer_path(tokenizer)
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(pieces.encode(text))
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(path)
    known.no_truncation()
    known.no_padding()
    return lambda text: len(known.encode(text, add_special_tokens=False).ids)


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts, one row per tokenizer and digest; appending twice does no harm."""
    kept = spark.read.schema(CACHE_SCHEMA).parquet(folder)
    return kept.groupBy("tokenizer", "digest").agg(F.max("n_tokens").alias("n_tokens"))


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without those whose digest the task has seen before (32 bytes a row are remembered)."""
    seen: set[bytes] = set()
    for b in batches:
        keep = []
        for d in b.column("digest").to_pylist():
            keep.append(d not in seen)
            seen.add(d)
        yield b.filter(pa.array(keep, pa.bool_()))


def fill_cache(texts: DataFrame, tokenizer: str, folder: str) -> None:
    """Encode every distinct text of ``texts(digest, text)`` that has no stored count; append the counts.

    Copies are dropped in the task that reads them, so a text that makes up a
    third of all rows sends one row per task to the shuffle.
    """
    spark, version = texts.sparkSession, tokenizer_digest(tokenizer)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(folder)
    known = read_cache(spark, folder).where(F.col("tokenizer") == version).select("digest")
    once = texts.mapInArrow(_first_of_task, texts.schema).repartition("digest")
    missing = once.join(known, "digest", "left_anti").select("digest", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for b in _first_of_task(batches):
            n = [count(t.decode("utf-8", "replace")) for t in byte_texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    counts = missing.mapInArrow(encode, "digest binary, n_tokens long")
    (counts.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(folder))


def token_counts(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", limit: int = LIMIT,
                 cache: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``cache`` is a Parquet folder of stored counts that is read and appended to;
    by default the one the session names in ``martline.tokens.cache``, else a new
    one in the shared folder.  Normalisation of the content for its digest only
    turns null into the empty text, because anything more could change a count.
    Tokens are counted without begin, end or added special tokens.  Repeated rows
    each return; null ids stay null; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = cache or spark.conf.get(CACHE_SETTING, None) or scratch_path(spark, "token-cache")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keyed = plain.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    fill_cache(keyed.select("digest", "text"), tokenizer, folder)
    rows = stored(keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "tokens")
    counts = (read_cache(spark, folder).where(F.col("tokenizer") == tokenizer_digest(tokenizer))
              .select("digest", "n_tokens"))
    return (rows.join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
