"""Token counts through a cache keyed by digests of content and tokenizer.

A text's key is the SHA-256 of its content together with a digest of the tokenizer file and library version. Keys join the
stored counts; only distinct keys without one are encoded, once each, and the new counts are appended to the cache. Texts
travel one copy per key and task, so a text that a third of the rows share costs what a single one does.

Edge cases: a null text counts as empty (0 tokens, 0 bytes). Every input row gives one row, repeated rows and doc_ids too.
Other columns of the input are ignored. Two runs that append the same key at once store it twice with the same count; a
read takes one. Content is keyed as it is: case, white space and accents all change counts, so nothing else is folded.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerprice.llm.chunks import Chunks, Memo, cut_before
from hammerprice.llm.columns import id_and_bytes, map_slices, written

CACHE = "digest binary, tokenizer string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file, library and library version."""
    with open(path, "rb") as file:
        digest = hashlib.file_digest(file, "sha256")
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    digest.update(f"{library.__name__} {library.__version__}".encode())
    return digest.hexdigest()


def _before_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = data == 32
    mask[1:] &= data[:-1] != 32
    return cut_before(mask, offsets)


class _Pieces:
    """Counts of a sentencepiece model by chunk: spaces and what follows them up to the next space.

    Exact where no piece holds a space mark after another character and normalising changes nothing: then no merge crosses
    a chunk's start. `divides` tells whether the model is such a one; whole texts are encoded otherwise.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = "a" + "a".join(chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000 and c != 0x2581) + "  a"
        self.divides = (
            not any("▁" in piece.lstrip("▁") for piece in pieces)
            and self.model.normalize(probe) == "▁" + probe.replace(" ", "▁")
        )
        self.memo = Memo(lambda chunk: len(self.model.encode(chunk.decode("utf-8", "replace"))))

    def count(self, texts: list[bytes]) -> list[int]:
        whole = [not self.divides or text.endswith(b" ") or "▁".encode() in text for text in texts]
        chunks = Chunks([b"" if w else text for text, w in zip(texts, whole, strict=True)], _before_spaces)
        codes, distinct = chunks.distinct()
        # The model puts a space before what it encodes; only a text's first chunk may lack one, and has it put there.
        opens = np.zeros(len(codes), bool)
        opens[chunks.first[:-1][chunks.first[:-1] < chunks.first[1:]]] = True
        sizes = np.array([self.memo[chunk[1:] if chunk[:1] == b" " else chunk] for chunk in distinct], np.int64)
        each = sizes[codes] if len(codes) else np.zeros(0, np.int64)
        for i in np.flatnonzero(opens & (chunks.bytes[chunks.starts] == 32)).tolist():
            each[i] = self.memo[chunks.joined[chunks.starts[i] : chunks.ends[i]]]
        total = np.concatenate([[0], np.cumsum(each)])[chunks.first]
        return [
            len(self.model.encode(text.decode("utf-8", "replace"))) if w else n
            for text, w, n in zip(texts, whole, np.diff(total).tolist(), strict=True)
        ]


@lru_cache(maxsize=2)
def _counter(path: str):
    if path.endswith(".model"):
        return _Pieces(path).count
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    
    def count(texts: list[bytes]) -> list[int]:
        decoded = [text.decode("utf-8", "replace") for text in texts]
        return [len(x.ids) for x in tokenizer.encode_batch(decoded, add_special_tokens=False)]

    return count


def _encode(df: DataFrame, path: str) -> DataFrame:
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counter(path)(part.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([part.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return map_slices(df.select("digest", "text"), run, "digest binary, n_tokens long")


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """Stored `digest` and `n_tokens` of one tokenizer, each digest once; empty where there is no cache yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    stored = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer") == version)
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(
    df: DataFrame, path: str, cache_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_tokens` and `over_limit` of every row; `cache_path` grows by the counts it lacked.

    `path` is a tokenizer file that every executor can read (.json or .model).
    """
    spark, version = df.sparkSession, tokenizer_version(path)
    digest = F.unhex(F.sha2(F.col("text"), 256))
    texts = id_and_bytes(df, id_col, text_col).withColumn("digest", digest)
    keys = written(texts.select("doc_id", F.length("text").cast("long").alias("n_bytes"), "digest"), "content-keys")
    known = read_cache(spark, cache_path, version)
    distinct_keys = written(keys.select("digest").distinct().join(known, "digest", "left"), "distinct-keys")
    missing = distinct_keys.where("n_tokens IS NULL").select("digest")
    # A few missing keys reach the scan as a broadcast semi-join; many meet one text per key and task.
    distinct = texts.groupBy("digest").agg(F.min("text").alias("text")).join(missing, "digest", "left_semi")
    counted = written(_encode(distinct, path), "new-counts")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)
    counts = distinct_keys.where("n_tokens IS NOT NULL").unionByName(counted)
    return (
        keys.join(counts, "digest", "left")
        .select("doc_id", "n_bytes", "n_tokens")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
