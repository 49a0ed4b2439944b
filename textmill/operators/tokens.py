"""Tokenisation stage: BPE ids per document, token-length bounds, metrics.

The codec is the only per-row library: it runs in an Arrow-batched pandas
UDF, one encoder per Python worker, a whole batch encoded per call; word
hashes are taken over Arrow batches too, each word of a batch once.  The
special-token test (a text containing a special token string is refused by
the encoder, i.e. ``tokenization_error``) and the length bounds are native
expressions."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TokenConfig

#: the encoding of ``word_hash_tokens``
WORD_HASH = "word_hash"

# FIXED VALUES: the encoder's special token and the id it maps to.
SPECIAL_TOKENS = {"<|endoftext|>": 50256}


@functools.lru_cache(maxsize=4)
def encoding(name: str = "byte_bpe_50k"):
    """A tiktoken Encoding built from a local rank file (no download)."""
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    import public_tokenizers as pt

    ranks = load_tiktoken_bpe(pt.path(f"{name}.tiktoken"))
    return tiktoken.Encoding(name=name, pat_str=pt.PATTERN, mergeable_ranks=ranks,
                             special_tokens=dict(SPECIAL_TOKENS))


def encode_udf(name: str = "byte_bpe_50k"):
    from pyspark.sql import SparkSession
    from ..session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _encode(texts: pa.Array) -> pa.Array:
        return encode_batch(texts, encoding(name))

    return _encode


def encode_batch(texts: pa.Array, enc) -> pa.Array:
    """The ids of each text (null: null).  One text at a time is a Python object;
    ids are numbers of four bytes from the start, in one growing buffer."""
    ids, ends, known = bytearray(), [0], []
    for text in texts:
        text = text.as_py()
        if text is not None:
            ids += enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32).tobytes()
        known.append(text is not None)
        ends.append(len(ids) // 4)
    values = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array([not k for k in known], pa.bool_()))


def annotate(df: DataFrame, cfg: TokenConfig = TokenConfig(), text_col: str = "text") -> DataFrame:
    """Adds ``tokens``, ``token_count`` and ``drop_reason``.  Rows that are
    empty or refused never reach the UDF (it receives null)."""
    text = F.col(text_col)
    empty = text.isNull() | (text == "")
    special = F.lit(False)
    for s in SPECIAL_TOKENS:
        special = special | text.contains(s)
    feed = F.when(~empty & ~special, text)
    encoded = word_hash_tokens(feed) if cfg.encoding == WORD_HASH else encode_udf(cfg.encoding)(feed)
    out = df.withColumn("_enc", encoded)
    n = F.size("_enc")
    reason = (F.when(empty, F.lit("empty_text")).when(special, F.lit("tokenization_error"))
              .when(n < cfg.min_tokens, F.lit("too_few_tokens"))
              .when(n > cfg.max_tokens, F.lit("too_many_tokens")))
    return (out.withColumn("encoded_count", F.when(F.col("_enc").isNotNull(), n).cast("int"))
            .withColumn("drop_reason", reason)
            .withColumn("tokens", F.when(F.col("drop_reason").isNull(), F.col("_enc")))
            .withColumn("token_count", F.when(F.col("drop_reason").isNull(), n).cast("int"))
            .drop("_enc"))


def kept(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("drop_reason").isNull())


REASONS = ("empty_text", "tokenization_error", "too_few_tokens", "too_many_tokens")


def metric_columns() -> dict[str, Column]:
    """Aggregates over annotated rows: counts, each reason, and avg / median
    (truncated) / min / max over every encoded row, including rows then dropped
    for their length."""
    c, reason = F.col("encoded_count"), F.col("drop_reason")
    return {
        "total_samples": F.count(F.lit(1)), "kept_samples": F.count_if(reason.isNull()),
        "dropped_samples": F.count_if(reason.isNotNull()),
        "avg_token_length": F.coalesce(F.avg(c), F.lit(0.0)),
        "median_token_length": F.coalesce(F.floor(F.percentile(c, 0.5)), F.lit(0)).cast("int"),
        "min_token_length": F.coalesce(F.min(c), F.lit(0)), "max_token_length": F.coalesce(F.max(c), F.lit(0)),
        **{f"reason__{r}": F.count_if(reason == r) for r in REASONS},
    }


def metrics(annotated: DataFrame) -> DataFrame:
    """One row: the counts and lengths of ``metric_columns``."""
    return annotated.agg(*[v.alias(k) for k, v in metric_columns().items() if not k.startswith("reason__")])


def drop_counts(annotated: DataFrame) -> DataFrame:
    return (annotated.filter(F.col("drop_reason").isNotNull())
            .groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n")))


def word_hash_tokens(text: Column) -> Column:
    """A deterministic tokenizer expressible in SQL: one id per whitespace
    separated word, the integer of the first 7 hex digits of md5(word).
    Used to check packing and sharding against SQL engines."""
    from pyspark.sql import SparkSession
    from ..session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _hash(texts: pa.Array) -> pa.Array:
        return word_hash_batch(texts)

    return _hash(text)


def word_hash_batch(texts: pa.Array) -> pa.Array:
    """The word ids of each text (null: null); each word of the batch is hashed once."""
    lists = pc.utf8_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    hashes = [int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") >> 4 if w else -1 for w in words.dictionary.to_pylist()]
    ids = np.array(hashes, dtype=np.int32)[words.indices.to_numpy()]
    found = ids >= 0  # whitespace at the ends of a text gives empty words
    ends = np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False))
    ends = np.concatenate([[0], np.concatenate([[0], np.cumsum(found)])[ends]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[found], pa.int32()), mask=texts.is_null())
