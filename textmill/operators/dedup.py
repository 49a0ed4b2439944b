"""Deduplication: exact (content hash) and near-duplicate (MinHash LSH or an
exact prefix-filtered similarity join), both with first-occurrence-wins.

Order is carried by ``original_index``; no operator relies on row order.

Skew: a group of copies may hold a large share of all rows.  Every
"first of group" is computed as ``groupBy(key).agg(min(idx))`` (partial
aggregation combines the hot key map-side) and joined back on the pair
``(key, idx)``, which partitions by the unique index, so no task receives a
whole group.
"""

from __future__ import annotations

from ..session import reliable_checkpoint

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..config import DedupConfig
from ..functions import text as TX
from . import shingle_sets as SS
from .staging import once

IDX = "original_index"


# ---------------------------------------------------------------------------
# E1-E3 fingerprint
# ---------------------------------------------------------------------------

def fingerprint(df: DataFrame, squeeze_punct: bool = False) -> DataFrame:
    """Adds ``canonical_text`` and ``content_hash``; null for empty text.
    Values already present are kept (``coalesce``)."""
    canon = TX.canonical_text(F.col("text"), squeeze_punct)
    if "canonical_text" in df.columns:
        canon = F.coalesce(F.when(F.col("canonical_text") != "", F.col("canonical_text")), canon)
    out = once(df, "canonical_text", canon)
    h = TX.content_hash(F.col("canonical_text"))
    if "content_hash" in df.columns:
        h = F.coalesce(F.when(F.col("content_hash") != "", F.col("content_hash")), h)
    return once(out, "content_hash", F.when(F.col("canonical_text") != "", h))


def first_of_group(df: DataFrame, key: str, flag: str = "is_duplicate") -> DataFrame:
    """``flag`` = this row is not the smallest index of its ``key`` group."""
    firsts = (df.groupBy(key).agg(F.min(IDX).alias("_first_idx"))
              .withColumnRenamed(key, "_k"))
    joined = df.join(firsts, (F.col(key) == F.col("_k")) & (F.col(IDX) == F.col("_first_idx")), "left")
    return joined.withColumn(flag, F.col("_first_idx").isNull()).drop("_k", "_first_idx")


# ---------------------------------------------------------------------------
# E4 exact dedup
# ---------------------------------------------------------------------------

def annotate_exact(df: DataFrame, squeeze_punct: bool = False) -> DataFrame:
    """All rows with text, fingerprinted, with ``is_duplicate``.  Rows
    without text are removed (and not counted as duplicates)."""
    fp = fingerprint(df, squeeze_punct).filter(F.col("content_hash").isNotNull())
    return first_of_group(fp, "content_hash")


# ---------------------------------------------------------------------------
# E5 shingles
# ---------------------------------------------------------------------------

# Every overlapping window of three space-separated words, captured by a
# zero-width match at each word start (one JVM regex pass, no lambda).
_TRIGRAM = r"(?<![^ ])(?=([^ ]+ [^ ]+ [^ ]+))"


def add_shingles(df: DataFrame, canonical_col: str = "canonical_text", out: str = "shingles") -> DataFrame:
    """Distinct word 3-grams of the canonical text.  The canonical text has
    single spaces between words and none at the ends, so its words are
    exactly the space-separated pieces."""
    grams = F.regexp_extract_all(F.col(canonical_col), F.lit(_TRIGRAM), 1)
    return df.withColumn(out, F.coalesce(F.array_distinct(grams), F.array().cast("array<string>")))


# ---------------------------------------------------------------------------
# E6 MinHash signature (Arrow batch UDF; numpy over the whole batch)
# ---------------------------------------------------------------------------

_MASK32 = np.uint64((1 << 32) - 1)
_CHUNK = 1 << 13  # shingles hashed per numpy step (x 128 lanes): small temporaries


def _perm_params(num_perm: int, seed: int):
    """Multiply-shift family h_k(x) = ((a_k * x + b_k) mod 2^64) >> 32 with
    odd a_k: universal for 32-bit keys, two integer ops per lane."""
    rng = np.random.RandomState(seed)
    a = rng.randint(0, 1 << 62, size=num_perm, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.randint(0, 1 << 62, size=num_perm, dtype=np.uint64)
    return a, b


def minhash_batch(hash_lists, num_perm: int = 128, seed: int = 1) -> list:
    """Signatures for a batch: all shingle hashes of the batch are hashed
    in chunks of one matrix each and reduced per document with
    ``np.minimum.reduceat``; a document without shingles gets all-max."""
    a, b = _perm_params(num_perm, seed)
    lens = np.fromiter((0 if h is None else len(h) for h in hash_lists), dtype=np.int64, count=len(hash_lists))
    out = np.full((len(hash_lists), num_perm), int(_MASK32), dtype=np.int64)
    nz = np.flatnonzero(lens)
    if len(nz) == 0:
        return list(out)
    flat = np.concatenate([np.asarray(hash_lists[i], dtype=np.int64) for i in nz]).astype(np.uint64) & _MASK32
    starts = np.concatenate([[0], np.cumsum(lens[nz])[:-1]])
    ends = starts + lens[nz]
    # process documents in groups whose shingles fit one chunk
    i = 0
    while i < len(nz):
        j = i
        while j < len(nz) and (ends[j] - starts[i] <= _CHUNK or j == i):
            j += 1
        x = flat[starts[i]:ends[j - 1]][:, None]
        v = np.multiply(x, a[None, :])
        np.add(v, b[None, :], out=v)
        np.right_shift(v, np.uint64(32), out=v)
        out[nz[i:j]] = np.minimum.reduceat(v, starts[i:j] - starts[i], axis=0).astype(np.int64)
        i = j
    return list(out)


def minhash_udf(num_perm: int = 128, seed: int = 1):
    from pyspark.sql import SparkSession
    from ..session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def _sig(hashes: pd.Series) -> pd.Series:
        return pd.Series(minhash_batch(hashes.tolist(), num_perm, seed))

    return _sig


def signature(shingle_col: Column, cfg: DedupConfig) -> Column:
    """128 (by default) minima of a seeded universal hash family over the
    32-bit shingle hashes.  Shingles are hashed JVM-side (xxhash64), so only
    integer arrays cross into Python."""
    hashed = F.transform(shingle_col, lambda s: F.xxhash64(s))
    return minhash_udf(cfg.num_perm, cfg.seed)(hashed)


# ---------------------------------------------------------------------------
# E7-E8 banding, candidate pairs and verification
# ---------------------------------------------------------------------------

_GRID = 1000  # points of the integrals over the similarity


@functools.cache
def lsh_parameters(threshold: float, num_perm: int = 128, recall: float | None = None) -> tuple[int, int]:
    """(bands, rows a band) with bands * rows <= num_perm for pairs of at least
    ``threshold``.

    A pair of similarity s shares a band with probability 1 - (1 - s^r)^b.  Its
    integral below the threshold measures useless candidates, that of the rest
    above it lost pairs.  Without ``recall`` both weigh the same; with it, the
    setting of fewest useless candidates is taken among those that keep that
    share of the pairs above the threshold (similarities spread evenly)."""
    if not 0 < threshold < 1 or num_perm < 1 or not (recall is None or 0 < recall < 1):
        raise ValueError("0 < threshold, recall < 1 and at least one permutation are expected")
    s = (np.arange(_GRID) + 0.5) / _GRID
    below, above = s * threshold, threshold + s * (1 - threshold)
    best, most = None, None
    for r in range(1, num_perm + 1):
        b = np.arange(1, num_perm // r + 1)[:, None]
        useless = threshold * (1 - (1 - below ** r) ** b).mean(axis=1)
        lost = ((1 - above ** r) ** b).mean(axis=1)
        for bands, u, x in zip(b[:, 0].tolist(), useless.tolist(), lost.tolist()):
            cost = u + (1 - threshold) * x if recall is None else u
            if (recall is None or 1 - x >= recall) and (best is None or cost < best[0]):
                best = (cost, bands, r)
            if most is None or x < most[0]:
                most = (x, bands, r)
    return (best or most)[1:]  # no setting keeps that share: the one that keeps most


def _reps(fp: DataFrame, cfg: DedupConfig) -> DataFrame:
    """Compact table (index, shingles or signature, ``_copy``) for the
    near-duplicate joins.  ``_rep_key`` identifies equal representations
    (equal signature, or equal shingle set in exact mode), whose later
    members are duplicates of the first."""
    return _marked_reps(fp, cfg)[1]


def _marked_reps(fp: DataFrame, cfg: DedupConfig) -> tuple[DataFrame, DataFrame]:
    """(narrow, whole): rows with ``_rep_key`` and ``_copy``, and the same rows
    with their representation.  The narrow rows, or those with signatures, are
    read by several joins, so they are checkpointed once (shared checkpoint
    folder): the signature UDF runs once per row and lineage stays short.

    Shingles repeat a text three times, so they are neither written nor shuffled:
    the whole rows are the texts of the input, found by index and hash, and
    shingles are taken from them where they are read."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(fp.sparkSession)
    if cfg.verify == "exact":
        marked = _named(fp, None)[0]
        texts = fp.select(IDX, "content_hash", "canonical_text")
    else:
        out = once(add_shingles(fp.select(IDX, "canonical_text")), "sig", signature(F.col("shingles"), cfg)).select(IDX, "sig")
        out = out.withColumn("_rep_key", F.sha2(F.array_join(F.transform("sig", lambda x: x.cast("string")), ","), 256))
        # the signature UDF runs once per row: the table is persisted while both
        # sides of first_of_group read it, and the marked result is checkpointed
        out = out.persist()
        marked = reliable_checkpoint(first_of_group(out, "_rep_key", "_copy"))
        out.unpersist()
        return marked, marked
    marks = marked.select(F.col(IDX).alias("_i"), F.col("content_hash").alias("_h"), "_rep_key", "_copy").distinct()
    found = texts.join(marks, F.col(IDX).eqNullSafe(F.col("_i")) & F.col("content_hash").eqNullSafe(F.col("_h")))
    return marked, add_shingles(found.drop("_i", "_h"))


def _bands(reps: DataFrame, cfg: DedupConfig) -> DataFrame:
    if cfg.recall is None and cfg.bands and cfg.rows_per_band:
        b, r = cfg.bands, cfg.rows_per_band
    else:
        b, r = lsh_parameters(cfg.threshold, cfg.num_perm, cfg.recall)
    bands = F.transform(F.sequence(F.lit(0), F.lit(b - 1)),
                        lambda b: F.struct(b.alias("band"), F.xxhash64(F.slice("sig", b * r + 1, r)).alias("bh")))
    return reps.select(IDX, F.explode(bands).alias("b")).select(IDX, "b.band", "b.bh")


def minhash_candidates(reps: DataFrame, cfg: DedupConfig) -> DataFrame:
    """(i, j), i < j, sharing at least one LSH band.  Bands are explode'd as
    (band, 64-bit hash of the band's slots); the self equi-join on
    (band, hash) only carries indices, never signatures."""
    ex = _bands(reps, cfg)
    a, b = ex.alias("a"), ex.alias("b")
    return (a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.bh") == F.col("b.bh"))
                   & (F.col(f"a.{IDX}") < F.col(f"b.{IDX}")))
            .select(F.col(f"a.{IDX}").alias("i"), F.col(f"b.{IDX}").alias("j")).distinct())


#: counters of the shingle frequencies that order the prefixes, and their share
#: in a row of the table
COUNTERS = 1 << 20
_COUNTER_ROW = 1 << 16


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.select(IDX, F.transform("shingles", lambda s: F.xxhash64(s)).alias("h"))


def _flat(lists) -> tuple:
    """Values and row limits of an Arrow array of lists (null: empty)."""
    ends = np.concatenate([[0], np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))])
    return lists.flatten().to_numpy(zero_copy_only=False), ends


def shingle_counters(rows: DataFrame) -> np.ndarray:
    """How many rows' shingles fall on each of ``COUNTERS`` counters, by hash.
    Tasks send their counters, not their shingles, so what is shuffled and what
    the driver holds depends on ``COUNTERS`` alone."""
    from ..session import ship_package
    ship_package(rows.sparkSession)

    def count(batches):
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0))[0] & (COUNTERS - 1), minlength=COUNTERS)
        for no, part in enumerate(total.reshape(-1, _COUNTER_ROW)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([no], pa.int32()), pa.array([part.astype(np.int32).tobytes()])], ["no", "part"])

    def add(batches):
        sums = {}
        for batch in batches:
            for no, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[no] = sums.get(no, 0) + np.frombuffer(part.as_buffer(), dtype=np.int32).astype(np.int64)
        for no, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([no], pa.int32()), pa.array([total.tobytes()])], ["no", "part"])

    parts = _hashed(rows).select("h").mapInArrow(count, "no int, part binary").repartition("no").mapInArrow(add, "no int, part binary")
    out = np.zeros(COUNTERS, dtype=np.int64)
    for row in parts.collect():
        out[row["no"] * _COUNTER_ROW:(row["no"] + 1) * _COUNTER_ROW] = np.frombuffer(row["part"], dtype=np.int64)
    return out


def prefix_of(hashes: np.ndarray, counters: np.ndarray, threshold: float) -> np.ndarray:
    """The distinct hashes in a set's prefix, rarest counters first."""
    n = len(hashes)
    order = np.lexsort((hashes, counters[hashes & (COUNTERS - 1)]))
    return np.unique(hashes[order[:n - int(np.ceil(n * threshold - 1e-9)) + 1]])


def _prefixes(rows: DataFrame, threshold: float) -> DataFrame:
    """(index, keys, set size): hashes of each set's prefix.

    The prefix filter holds for any order that all sets share, here by the
    counter of a shingle's hash and by the hash: rare shingles come first, without
    a shuffle of all shingles.  Different shingles of equal hash count as equal,
    which only adds candidates."""
    counters = rows.sparkSession.sparkContext.broadcast(shingle_counters(rows))

    def cut(batches):
        for batch in batches:
            values, ends = _flat(batch.column(1))
            keys = [prefix_of(values[a:b], counters.value, threshold) for a, b in zip(ends[:-1], ends[1:])]
            limits = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(flat, pa.int64())),
                pa.array(np.diff(ends), pa.int32())], [IDX, "keys", "n"])

    kind = rows.schema[IDX].dataType.simpleString()
    return _hashed(rows).mapInArrow(cut, f"{IDX} {kind}, keys array<bigint>, n int")


def _shared_keys(prefixes: DataFrame) -> DataFrame:
    """(index, key, set size) of keys that several rows have."""
    keys = reliable_checkpoint(prefixes).select(IDX, F.explode("keys").alias("key"), "n").distinct()
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("key")
    return keys.join(shared, "key", "left_semi")


def _first_prefixes(fp: DataFrame, marked: DataFrame, threshold: float) -> DataFrame:
    """Prefixes of the rows that are no copies, taken from the texts where they
    are read and picked afterwards."""
    firsts = marked.where(~F.col("_copy")).select(IDX).distinct()
    return _prefixes(add_shingles(fp.select(IDX, "canonical_text")), threshold).join(firsts, IDX, "left_semi")


def prefix_candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """(i, j), i < j, that can reach Jaccard >= threshold: the exact prefix
    filter.  Shingles are ordered rarest first; two sets with Jaccard >= t share
    a shingle within their first ``|A| - ceil(t*|A|) + 1`` shingles, and their
    sizes differ by at most the factor t.  No candidate is lost, so no cap is
    needed."""
    return _prefix_pairs(_prefixes(reps, threshold), threshold)


def _prefix_pairs(prefixes: DataFrame, threshold: float) -> DataFrame:
    pre = _shared_keys(prefixes)
    a, b = pre.alias("a"), pre.alias("b")
    cond = ((F.col("a.key") == F.col("b.key")) & (F.col(f"a.{IDX}") < F.col(f"b.{IDX}"))
            & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * F.lit(threshold) - F.lit(1e-9)))
    return a.join(b, cond).select(F.col(f"a.{IDX}").alias("i"), F.col(f"b.{IDX}").alias("j")).distinct()


def verified_edges(reps: DataFrame, cfg: DedupConfig) -> DataFrame:
    """Candidate pairs whose similarity is strictly above the threshold:
    share of equal signature slots (minhash) or exact Jaccard of the
    shingle sets (exact)."""
    cands = prefix_candidates(reps, cfg.threshold) if cfg.verify == "exact" else minhash_candidates(reps, cfg)
    return _similar(cands, reps, cfg)


#: ids that are broadcast to pick their texts; more are joined
BROADCAST_IDS = 1 << 20


def _few(rows: DataFrame) -> DataFrame:
    """Broadcast to pick other rows, unless there are many."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows


def _named(fp: DataFrame, threshold: float | None) -> tuple[DataFrame, DataFrame]:
    """(marked, keyed): rows (index, hash, ``_rep_key``, ``_copy``) and rows (index,
    hash, keys that similar sets share), from one pass over the texts."""
    from ..session import ship_package
    ship_package(fp.sparkSession)

    def name(batches):
        for batch in batches:
            sets, keys = SS.names_and_keys(batch.column(2), threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sets, keys], [IDX, "content_hash", "_rep_key", "keys"])

    kind = fp.schema[IDX].dataType.simpleString()
    named = reliable_checkpoint(fp.select(IDX, "content_hash", "canonical_text").mapInArrow(
        name, f"{IDX} {kind}, content_hash string, _rep_key binary, keys array<bigint>"))
    marked = reliable_checkpoint(first_of_group(named.drop("keys"), "_rep_key", "_copy"))
    return marked, named.select(IDX, "content_hash", "keys")


#: rounds in which buckets that overlap take a common label, and pairs a row that a
#: family may cost beyond those of its buckets
LABEL_ROUNDS = 3
FAMILY_PAIRS_PER_ROW = 128


def _blocks(size: Column, rows: Column) -> Column:
    return F.greatest(F.ceil(size / BLOCK_NAMES), F.ceil(rows / BLOCK_ROWS))


def _sizes(sets: DataFrame) -> DataFrame:
    return sets.groupBy(IDX).agg(F.sum(F.size("names")).alias("size"), F.count(F.lit(1)).alias("rows"))


def _families(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Buckets that bring the same pairs together, and fewer of them.

    Copies of a few words' difference share many keys.  Of buckets with equal
    members one is left.  Buckets that overlap take the smallest index they reach; those
    whose members all have the same label become one bucket, if no more sets are sent
    for its blocks than for theirs and its pairs are few or not more than theirs.  The
    others stay as they are, so no pair is lost."""
    groups = buckets.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(IDX)).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), IDX)).alias("b")).where("n > 1")
    one = groups.groupBy("n", "a", "b").agg(F.min("key").alias("key")).select("key")
    buckets = reliable_checkpoint(buckets.join(one, "key", "left_semi"))
    label = buckets.select(IDX).distinct().withColumn("label", F.col(IDX))
    for _ in range(LABEL_ROUNDS):
        labelled = buckets.join(label, IDX)
        least = labelled.groupBy("key").agg(F.min("label").alias("least"))
        label = reliable_checkpoint(labelled.join(least, "key").groupBy(IDX).agg(F.min("least").alias("label")))
    sized = reliable_checkpoint(label.select(IDX, "label").join(_sizes(sets), IDX))
    spread = buckets.join(sized, IDX).groupBy("key").agg(
        F.min("label").alias("label"), F.max("label").alias("other"), F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("size").alias("size"), F.sum("rows").alias("rows"))
    inside = spread.where("label = other").withColumn("sent", F.col("size") * _blocks(F.col("size"), F.col("rows")))
    theirs = inside.groupBy("label").agg(F.sum(F.expr("n * (n - 1) / 2")).alias("pairs"), F.sum("sent").alias("sent"))
    whole = sized.groupBy("label").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("size").alias("size"), F.sum("rows").alias("rows"))
    few = F.col("n") * (F.col("n") - 1) / 2 <= F.greatest("pairs", F.col("n") * FAMILY_PAIRS_PER_ROW)
    joined = reliable_checkpoint(theirs.join(whole, "label").where(
        few & (F.col("size") * _blocks(F.col("size"), F.col("rows")) <= F.col("sent"))).select("label"))
    left = buckets.join(inside.join(joined, "label", "left_semi").select("key"), "key", "left_anti")
    families = label.join(joined, "label", "left_semi").select(F.xxhash64("label", F.lit("family")).alias("key"), IDX)
    return left.select("key", IDX).unionByName(families)


def _exact_buckets(fp: DataFrame, marked: DataFrame, keyed: DataFrame, cfg: DedupConfig) -> DataFrame:
    """(key, index) of the rows that are no copies: each similar pair meets in some key."""
    if cfg.threshold < SS.PARTS_FROM:
        shared = _shared_keys(_first_prefixes(fp, marked, cfg.threshold)).select("key", IDX)
    else:
        copies = _few(marked.where(F.col("_copy") & F.col(IDX).isNotNull()).select(IDX, "content_hash").distinct())
        keys = (keyed.where(F.col(IDX).isNotNull()).join(copies, [IDX, "content_hash"], "left_anti")
                .select(IDX, F.explode("keys").alias("key")))
        several = reliable_checkpoint(keys.groupBy("key").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("key"))
        shared = keys.join(_few(several), "key", "left_semi").select("key", IDX)
    return reliable_checkpoint(shared.distinct())


def _member_sets(fp: DataFrame, marked: DataFrame, buckets: DataFrame) -> DataFrame:
    """(index, ``_row``, names) of the rows of some bucket that are no copies, named
    once: 64 bits a shingle."""
    def name(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), SS.member_names(batch.column(1))], [IDX, "names"])

    copies = _few(marked.where(F.col("_copy") & F.col(IDX).isNotNull()).select(IDX, "content_hash").distinct())
    texts = (fp.select(IDX, "content_hash", "canonical_text").join(_few(buckets.select(IDX).distinct()), IDX, "left_semi")
             .join(copies, [IDX, "content_hash"], "left_anti").select(IDX, "canonical_text"))
    kind = fp.schema[IDX].dataType.simpleString()
    named = texts.mapInArrow(name, f"{IDX} {kind}, names array<bigint>")
    return reliable_checkpoint(named.withColumn("_row", F.monotonically_increasing_id()))


def _exact(fp: DataFrame, cfg: DedupConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(marked rows, buckets, sets of their members)."""
    marked, keyed = _named(fp, cfg.threshold if cfg.threshold >= SS.PARTS_FROM else None)
    buckets = _exact_buckets(fp, marked, keyed, cfg)
    sets = _member_sets(fp, marked, buckets)
    return marked, reliable_checkpoint(_families(buckets, sets)), sets


#: shingles and rows of a block; a bucket's rows are compared block by block
BLOCK_NAMES = 1 << 21
BLOCK_ROWS = 1 << 11


def bucket_pairs(buckets: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Distinct (i, j, row of i, row of j), i < j, similar and of one bucket; if
    the buckets have a column ``kept``, only of a kept i and a j that is not.

    A bucket's rows are dealt to blocks of bounded size and each two blocks are
    compared as a product of matrices, so sets are sent for each block and not for
    each pair."""
    both = "kept" not in buckets.columns

    def compare(table):
        idx, rows = table[IDX], table["_row"]
        a, b = SS.similar_rows(table["names"].combine_chunks(), table["block"].to_numpy(), threshold)
        value, kept = idx.to_numpy(), table["kept"].to_numpy()
        use = (value[a] < value[b]) & (both | (kept[a] & ~kept[b]))
        a, b = pa.array(a[use]), pa.array(b[use])
        return pa.Table.from_arrays([idx.take(a), idx.take(b), rows.take(a), rows.take(b)], ["i", "j", "ri", "rj"])

    if both:
        buckets = buckets.withColumn("kept", F.lit(True))
    blocks = buckets.join(_sizes(sets), IDX).groupBy("key").agg(_blocks(F.sum("size"), F.sum("rows")).cast("int").alias("blocks"))
    dealt = (buckets.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64(IDX), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", IDX, "kept", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    kind = buckets.schema[IDX].dataType.simpleString()
    found = dealt.join(sets, IDX).groupBy("key", "lo", "hi").applyInArrow(compare, f"i {kind}, j {kind}, ri bigint, rj bigint")
    return found.distinct()


def near_pairs(fp: DataFrame, cfg: DedupConfig) -> DataFrame:
    """(i, j), i < j, of the rows that are no copies and whose shingle sets are
    similar."""
    _, buckets, sets = _exact(fp, cfg)
    return bucket_pairs(buckets, sets, cfg.threshold).select("i", "j")


def _near_named(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The similar ones of (lead, index) pairs."""
    a, b = (sets.select(F.col(IDX).alias(x), F.col("names").alias(f"_{x}")) for x in ("lead", IDX))
    joined = pairs.join(a, "lead").join(b, IDX)
    joined = once(joined, "_inter", F.size(F.array_intersect("_lead", f"_{IDX}")))
    union = F.size("_lead") + F.size(f"_{IDX}") - F.col("_inter")
    sim = F.when(union == 0, F.lit(1.0)).otherwise(F.col("_inter") / union)
    return joined.where(sim > F.lit(threshold)).select("lead", IDX)


def _similar(pairs: DataFrame, reps: DataFrame, cfg: DedupConfig) -> DataFrame:
    """The pairs (i, j) whose similarity is strictly above the threshold.  Only
    rows of some pair are shuffled; in exact mode as texts, shingled after the joins."""
    pairs = reliable_checkpoint(pairs)
    ids = pairs.select(F.explode(F.array("i", "j")).alias("_p")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    exact = cfg.verify == "exact"
    side = reps.join(ids, F.col(IDX) == F.col("_p"), "left_semi").select(
        F.col(IDX).alias("_id"), F.col("canonical_text" if exact else "sig").alias("_v"))
    left = pairs.join(side.withColumnRenamed("_v", "va"), F.col("i") == F.col("_id")).drop("_id")
    both = left.join(side.withColumnRenamed("_v", "vb"), F.col("j") == F.col("_id")).drop("_id")
    if exact:
        both = once(add_shingles(both, "va", "va"), "va", F.col("va"))
        both = once(add_shingles(both, "vb", "vb"), "vb", F.col("vb"))
        both = both.select("i", "j", "va", "vb", F.size("va").alias("na"), F.size("vb").alias("nb"))
        # sets whose sizes differ by more than the threshold are not compared
        near = F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(cfg.threshold) - F.lit(1e-9)
        inter = F.col("_inter")
        union = F.col("na") + F.col("nb") - inter
        both = once(both, "_inter", F.when(near, F.size(F.array_intersect("va", "vb"))).otherwise(F.lit(0)))
        sim = F.when(union == 0, F.lit(1.0)).otherwise(inter / union)
    else:
        eq = F.size(F.filter(F.zip_with("va", "vb", lambda x, y: x == y), lambda e: e))
        sim = eq / F.lit(float(cfg.num_perm))
    return once(both, "similarity", sim).select("i", "j", "similarity").filter(F.col("similarity") > F.lit(cfg.threshold))


# ---------------------------------------------------------------------------
# E9 greedy first-occurrence-wins
# ---------------------------------------------------------------------------

#: rounds of leaders between two looks at what is left, and the pairs a
#: remaining (row, bucket) may cost when they are listed
LEADER_ROUNDS = 4
PAIRS_PER_ROW = 64
#: the same where pairs are listed block by block
BLOCK_PAIRS_PER_ROW = 1024


def greedy_dropped(edges: DataFrame) -> DataFrame:
    """Indices dropped by the sequential rule "in order, drop a row iff it
    is similar to an earlier kept row", over listed similar pairs (i, j), i < j.

    A row is kept iff each of its conditions holds, at first "i is dropped" for
    every earlier neighbour i.  Each round settles the conditions on rows decided
    in the last one, decides the rows of which one fails or all hold, and
    contracts: a row with a single condition is kept iff that holds, so a
    condition on it becomes one on that row's own, possibly reversed.  So chains
    halve every round, and the rounds grow with the logarithm of a chain."""
    edges = reliable_checkpoint(edges.select("i", "j").distinct())
    deps = edges.select(F.col("j").alias("node"), F.col("i").alias("on"), F.lit(False).alias("kept"))
    decided = edges.select(F.col("i").alias("node")).distinct().join(
        edges.select(F.col("j").alias("node")), "node", "left_anti").withColumn("is_kept", F.lit(True))
    dropped = edges.select(F.col("j").alias(IDX)).limit(0)
    while True:
        known = decided.select(F.col("node").alias("on"), "is_kept")
        met = deps.join(known, "on", "left").groupBy("node", "on").agg(
            F.min("kept").alias("kept"), (F.min("kept") != F.max("kept")).alias("contrary"), F.max("is_kept").alias("is_kept"))
        met = met.select("node", "on", "kept", (F.col("contrary") | F.coalesce(F.col("is_kept") != F.col("kept"), F.lit(False))).alias("fails"),
                         F.col("is_kept").isNull().alias("open"))
        verdict = met.groupBy("node").agg(F.bool_or("fails").alias("falls"), F.count_if("open").alias("left"))
        state = reliable_checkpoint(met.join(verdict, "node"))
        dropped = dropped.union(state.where("falls").select("node").distinct())
        more = state.where("open AND NOT falls").select("node", "on", "kept", "left")
        if more.isEmpty():
            return dropped
        decided = state.where("falls OR left = 0").select("node", (~F.col("falls")).alias("is_kept")).distinct()
        single = more.where("left = 1").select(F.col("node").alias("on"), F.col("on").alias("next"), F.col("kept").alias("if_kept"))
        deps = more.join(single, "on", "left").select(
            "node", F.coalesce("next", "on").alias("on"),
            F.when(F.col("next").isNull(), F.col("kept")).otherwise(F.col("kept") == F.col("if_kept")).alias("kept"))


def leader_rounds(buckets: DataFrame, similar, listed=None) -> DataFrame:
    """Indices dropped by the sequential rule, without listing the pairs of a
    bucket.  ``buckets`` (key, index) brings every similar pair together in
    some bucket; ``similar`` keeps the similar ones of (lead, index) pairs.

    A bucket's leader is its smallest undecided row.  A row that leads all its
    buckets has no undecided earlier candidate and was not dropped by a kept
    one: it is kept, compared with the undecided members of its buckets, and
    leaves them with the rows that it drops.  So a bucket of n rows costs
    (members x kept leaders) comparisons, and the minimum combines map-side.

    Copies and stars go in a few rounds; a chain would take a round for every
    two of its rows.  So after each ``LEADER_ROUNDS``, the pairs of the rows that
    are left are listed if they are at most ``PAIRS_PER_ROW`` a row and bucket,
    and decided by ``greedy_dropped``; otherwise leaders go on.  ``listed`` gives the
    similar (i, j) of buckets at less than a pair's cost each, so that is looked at
    before the first round too."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(buckets.sparkSession)
    dropped = buckets.select(IDX).limit(0)
    state, rounds = reliable_checkpoint(buckets.select("key", IDX).distinct()), 0
    while True:
        lead = state.groupBy("key").agg(F.min(IDX).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
        led = reliable_checkpoint(state.join(lead, "key").select("key", IDX, "lead", "n"))
        size = led.agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("n") - 1) / 2).alias("pairs")).first()
        if not size["rows"]:
            return dropped
        if listed and rounds % LEADER_ROUNDS == 0 and size["pairs"] <= BLOCK_PAIRS_PER_ROW * size["rows"]:
            return dropped.union(greedy_dropped(listed(led.select("key", IDX))))
        if not listed and rounds and rounds % LEADER_ROUNDS == 0 and size["pairs"] <= PAIRS_PER_ROW * size["rows"]:
            first, second = led.select("key", F.col(IDX).alias("lead")), led.select("key", IDX)
            pairs = first.join(second, "key").where(F.col("lead") < F.col(IDX)).select("lead", IDX).distinct()
            edges = reliable_checkpoint(similar(pairs).select(F.col("lead").alias("i"), F.col(IDX).alias("j")))
            return dropped.union(greedy_dropped(edges))
        waiting = led.where(F.col(IDX) != F.col("lead")).select(IDX).distinct()
        kept = led.select(F.col("lead").alias(IDX)).distinct().join(waiting, IDX, "left_anti")
        pairs = (led.where(F.col(IDX) != F.col("lead")).select("lead", IDX).distinct()
                 .join(kept.withColumnRenamed(IDX, "lead"), "lead", "left_semi"))
        gone = reliable_checkpoint(similar(pairs).select(IDX).distinct())
        dropped = dropped.union(gone)
        state = led.select("key", IDX).join(kept, IDX, "left_anti").join(gone, IDX, "left_anti")
        rounds += 1


def _near(pairs: DataFrame, firsts: DataFrame, cfg: DedupConfig) -> DataFrame:
    """The similar ones of (lead, index) pairs."""
    return _similar(pairs.select(F.col("lead").alias("i"), F.col(IDX).alias("j")), firsts, cfg).select(
        F.col("i").alias("lead"), F.col("j").alias(IDX))


def _decided(fp: DataFrame, cfg: DedupConfig) -> tuple[DataFrame, DataFrame, DataFrame, object]:
    """(marked rows, buckets, dropped indices, leaders of kept and dropped rows):
    buckets are LSH bands, or in exact mode keys that similar sets share."""
    if cfg.verify == "exact":
        reps, buckets, sets = _exact(fp, cfg)
        rounds, edges = [], []

        def similar(pairs):
            rounds.append(1)
            return _near_named(pairs, sets, cfg.threshold)

        def listed(rows):
            edges.append(reliable_checkpoint(bucket_pairs(rows, sets, cfg.threshold).select("i", "j").distinct()))
            return edges[0]

        dropped = leader_rounds(buckets, similar, listed)

        def led(kept, members):
            if edges and not rounds:  # all pairs were listed
                pairs = edges[0].select(F.col("i").alias("lead"), F.col("j").alias(IDX))
                return pairs.join(kept.select("lead").distinct(), "lead", "left_semi").join(members.select(IDX).distinct(), IDX, "left_semi")
            rows = kept.select("key", F.col("lead").alias(IDX), F.lit(True).alias("kept"))
            rows = rows.unionByName(members.select("key", IDX, F.lit(False).alias("kept")))
            return bucket_pairs(rows, sets, cfg.threshold).select(F.col("i").alias("lead"), F.col("j").alias(IDX))
        return reps, buckets, dropped, led
    reps, _ = _marked_reps(fp, cfg)
    firsts = reps.filter(~F.col("_copy"))
    buckets = reliable_checkpoint(_bands(firsts, cfg).select(F.xxhash64("band", "bh").alias("key"), IDX).distinct())

    def led(kept, members):
        pairs = kept.join(members, "key").where(F.col("lead") < F.col(IDX)).select("lead", IDX).distinct()
        return _near(pairs, firsts, cfg)
    return reps, buckets, leader_rounds(buckets, lambda pairs: _near(pairs, firsts, cfg)), led


def leaders(df: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """(index, leader) of every row that the near-duplicate rule drops: the
    smallest kept row it is similar to; of a copy (equal representation), its
    first one or that one's leader.  A row is compared with the kept rows of its
    buckets only, so a group of copies costs its size and not its square."""
    fp = fingerprint(df, cfg.squeeze_punct).filter(F.col("content_hash").isNotNull())
    reps, buckets, dropped, near = _decided(fp, cfg)
    dropped = reliable_checkpoint(dropped.distinct())
    members = buckets.join(dropped, IDX, "left_semi")
    kept = buckets.join(dropped, IDX, "left_anti").withColumnRenamed(IDX, "lead")
    led = reliable_checkpoint(near(kept, members).groupBy(IDX).agg(F.min("lead").alias("leader")))
    first_copy = reps.where(~F.col("_copy")).select("_rep_key", F.col(IDX).alias("first"))
    copies = (reps.where("_copy").select(IDX, "_rep_key").join(first_copy, "_rep_key")
              .join(led.select(F.col(IDX).alias("first"), "leader"), "first", "left")
              .select(IDX, F.coalesce("leader", "first").alias("leader")))
    return led.unionByName(copies)


def annotate_near(df: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """All rows with text, fingerprinted, with ``is_duplicate`` by the
    near-duplicate rule (first occurrence wins)."""
    fp = fingerprint(df, cfg.squeeze_punct).filter(F.col("content_hash").isNotNull())
    reps, _, dropped, _ = _decided(fp, cfg)
    decided = (reps.select(IDX, "_copy").join(dropped.withColumn("_dropped", F.lit(True)), IDX, "left")
               .select(IDX, (F.col("_copy") | F.coalesce("_dropped", F.lit(False))).alias("is_duplicate")))
    return fp.join(decided, IDX, "inner")


def deduplicate(df: DataFrame, cfg: DedupConfig = DedupConfig()) -> DataFrame:
    """Dispatch on ``cfg.method`` (case-folded): minhash | hash | none."""
    method = "none" if cfg.method is None else str(cfg.method).lower()
    if method == "none":
        return fingerprint(df, cfg.squeeze_punct).withColumn("is_duplicate", F.lit(False))
    if method == "hash":
        return annotate_exact(df, cfg.squeeze_punct)
    if method == "minhash":
        return annotate_near(df, cfg)
    raise ValueError(f"Unknown deduplication method: {cfg.method}")


def metric_columns() -> dict[str, Column]:
    """Aggregates over annotated rows."""
    total, dups = F.count(F.lit(1)), F.count_if(F.col("is_duplicate"))
    return {"total_samples": total, "kept_samples": total - dups, "duplicates_removed": dups,
            "duplicate_rate": F.when(total > 0, dups / total).otherwise(F.lit(0.0))}


def metrics(annotated: DataFrame) -> DataFrame:
    return annotated.agg(*[v.alias(k) for k, v in metric_columns().items()])
