"""Near-duplicate documents by SetSketch registers, banding and verification.

A document is its set of distinct word shingles.  Its sketch has ``registers``
values: register i is floor(1 - log_b(min h_i)), the truncated minimum of
exponential hash values h_i of rate ``RATE`` over the set; sketches of parts
merge by maximum, and equal registers are about as likely as the sets are
alike.  Stages:

1. sketch every text, one row per distinct text;
2. hash bands of registers to buckets; each member of a bucket is paired with
   the bucket's leader, the member that shares most buckets (members, not pairs);
3. estimate each pair's similarity by maximum likelihood from the registers
   that are larger, smaller and equal, given both set sizes; pairs within five
   standard errors of the threshold are verified on the full sets, and links
   give components;
4. pairs that the leaders did not settle.  A link x - y in a bucket of leader l
   has similarities to l at most 0.2 apart, so either both are related to l
   (estimate of ``RELATED`` or more), or neither is close to it (``CLOSE``).
   Documents related to common leaders make a family: those of its members
   outside the family's largest component are compared with all others, in
   bounded blocks, by exact counts of common shingles.  Members that are not
   close to their leader are compared with each other inside their bucket, by
   sketches in bounded blocks and then by verification.

Only links leave a block, at most one for each component that it joins.  So no
pair that shares a bucket and could join two components is left out.

A band of ``band`` registers is missed with 1 - s^band; with 50 bands of 6, a
pair at similarity 0.8 shares none with probability 2.5e-7.

Defined results: null, empty and wordless texts have no shingles, are linked
with nothing and kept; fewer words than a shingle make one shingle of all;
exact copies are always linked; the smallest non-null id names a component; a
row is kept if its id is that id (rows of equal id and text all carry the same
flag); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.components import components
from textmill.llm.store import prepare, written
from textmill.llm.words import NOT_SPACE, U64, mix, slices, split_words, window_names

SHINGLE = 5
SIMILARITY = 80  # per cent
REGISTERS = 300
BAND = 6
BASE = 1.001
RATE = 20.0
ERRORS = 5.0  # standard errors below the threshold that are still verified
RELATED, CLOSE = 0.4, 0.75  # estimates; they differ by 0.2 and five standard errors
BLOCK = 256

_MULTIPLIERS = (mix(np.arange(1, 4097, dtype=U64) * U64(0x9E3779B97F4A7C15)) >> U64(32)).astype(np.uint32) | np.uint32(1)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle names of each row."""
    w = split_words(data, offs, NOT_SPACE, lower=True)
    h, first = w.hashes(), w.row_first
    names = window_names(h, width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(names[a: b - width + 1]))
        else:
            out.append(window_names(h[a:b], b - a) if b > a else np.empty(0, dtype=U64))
    return out


def registers(items: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Registers of one set (sorted or not); the empty set gives zeros."""
    if not len(items):
        return np.zeros(m, dtype=np.uint16)
    x = (items >> U64(32)).astype(np.uint32)
    a = _MULTIPLIERS[:m, None]
    least = np.full(m, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(x), 512):  # the product stays in cache
        np.minimum(least, (a * x[None, at: at + 512]).min(axis=1), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1.0 - np.log(exponential) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def similarity(larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, n_u: np.ndarray, n_v: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """(maximum-likelihood Jaccard similarity, standard error) from the counts
    of registers of U that are larger, smaller and equal, given |U| and |V|."""
    u, v = n_u / (n_u + n_v), n_v / (n_u + n_v)

    def likelihood(j):
        p = -np.log1p(-np.clip(u - v * j, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
        q = -np.log1p(-np.clip(v - u * j, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
        return larger * np.log(p) + smaller * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, 1))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(30):
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        left = likelihood(a) > likelihood(b)
        hi, lo = np.where(left, b, hi), np.where(left, lo, a)
    j = (lo + hi) / 2
    return j, np.sqrt(np.maximum(j * (1 - j), 0.05) / (larger + smaller + equal))


def _possible(j, error, n_a, n_b, percent: int) -> np.ndarray:
    return (j + ERRORS * error >= percent / 100) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs (rows of two register matrices) that the estimate doesn't rule out."""
    larger, equal = (a > b).sum(axis=1), (a == b).sum(axis=1)
    return _possible(*similarity(larger, a.shape[1] - larger - equal, equal, n_a, n_b), n_a, n_b, percent)


def _sketch(width: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in slices(batch.column(3)):
                sets = shingle_sets(data, offs, width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(3)]
                    + [pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([registers(s, m).tobytes() for s in sets], pa.binary())],
                    names=["k1", "k2", "id", "n", "registers"])
    return run


def bands(regs: np.ndarray, band: int) -> np.ndarray:
    """Bucket of each band of each row of a register matrix."""
    out = np.empty((len(regs), regs.shape[1] // band), dtype=U64)
    for b in range(out.shape[1]):
        h = np.full(len(regs), b + 1, dtype=U64)
        for i in range(b * band, (b + 1) * band):
            h = mix(h * U64(0x9FB21C651E98DF25) + regs[:, i].astype(U64) + U64(1))
        out[:, b] = h
    return out


def _matrix(col, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype=np.uint16).reshape(-1, m)


def _buckets(m: int, band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = bands(_matrix(batch.column(1).to_pylist(), m), band)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), got.shape[1]))],
                    names=["bucket", "node"])
    return run


def _verify(m: int, width: int, percent: int):
    """Related pairs, whether they are close, and whether their full sets link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = _matrix(batch.column(2).to_pylist(), m), _matrix(batch.column(5).to_pylist(), m)
            larger, equal = (a > b).sum(axis=1), (a == b).sum(axis=1)
            n_a, n_b = batch.column(3).to_numpy(), batch.column(6).to_numpy()
            j, error = similarity(larger, m - larger - equal, equal, n_a, n_b)
            likely = np.flatnonzero(_possible(j, error, n_a, n_b, percent))
            link, kept = np.zeros(len(j), dtype=bool), {}
            for i in likely.tolist():
                sets = []
                for node, col in ((batch.column(0)[i].as_py(), 4), (batch.column(1)[i].as_py(), 7)):
                    if node not in kept:
                        if len(kept) > 200:
                            kept.clear()
                        kept[node] = _own_set(batch.column(col)[i].as_py(), width)
                    sets.append(kept[node])
                common = len(np.intersect1d(*sets, assume_unique=True))
                link[i] = 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common)
            some = np.flatnonzero((j >= RELATED) | link)
            take = pa.array(some, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(link[some]), pa.array(j[some] >= CLOSE)],
                names=["a", "b", "link", "close"])
    return run


def _own_set(text: str, width: int) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    return shingle_sets(raw, np.array([0, len(raw)]), width)[0]


def _family_block(width: int, percent: int):
    """Links between one block of a family's members and one block of its
    members outside the largest component, by exact counts."""
    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(members) and len(queries):
            sets = [_own_set(t, width) for t in members["t"]]
            size = np.array([len(s) for s in sets])
            known, flat = np.unique(np.concatenate(sets), return_inverse=True)
            begin = np.cumsum(size) - size
            node, comp = members["node"].to_numpy(), members["comp"].to_numpy()
            for q, q_comp, t in zip(queries["q_node"].tolist(), queries["q_comp"].tolist(), queries["q_t"]):
                own = _own_set(t, width)
                at = np.searchsorted(known, own)
                at = at[at < len(known)]
                mark = np.zeros(len(known), dtype=bool)
                mark[at] = np.isin(known[at], own)
                common = np.add.reduceat(mark[flat].astype(np.int64), begin)
                link = np.flatnonzero((100 * common >= percent * (size + len(own) - common)) & (comp != q_comp))
                _, one = np.unique(comp[link], return_index=True)  # one link joins a component
                found += [(q, other) for other in node[link[one]].tolist()]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return run


def _block(m: int, band: int, percent: int):
    """Likely pairs of one block of a mixed bucket's members and one block of
    its members outside the largest component."""
    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(members) and len(queries):
            x = _matrix(members["registers"], m)
            own = bands(x, band)
            node, comp, n = (members[c].to_numpy() for c in ("node", "comp", "n"))
            minor = members["minor"].to_numpy()
            asked = _matrix(queries["q_registers"], m)
            theirs = bands(asked, band)
            place = (own[0] == np.uint64(int(queries["q_bucket"].iloc[0]) & (1 << 64) - 1)).argmax()  # this bucket's band
            for i, q in enumerate(queries.itertuples(index=False)):
                r = asked[i: i + 1]
                # a pair is looked at in the first bucket that it shares, and once if both are outside
                at = np.flatnonzero((comp != q.q_comp) & (~minor | (node > q.q_node)))
                at = at[~(own[at, :place] == theirs[i, :place]).any(axis=1)]
                if len(at):
                    ok = may_link(np.repeat(r, len(at), axis=0), x[at], np.full(len(at), q.q_n), n[at], percent)
                    found += [(q.q_node, other) for other in node[at[ok]].tolist()]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return run


def _links(pairs: DataFrame, nodes: DataFrame, m: int, width: int, percent: int) -> DataFrame:
    left = nodes.select(F.col("node").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na"), F.col("t").alias("ta"))
    right = nodes.select(F.col("node").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb"), F.col("t").alias("tb"))
    # leaders first: many pairs share one, and the last join deals the pairs out by their members
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "ra", "na", "ta", "rb", "nb", "tb")
    return written(joined.mapInArrow(_verify(m, width, percent), "a long, b long, link boolean, close boolean"), "near-pairs")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = SIMILARITY, m: int = REGISTERS, band: int = BAND) -> DataFrame:
    """(doc_id, k1, k2, n_shingles, component_id, kept), a row per document;
    (k1, k2) names the text."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("k1"), F.hash(text).alias("k2"),
                       F.col(text).alias("t"))
    sketched = rows.select("k1", "k2", "id", "t").mapInArrow(
        _sketch(shingle, m), "k1 long, k2 int, id long, n long, registers binary")
    nodes = written(
        sketched.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("registers").alias("registers"))
        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")  # unique, and fixed by writing

    buckets = nodes.where("n > 0").select("node", "registers").mapInArrow(_buckets(m, band), "bucket long, node long")
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = written(buckets.join(shared, "bucket"), "near-buckets")
    known = members.groupBy("node").agg(F.sum(F.col("size") - 1).alias("shares"))
    leaders = members.join(known, "node").groupBy("bucket").agg(F.max_by("node", F.struct("shares", "node")).alias("leader"))
    members = written(members.join(leaders, "bucket"), "near-members")

    # texts and sketches of the nodes that share a bucket with any other
    mates = nodes.join(members.select("node").distinct(), "node").select("k1", "k2", "id", "n", "registers", "node")
    texts = (rows.join(mates.withColumnRenamed("id", "first"), ["k1", "k2"]).where(F.col("id").eqNullSafe(F.col("first")))
             .groupBy("node").agg(F.any_value("t").alias("t"), F.any_value("n").alias("n"),
                                  F.any_value("registers").alias("registers")))
    texts = written(texts, "near-texts")

    stars = members.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    pairs = _links(stars, texts, m, shingle, percent)
    links = pairs.where("link").select("a", "b")
    label = components(links)

    more = _in_families(pairs, texts, label, shingle, percent)
    if not more.isEmpty():
        links = links.union(more)
        label = components(links)
    rest = _apart(members, pairs, texts, label, m, band, percent)
    if rest is not None:
        more = _links(rest, texts, m, shingle, percent).where("link").select("a", "b")
        if not more.isEmpty():
            label = components(links.union(more))

    named = nodes.join(label, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("id").alias("component"))
    named = named.join(least, "root").select("k1", "k2", F.col("n").alias("n_shingles"), "component")
    out = rows.select("id", "k1", "k2").join(named, ["k1", "k2"])
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(doc_id), "k1", "k2", "n_shingles", component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _spread(n):
    return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))


def _dealt(n):
    return F.pmod(F.xxhash64("node"), n)


def _in_families(pairs: DataFrame, texts: DataFrame, label: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components of one family that its leaders did not show."""
    family = components(pairs).withColumnRenamed("root", "family")
    placed = (texts.select("node").join(family, "node", "left").join(label, "node", "left")
              .select("node", F.coalesce("family", "node").alias("family"), F.coalesce("root", "node").alias("comp")))
    parts = placed.groupBy("family", "comp").agg(F.count("*").alias("k"))
    mixed = parts.groupBy("family").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.sum("k").alias("size"),
                                        (F.sum("k") - F.max("k")).alias("outside")).where("outside > 0")
    rows = placed.join(mixed, "family").join(texts.select("node", "t"), "node")
    blocks, q_blocks = F.ceil(F.col("size") / BLOCK), F.ceil(F.col("outside") / (4 * BLOCK))
    every = (rows.withColumn("x", _dealt(blocks)).withColumn("q", _spread(q_blocks)).select("family", "x", "q", "node", "comp", "t"))
    queries = (rows.where("comp != major").withColumn("q", _dealt(q_blocks)).withColumn("x", _spread(blocks))
               .select("family", "x", "q", "node", "comp", "t"))
    queries = queries.toDF(*[f"q_{c}" for c in queries.columns])  # both sides come from the same table
    found = every.groupBy("family", "x", "q").cogroup(queries.groupBy("q_family", "q_x", "q_q")).applyInPandas(
        _family_block(width, percent), "a long, b long")
    return written(found, "near-links")


def _apart(members: DataFrame, pairs: DataFrame, texts: DataFrame, label: DataFrame, m: int, band: int, percent: int
           ) -> DataFrame | None:
    """Likely pairs of different components among the members of a bucket that
    are not close to its leader."""
    close = pairs.where("close").select(F.col("a").alias("node"), F.col("b").alias("leader"))
    away = members.where("node != leader").select("bucket", "node", "leader").join(close, ["node", "leader"], "left_anti")
    placed = away.join(label, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("comp"))
    parts = placed.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    mixed = parts.groupBy("bucket").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.sum("k").alias("size"),
                                        (F.sum("k") - F.max("k")).alias("outside")).where("outside > 0")
    open_rows = written(placed.join(mixed, "bucket").withColumn("minor", F.col("comp") != F.col("major")), "near-open")
    if open_rows.isEmpty():
        return None
    sketches = texts.select("node", "n", "registers")
    blocks, q_blocks = F.ceil(F.col("size") / BLOCK), F.ceil(F.col("outside") / (8 * BLOCK))
    every = (open_rows.withColumn("x", _dealt(blocks)).withColumn("q", _spread(q_blocks))
             .join(sketches, "node").select("bucket", "x", "q", "node", "comp", "minor", "n", "registers"))
    queries = (open_rows.where("minor").withColumn("q", _dealt(q_blocks)).withColumn("x", _spread(blocks))
               .join(sketches, "node").select("bucket", "x", "q", "node", "comp", "n", "registers"))
    queries = queries.toDF(*[f"q_{c}" for c in queries.columns])
    found = every.groupBy("bucket", "x", "q").cogroup(queries.groupBy("q_bucket", "q_x", "q_q")).applyInPandas(
        _block(m, band, percent), "a long, b long")
    return written(found.distinct(), "near-rest")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **parameters) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the smallest id
    (of rows of equal id and text, any one); rows without shingles all stay."""
    found = near_duplicates(docs, doc_id, text, **parameters)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumns({
        "k1": F.xxhash64(names[docs.columns.index(text)]), "k2": F.hash(names[docs.columns.index(text)]),
        "id": F.col(names[docs.columns.index(doc_id)]).cast("long")})
    verdict = (found.where("kept").select(F.col("k1").alias("v1"), F.col("k2").alias("v2"), F.col(doc_id).alias("vid"), "n_shingles")
               .distinct())
    kept = plain.join(verdict, (F.col("k1") == F.col("v1")) & (F.col("k2") == F.col("v2")) & F.col("id").eqNullSafe(F.col("vid")))
    bare = kept.where("n_shingles = 0").select(*names)
    full = kept.where("n_shingles > 0").dropDuplicates(["k1", "k2", "id"]).select(*names)
    return bare.unionByName(full).toDF(*docs.columns)
