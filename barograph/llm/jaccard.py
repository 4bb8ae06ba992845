"""N-gram Jaccard join: parity sketches, a pigeonhole join per size band, exact verification.

A document's set holds its distinct shingles of ``words`` words. Documents link when
``100 * intersection >= percent * union``; with sizes adding up to s, linked sets differ in at most
``k = (100 - percent) * s / (100 + percent)`` shingles.

Sketch: m 64-bit words; every shingle XORs its hash into the word another hash chooses. A shingle
of the symmetric difference changes one word at most, so the number of words in which two sketches
differ (their Hamming distance) is never above the symmetric difference, and sketches of linked sets
with m > k agree in m - k words or more (pigeonhole). Documents that share a word of the sketch are
candidates. Words that no shingle reached are equal in unrelated documents; m is chosen so that
m - k - 1 of them may occur, and such a document need not emit them: of m - k equal words one has
shingles. A document with more of them emits them too.

Size bands: linked sizes lie in the same or in neighbouring bands, so each document has a sketch
for the pair of bands below and one for the pair above.

A pair goes on to verification only if the Hamming distance of their parity sketches of 512 bits, one bit for each
shingle's hash, leaves room for a link; in the join of a bucket this is part of the join condition, so documents of one
template that are similar but below the limit make no pairs.

Hot groups: equal sets share one set id before the join. In a bucket only two leaders, those met in
most buckets, are compared with all others; what is then still in different components is compared
pair by pair. So a group of near copies costs a star, and no link between components is lost.

Shingles and sets are known by 64-bit hashes: among 10^10 different sets about three pairs would
be taken for equal. Everything else is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, IdFilter, Scratch, as_bytes, chunks, components, few, fresh, mix, release, word_hashes


#: Bytes of text that a task takes, and hands on as sets or keys, at a time.
PART = 1 << 20


@dataclass(frozen=True)
class Near:
    """Shingles of ``words`` words, similarity of ``percent`` or more.

    passes: the bucket join runs over one part of the keys after the other, to hold less on disk.
    """

    words: int = 5
    percent: int = 80
    passes: int = 4


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``words`` words; a shorter text is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, words)
    out = mix(hashes[: n - width + 1] + U64(width))
    for j in range(1, width):
        out = mix(out ^ hashes[j : n - width + 1 + j])
    return np.unique(out)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The shingles of every text."""
    found, sizes = word_hashes(texts)
    for part in np.split(found, np.cumsum(sizes)[:-1]):
        yield shingles(part, words)


def set_id(sets: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(sets.tobytes()) - (1 << 63)


class Bands:
    """Bounds of the size bands, and the sketch width of each pair of neighbouring bands."""

    def __init__(self, near: Near):
        self.p = near.percent
        self.bounds = [1]
        self.words: dict[int, tuple[int, int]] = {}

    def of(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(self.bounds[-1] * 100 // self.p + 1)
        return int(np.searchsorted(self.bounds, size, side="right")) - 1

    def width(self, pair: int) -> tuple[int, int]:
        """(k, m) for sets whose sizes lie in the bands ``pair`` and ``pair`` + 1."""
        if pair not in self.words:
            while len(self.bounds) < pair + 3:
                self.bounds.append(self.bounds[-1] * 100 // self.p + 1)
            low, most = self.bounds[pair], self.bounds[pair + 2] - 1
            k = (100 - self.p) * 2 * most // (100 + self.p)
            m = k + 1
            while m < 2 * k + 8 and m * (1 - math.exp(-low / m)) < k + 1 + math.sqrt(m) / 2:
                m += 1 + m // 200
            self.words[pair] = k, m
        return self.words[pair]

    def keys(self, sets: np.ndarray) -> np.ndarray:
        """Bucket keys of a set, as int64; none where linked sets must be equal (k = 0)."""
        band, out = self.of(len(sets)), []
        place = mix(sets)
        for pair in (band - 1, band):
            if pair < 0:
                continue
            k, m = self.width(pair)
            if k == 0:
                continue
            word = (place % U64(m)).astype(np.int64)
            order = np.argsort(word, kind="stable")
            starts = np.flatnonzero(np.diff(word[order], prepend=-1))
            sketch = np.zeros(m, U64)
            sketch[word[order][starts]] = np.bitwise_xor.reduceat(sets[order], starts)
            at = np.arange(m, dtype=U64)
            if np.count_nonzero(sketch) >= k + 1:
                at = at[sketch != 0]
            out.append(mix(sketch[at] ^ mix(at + (U64(pair) << U64(40)))))
        return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


#: Bits of the parity sketch, as powers of two.
PARITY_BITS = 9


def parity(sets: np.ndarray) -> np.ndarray:
    """The parity of the shingles that fall on each bit, as 64-bit words."""
    counts = np.bincount((sets >> U64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def may_link(near: Near, x: str, y: str) -> Column:
    """Whether sets with sizes ``n`` and sketches ``parity`` may be linked, by size and by Hamming distance."""
    xn, yn = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = reduce(add, [
        F.bit_count(F.col(f"{x}.parity")[i].bitwiseXOR(F.col(f"{y}.parity")[i])) for i in range((1 << PARITY_BITS) // 64)
    ])
    return (100 * F.least(xn, yn) >= near.percent * F.greatest(xn, yn)) & (
        differ * (100 + near.percent) <= (100 - near.percent) * (xn + yn)
    )


SIGNED = "doc_id long, n_shingles long, sid long, keys array<long>, parity array<long>"


def _sign(near: Near):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(near), set()
        for batch in batches:
            for at, texts in chunks(batch.column(1), PART):
                sizes, ids, lists, bits = [], [], [], []
                for sets in shingle_sets(texts, near.words):
                    sizes.append(len(sets))
                    sid = set_id(sets) if len(sets) else None
                    ids.append(sid)
                    first = sid is not None and sid not in seen
                    seen.add(sid)
                    lists.append(bands.keys(sets) if first else np.empty(0, np.int64))
                    bits.append(parity(sets) if first else None)
                ends = np.cumsum([0] + [len(x) for x in lists])
                keys = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)).cast(pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(ids, pa.int64()), keys, pa.array(bits, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "sid", "keys", "parity"],
                )

    return sign


def _sets(near: Near):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0), PART):
                out = [x for x in shingle_sets(texts, near.words) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(x) for x in out], pa.int64()), pa.array([x.tobytes() for x in out], pa.binary())],
                    names=["sid", "shingles"],
                )

    return sets


def _linked(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both = np.concatenate((x, y))
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], names=["a", "b", "linked"]
            )

    return linked


#: The sets of pairs compared together hold a third of all shingles, or so many; and the most parts that the pairs fall into.
SHARE, LEAST, MOST_PARTS = 3, 1 << 24, 16


def _verified(pairs: DataFrame, docs: DataFrame, signed: DataFrame, near: Near, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of set ids that may be linked, with their exact answer.

    The sets are built again for these only, and one part of the pairs is compared after the other, to hold less on disk.
    """
    sketch = F.struct(F.col("n_shingles").alias("n"), "parity").alias("s")
    of = signed.where("parity is not null").select("sid", sketch).dropDuplicates(["sid"])
    pairs = pairs.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").where(may_link(near, "x", "y"))
    pairs = scratch.table(pairs.select("a", "b", (F.col("x.n") + F.col("y.n")).alias("n")), "jaccard-pairs")
    some, whole = (x.agg(F.sum(c)).first()[0] or 0 for x, c in ((pairs, "n"), (signed, "n_shingles")))
    parts = min(MOST_PARTS, max(1, math.ceil(some / max(LEAST, whole / SHARE))))
    links = [
        _compared(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part).select("a", "b"), docs, signed, near, scratch)
        for part in range(parts)
    ]
    return reduce(DataFrame.union, links)


def _compared(pairs: DataFrame, docs: DataFrame, signed: DataFrame, near: Near, scratch: Scratch) -> DataFrame:
    """The pairs with their exact answer. Texts are found by a filter of ids, so none travels."""
    work = Scratch(scratch.spark)
    work.tasks = scratch.tasks
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    where = signed.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    ids = IdFilter(work.table(where.select("doc_id").distinct(), "jaccard-ids"), "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    texts = ids.within(texts, "doc_id").select("text")
    sets = texts.mapInArrow(_sets(near), "sid long, shingles binary").join(wanted, "sid", "left_semi")
    sets = work.table(sets.dropDuplicates(["sid"]), "jaccard-sets")
    release(scratch.spark)
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    out = scratch.table(both.mapInArrow(_linked(near.percent), "a long, b long, linked boolean"), "jaccard-links")
    work.drop()
    return out


def near_documents(docs: DataFrame, near: Near = Near(), scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the smallest id reachable over links.

    Null and empty texts have no shingles, link with nothing and are their own component. Equal
    texts are one set, so repeated rows cost no pairs. A null id takes part, but never names a component
    unless all ids of it are null. Columns other than doc_id and text are ignored. The tables that the
    result reads go to ``scratch``, for a caller that wants to delete them; the others are deleted here.
    """
    last, work = scratch or Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    keyed = Scratch(docs.sparkSession)
    signed = keyed.table(rows.mapInArrow(_sign(near), SIGNED), "jaccard-signed")
    work.tasks = last.tasks = few(signed)
    keys = signed.select(F.explode("keys").alias("key"), "sid")
    bucket = Window.partitionBy("key")
    met = None
    for part in range(near.passes):
        some = keys.where(F.pmod("key", F.lit(near.passes)) == part).select(
            "key", "sid", F.min("sid").over(bucket).alias("low"), F.max("sid").over(bucket).alias("high")
        )
        some = work.table(some.where("low < high").select("key", "sid").distinct(), "jaccard-buckets")
        met = some if met is None else met.union(some)
        release(docs.sparkSession)
    signed = work.table(signed.drop("keys"), "jaccard-sketches")
    keyed.drop()

    weight = met.join(met.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("sid").agg(F.sum("n").alias("w"))
    ranked = met.join(weight, "sid").select(
        "key", "sid", F.row_number().over(bucket.orderBy(F.desc("w"), "sid")).alias("place")
    )
    ranked = work.table(ranked, "jaccard-ranked")
    leaders = ranked.where("place <= 2").select("key", F.col("sid").alias("b"), F.col("place").alias("first"))
    pairs = ranked.join(leaders, "key").where("place > first").select(
        F.least("sid", "b").alias("a"), F.greatest("sid", "b").alias("b")
    )
    pairs = work.table(pairs.distinct(), "jaccard-stars")
    checked = _verified(pairs, docs, signed, near, work)
    root = components(checked.where("linked"), work)

    # Pairs of non-leaders that are still in different components.
    node = root.select(F.col("node").alias("sid"), "root")
    open_ = ranked.where("place > 2").join(node, "sid", "left").select(
        "key", "sid", F.coalesce("root", "sid").alias("root")
    )
    apart = open_.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    sketches = signed.where("parity is not null").select("sid", F.col("n_shingles").alias("n"), "parity").dropDuplicates(["sid"])
    open_ = open_.join(apart, "key", "left_semi").join(sketches, "sid")
    open_ = open_.select("key", F.struct("sid", "root", "n", "parity").alias("x"))
    apart = (F.col("x.sid") < F.col("y.sid")) & (F.col("x.root") != F.col("y.root")) & may_link(near, "x", "y")
    rest = open_.alias("l").join(open_.withColumnRenamed("x", "y").alias("r"), (F.col("l.key") == F.col("r.key")) & apart)
    rest = rest.select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")).distinct()
    rest = work.table(rest.join(checked, ["a", "b"], "left_anti"), "jaccard-rest")
    if not rest.isEmpty():
        more = _verified(rest, docs, signed, near, work)
        root = components(checked.union(more).where("linked"), work)

    least = signed.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    named = least.join(root.select(F.col("node").alias("sid"), "root"), "sid", "left")
    named = named.select("sid", "least", F.coalesce("root", "sid").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = last.table(named.join(lowest, "root").select("sid", "component_id"), "jaccard-classes")
    slim = last.table(signed.select("doc_id", "n_shingles", "sid"), "jaccard-documents")
    work.drop()
    out = slim.join(classes, "sid", "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def one_of_each(docs: DataFrame, near: Near = Near(), scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with its smallest id stays.

    Rows that repeat an id and its text count as copies; of rows with one id and different texts in one
    component all stay. Texts without words are no copies of each other.
    """
    last = scratch or Scratch(docs.sparkSession)
    stays = F.coalesce(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")), F.lit(False))
    found = near_documents(docs, near, last).groupBy("doc_id").agg(F.count("*").alias("n"), F.max(stays).alias("stays"))
    id_, mark = fresh("_id", docs.columns), fresh("_stays", docs.columns)
    unsure = last.table(found.where("n > 1 or not stays").select("doc_id", "stays"), "jaccard-unsure")
    # Most ids stand in one row that stays: those rows go on as they are read.
    ids = IdFilter(unsure, "doc_id")
    rest = ids.within(docs, "doc_id").join(unsure.toDF(id_, mark), F.col("doc_id").eqNullSafe(F.col(id_)), "left")
    rest = rest.where(F.coalesce(F.col(mark), F.lit(True))).select(*[F.col(f"`{c}`") for c in docs.columns])
    return ids.outside(docs, "doc_id").union(rest.dropDuplicates(["doc_id", "text"]))
