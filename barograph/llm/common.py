"""What the text operators share: words, hashes, columns, links to components."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

U64 = np.uint64
#: Distinct words whose hash a task remembers before it starts over.
REMEMBERED = 300_000


def remainder(doc_id: Column | str, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % F.lit(k)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with underscores until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_bytes(column: str = "text") -> Column:
    """UTF-8 of a text column, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def folded(data: bytes) -> list[bytes]:
    """Words between ASCII white space (space, 0x09 to 0x0D), A-Z in lower case."""
    return data.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (splitmix64)."""
    x = x.astype(U64, copy=True)
    x += U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class WordHashes(dict):
    """64-bit hash by word; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


#: Bytes of text that are split into words together.
CHUNK = 1 << 22


def chunks(data: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, pa.Array]]:
    """(place of its first value, texts) of parts of a binary column with about ``size`` bytes, or one long text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(data):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, data.slice(at, to - at).view(pa.string())
        at = to


#: Words with more bytes are hashed one by one.
LONG_WORD = 256
#: What a word's hash starts with, by its length, and the bits of its last bytes, by their number.
LENGTHS = mix(np.arange(LONG_WORD + 1))
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the words of all texts, words per text): the words of ``folded``, split by Arrow.

    A word's hash takes in its length and then eight bytes at a time, for all words together.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    start, left = ends[:-1], np.diff(ends)
    if not left.all():
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[left == 0], minlength=len(sizes))
        start, left = start[left > 0], left[left > 0]
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    long = np.flatnonzero(left > LONG_WORD)
    whole = [xxhash.xxh3_64_intdigest(data[start[i] : start[i] + left[i]]) for i in long]
    left = np.where(left > LONG_WORD, 0, left)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = mix(LENGTHS[left] ^ (eight[start] & MASKS[np.minimum(left, 8)]))
    now = np.flatnonzero(left > 8)
    start, left = start[now] + 8, left[now] - 8
    while len(now):
        out[now] = mix(out[now] ^ (eight[start] & MASKS[np.minimum(left, 8)]))
        more = left > 8
        now, start, left = now[more], start[more] + 8, left[more] - 8
    out[long] = np.array(whole, U64)
    return out, sizes


def few(table: DataFrame) -> int:
    """Tasks, and so files, for tables that are small beside ``table``, a plain scan: one for four splits of it, but two
    for each core. Shuffle partitions follow the largest shuffle; a file for each of them costs more than its rows do."""
    return max(2 * table.sparkSession.sparkContext.defaultParallelism, table.rdd.getNumPartitions() // 4)


class Scratch:
    """Work tables in the shared folder that are deleted together, once nothing reads them any more.

    tasks: set, a table is written by so many at most, which take shuffle partitions one after the other.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tasks = spark, [], None

    def gathered(self, df: DataFrame) -> DataFrame:
        return df.coalesce(self.tasks) if self.tasks else df

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written and read again, as ``materialize`` does."""
        path = work_path(self.spark, label)
        self.gathered(df).write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        self.paths = []
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files of finished plans: it does so, a little later, when the driver has
    collected their handles. It takes two collections: after the first, what the last plan left still holds them."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.15)


#: Bits of a block of a filter of ids (4 KB), the most blocks it takes, and bits for each id while it has fewer.
BLOCK_BITS = 1 << 15
MOST_BLOCKS = 1 << 12
BITS_PER_ID = 32


class IdFilter:
    """A filter of the ids in ``ids``, a table with few columns, by two bits each: 16 MB at most, whatever the input's size.

    An id outside may pass, none within fails; a null is an id. Rows are told apart where they are read, so that
    texts travel for those only that may be meant.
    """

    def __init__(self, ids: DataFrame, column: str):
        self.blocks = 1
        count = ids.count()
        while self.blocks < MOST_BLOCKS and self.blocks * BLOCK_BITS < BITS_PER_ID * count:
            self.blocks *= 2
        block, bits = self._spot(F.col(column).cast("long"))
        spots = ids.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
        self.table = spots.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def _spot(self, key: Column) -> tuple[Column, list[Column]]:
        """The block of an id and its bits there."""
        found = F.xxhash64(key)
        bits = [F.shiftrightunsigned(found, n).bitwiseAND(F.lit(BLOCK_BITS - 1)) for n in (34, 49)]
        return found.bitwiseAND(F.lit(self.blocks - 1)), bits

    def _joined(self, rows: DataFrame, column: str, how: str) -> DataFrame:
        block, bits = fresh("_block", rows.columns), fresh("_bits", rows.columns)
        at, spots = self._spot(F.col(f"`{column}`").cast("long"))
        same = at == F.col(block)
        for spot in spots:
            byte = F.substring(bits, (F.shiftright(spot, 3) + 1).cast("int"), F.lit(1))
            same &= F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), spot.bitwiseAND(F.lit(7)).cast("int")) == 1
        return rows.join(F.broadcast(self.table.toDF(block, bits)), same, how)

    def within(self, rows: DataFrame, column: str) -> DataFrame:
        """All rows whose id in ``column`` is one of the ids, and a few others."""
        return self._joined(rows, column, "left_semi")

    def outside(self, rows: DataFrame, column: str) -> DataFrame:
        """The other rows."""
        return self._joined(rows, column, "left_anti")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node reachable over links (a, b), for every node with a link.

    Alternates large-star and small-star until the links stay the same. Each step is an
    aggregate and a join, written before the next one, so no task holds a component.
    """

    def largest(e: DataFrame) -> DataFrame:
        both = e.union(e.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")

    def smallest(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.union(least.select("a", F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = scratch.table(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while (state := mark(now)) != before:
        before = state
        now = scratch.table(smallest(largest(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
