"""Line dedup: an exact set-similarity join over lines; later matches of a line are removed.

A line's set holds its distinct lower-cased words. Tokens are ordered by rarity in all lines, and
each line is indexed under its prefix: two sets of n1 and n2 tokens that overlap in
``a = ceil(p (n1 + n2) / (100 + p))`` tokens share one of their ``n - ceil(p n / 100) + 1`` rarest.
Candidates must pass the length filter (p n1 <= 100 n2), the positional filter (enough tokens left
behind the shared one) and a bound from 128-bit parity sketches; Jaccard is then verified on whole sets, which are
built again for the lines of these pairs only.

Rarity is read from a table of 2^24 counts of hashed words, over all lines, each a byte that holds a logarithm (eight
steps per doubling, so that frequent words keep their order at any size of the input). Any order
gives the same result, the counts only make buckets small; a word whose bucket counts one
line cannot match another line and is not emitted. Neither is a line so short that only an equal set is similar: equal
sets are one already.

The entries of a word travel once, sorted by word, and are compared where they arrive. Hot words: of very many
lines under a word only the earliest are compared with all others there, and of very many candidates of
a line only the earliest leave the task; both already remove copies in large groups. Such words are
named, and under them what remains as an open line is then joined with all lines. Lines and
words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Scratch, as_bytes, chunks, few, fresh, mix, release, word_hashes

BUCKET_BITS = 24
BLOCK = 1 << 16
#: Entries that a task compares together, lines under a word beyond which it is hot, and the lines and candidates kept then.
ROOM, CROWD, FEW = 1 << 16, 2048, 32
#: Bits of the filter of lines to be read again, as a power of two.
FILTER_BITS = 27
#: Bytes of text that a task takes at a time, blocks of a table that leave it together, and pairs that it gathers before
#: it keeps the earliest.
PART, SENT, GATHERED = 1 << 20, 16, 1 << 20


@dataclass(frozen=True)
class LineCopies:
    """Lines of ``min_words`` distinct words or more; similarity of ``percent`` or more.

    Shorter lines stay; with ``min_words=1``, as the queries have it, every line with a word is compared.
    passes: words are compared one part after the other, to hold less on disk.
    """

    min_words: int = 5
    percent: int = 80
    passes: int = 4


@dataclass(frozen=True)
class LineSets:
    """Lines with enough words: text and place of each, size and start of its set in ``sets`` (sorted per line: rarest
    first, if counts are given, then by hash)."""

    text: np.ndarray
    place: np.ndarray
    size: np.ndarray
    start: np.ndarray
    sets: np.ndarray


def _line_words(texts: pa.Array, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line of each word, its hash, lines per text) over the lines with ``least`` words or more."""
    lists = pc.split_pattern(texts, "\n")
    words, sizes = word_hashes(lists.flatten())
    line = np.repeat(np.arange(len(sizes)), sizes)
    enough = np.repeat(sizes >= least, sizes)
    return line[enough], words[enough], pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def _distinct(line: np.ndarray, words: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of each line, by line, count and hash."""
    if not len(line):
        return line, words
    ranks = np.zeros(len(words), np.uint8) if counts is None else counts[bucket_of(words)]
    room = 56 - int(line[-1]).bit_length()
    key = (line.astype(U64) << U64(8 + room)) | (ranks.astype(U64) << U64(room)) | (words >> U64(64 - room))
    order = np.argsort(key)
    key, found = key[order], words[order]
    if np.any((key[1:] == key[:-1]) & (found[1:] != found[:-1])):  # the bits do not tell two words apart
        order = np.lexsort((words, ranks, line))
        found = words[order]
    line = line[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (found[1:] != found[:-1])
    return line[new], found[new]


def line_sets(texts: pa.Array, least: int, counts: np.ndarray | None = None) -> LineSets:
    """The sets of distinct word hashes of the lines with ``least`` distinct words or more."""
    line, words, lines = _line_words(texts, least)
    line, words = _distinct(line, words, counts)
    total = int(lines.sum())
    size = np.bincount(line, minlength=total)
    words, size = words[(size >= least)[line]], np.where(size >= least, size, 0)
    which = np.flatnonzero(size)
    size = size[which]
    first = np.cumsum(lines) - lines
    text = np.searchsorted(first, which, side="right") - 1
    return LineSets(text, which - first[text], size, np.cumsum(size) - size, words)


def bucket_of(sets: np.ndarray) -> np.ndarray:
    return (sets >> U64(64 - BUCKET_BITS)).astype(np.int64)


#: Steps of a logarithmic count per doubling.
STEPS = 8
#: The count that each byte stands for; none, one and two are exact.
MEANT = np.concatenate(([0], 2 ** (np.arange(255) / STEPS)))


def logarithmic(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: 0 for none, then eight steps per doubling."""
    steps = np.rint(STEPS * np.log2(np.maximum(counts, 1))) + 1
    return np.where(counts > 0, np.minimum(steps, 255), 0).astype(np.uint8)


#: The bytes of small counts.
SMALL = logarithmic(np.arange(1 << 16))


def _blocks(
    table: np.ndarray, name: str, sent: Callable[[int, np.ndarray], np.ndarray], also: Iterable[int] = ()
) -> Iterator[pa.RecordBatch]:
    """(block, its bytes as ``sent``) of the blocks of a table with any, and of ``also``, few at a time."""
    blocks = table.reshape(-1, BLOCK)
    full = sorted({i for i, x in enumerate(blocks) if x.any()}.union(also))
    for at in range(0, len(full), SENT):
        some = full[at : at + SENT]
        data = pa.array([sent(i, blocks[i]).tobytes() for i in some], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), data], names=["block", name])


def _as_bytes(counts: np.ndarray) -> np.ndarray:
    return SMALL[counts] if counts.max() < len(SMALL) else logarithmic(counts)


def _count(least: int):
    """Counts in 16 bits; what goes beyond them, of few words, is kept apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, beyond = np.zeros(1 << BUCKET_BITS, np.uint16), defaultdict(Counter)
        for batch in batches:
            for _, texts in chunks(batch.column(0), PART):
                _, words, _ = _line_words(texts, least)
                buckets = np.sort(bucket_of(words).astype(np.uint32))
                at = np.flatnonzero(np.diff(buckets, prepend=np.uint32(0xFFFFFFFF)))
                which = buckets[at]
                # A word counts again in its line: only the order feels it.
                now = counts[which] + np.diff(at, append=len(buckets)).astype(np.uint32)
                counts[which] = now & np.uint32(0xFFFF)
                for i in np.flatnonzero(now >> np.uint32(16)):
                    beyond[int(which[i]) // BLOCK][int(which[i]) % BLOCK] += int(now[i]) & ~0xFFFF

        def sent(i: int, block: np.ndarray) -> np.ndarray:
            if i in beyond:
                block = block.astype(np.int64)
                block[list(beyond[i])] += list(beyond[i].values())
            return _as_bytes(block)

        yield from _blocks(counts, "counts", sent, beyond)

    return count


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks that came to this task, which holds one sum per block."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total = sums.setdefault(block, np.zeros(BLOCK))
            total += MEANT[np.frombuffer(counts.as_buffer(), np.uint8)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([logarithmic(x).tobytes() for x in sums.values()], pa.binary())],
        names=["block", "counts"],
    )


def rarity(texts: DataFrame, least: int) -> np.ndarray:
    """Lines per hashed word, as logarithms: 2^24 bytes, whatever the input's size."""
    schema = "block long, counts binary"
    merged = texts.mapInArrow(_count(least), schema).repartition("block").mapInArrow(_add, schema)
    counts = np.zeros(1 << BUCKET_BITS, np.uint8)
    for row in merged.toLocalIterator():
        counts[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.uint8)
    return counts


LINES = "rid long, doc_id long, place int, sid long, n int, p1 long, p2 long"


def _index(shared, copies: LineCopies):
    """One row per line. Only the first copy in a task has a sketch and entries (word and its place in the order, in 32
    bits each), in a list for each pass."""
    p = copies.percent

    def rows(found: LineSets, seen: set[int], counts: np.ndarray) -> list[pa.Array]:
        size, start, sets = found.size, found.start, found.sets
        spread = mix(sets)
        sid = mix(np.add.reduceat(mix(spread), start) + size.astype(U64)).view(np.int64)
        bit, high = U64(1) << (spread & U64(63)), spread & U64(64) > 0
        sketch = [np.bitwise_xor.reduceat(np.where(high, bit, U64(0)), start).view(np.int64)]
        sketch.append(sketch[0] ^ np.bitwise_xor.reduceat(bit, start).view(np.int64))
        first = np.empty(len(sid), bool)
        for i, one in enumerate(sid.tolist()):
            first[i] = one not in seen
            seen.add(one)
        prefix = np.where(first & (100 * size >= p * (size + 1)), size + (-p * size) // 100 + 1, 0)
        line = np.repeat(np.arange(len(size)), prefix)
        spot = np.arange(len(line)) - (np.cumsum(prefix) - prefix)[line]
        word = sets[start[line] + spot]
        some = counts[bucket_of(word)] > 1
        word, spot, line = (word[some] >> U64(8)) & U64(0xFFFFFFFF), spot[some], line[some]
        entries, part, lists = (word << U64(32) | spot.astype(U64)).view(np.int64), word % U64(copies.passes), []
        for i in range(copies.passes):
            mine = part == U64(i)
            ends = np.concatenate(([0], np.cumsum(np.bincount(line[mine], minlength=len(size)))))
            lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(entries[mine])))
        return [
            pa.array(found.place, pa.int32()), pa.array(sid), pa.array(size, pa.int32()),
            *[pa.array(x, mask=~first) for x in sketch], *lists,
        ]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        names = ["rid", "doc_id", "place", "sid", "n", "p1", "p2", *[f"e{i}" for i in range(copies.passes)]]
        for batch in batches:
            for at, texts in chunks(batch.column(2), PART):
                found = line_sets(texts, copies.min_words, counts)
                if len(found.text):
                    source = pa.array(at + found.text)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(source), batch.column(1).take(source), *rows(found, seen, counts)], names=names
                    )

    return index


def _room(p: int, xn, yn, xleft, yleft, sketches):
    """The positional and sketch filter for sets of ``xn`` and ``yn`` words with so many left from the shared one on."""
    need = -(-p * (xn + yn) // (100 + p))
    differ = sum(np.bitwise_count(x ^ y).astype(np.int64) for x, y in sketches)
    return (np.minimum(xleft, yleft) >= need) & (differ <= xn + yn - 2 * need)


def _earliest(x: np.ndarray, y: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of each x with its ``FEW`` lowest ys, and the xs that had more."""
    order = np.lexsort((rank[y], x))
    x, y = x[order], y[order]
    first = np.flatnonzero(np.diff(x, prepend=-1))
    place = np.arange(len(x)) - np.repeat(first, np.diff(first, append=len(x)))
    return x[place < FEW], y[place < FEW], np.unique(x[place >= FEW])


def _compared(entries: list[np.ndarray], p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of lines, ids of lines that may be similar to them, hot words) among all entries of some words."""
    word, doc, sid, ni, p1, p2 = entries
    group = np.cumsum(np.diff(word, prepend=word[0]) != 0).astype(U64)
    order = np.argsort((group << U64(40)) | (sid.view(U64) >> U64(24)))
    new = np.ones(len(order), bool)  # one of each line under a word: copies come from other tasks
    new[1:] = (np.diff(word[order]) != 0) | (np.diff(sid[order]) != 0)
    order = order[new]
    order = order[np.argsort((group[order] << U64(40)) | (ni[order] >> 32).astype(U64))]
    word, doc, sid = word[order], doc[order], sid[order]
    p1, p2 = p1[order].view(U64), p2[order].view(U64)  # numpy counts the bits of absolute values
    n = ni[order] >> 32
    left = n - (ni[order] & 0xFFFFFFFF)
    rank = np.empty(len(order), np.int64)
    rank[np.argsort(doc)] = np.arange(len(order))
    starts = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
    many = np.diff(starts, append=len(word))
    end = np.repeat(starts + many, many)
    xs, ys, hot, held = [], [], [word[starts[many > CROWD]]], 0

    def meet(x: np.ndarray, y: np.ndarray) -> None:
        nonlocal held
        fits = _room(p, n[x], n[y], left[x], left[y], [(p1[x], p1[y]), (p2[x], p2[y])]) & (sid[x] != sid[y])
        x, y = x[fits], y[fits]
        late = rank[x] > rank[y]
        xs.append(np.where(late, x, y))
        ys.append(np.where(late, y, x))
        held += len(x)
        if held > GATHERED:
            fewer()

    def fewer() -> None:
        nonlocal held
        x, y, more = _earliest(np.concatenate(xs), np.concatenate(ys), rank)
        xs[:], ys[:], held = [x], [y], 0
        hot.append(word[more])

    x = np.flatnonzero(np.repeat(many <= CROWD, many))
    apart = 1
    while len(x):  # sizes grow along a word's lines: what is too long now stays so
        x = x[x + apart < end[x]]
        x = x[100 * n[x] >= p * n[x + apart]]
        meet(x, x + apart)
        apart += 1
    for at, size in zip(starts[many > CROWD], many[many > CROWD], strict=True):
        lines = np.arange(at, at + size)
        for one in lines[np.argsort(rank[lines])[:FEW]]:
            others = lines[(lines != one) & (100 * np.minimum(n[lines], n[one]) >= p * np.maximum(n[lines], n[one]))]
            meet(others, np.full(len(others), one))
    fewer()
    return sid[xs[0]], sid[ys[0]], np.unique(np.concatenate(hot))


def _meeting(percent: int):
    """(a, b) of lines that may be similar, and (word) of hot words; the entries of a word come one after the other."""

    def found(entries: list[np.ndarray]) -> pa.RecordBatch:
        x, y, hot = _compared(entries, percent)
        pairs = np.unique(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1), axis=0)
        none = pa.nulls(len(hot), pa.int64())
        columns = [pa.concat_arrays([pa.array(pairs[:, i]), none]) for i in (0, 1)]
        words = pa.concat_arrays([pa.nulls(len(pairs), pa.int32()), pa.array(hot, pa.int32())])
        return pa.RecordBatch.from_arrays([*columns, words], names=["a", "b", "word"])

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([x.to_numpy() for x in batch.columns])
            rows += batch.num_rows
            if rows < ROOM:
                continue
            entries = [np.concatenate(x) for x in zip(*held, strict=True)]
            other = np.flatnonzero(entries[0] != entries[0][-1])
            if len(other):
                cut = int(other[-1]) + 1
                yield found([x[:cut] for x in entries])
                held = [[x[cut:] for x in entries]]
            else:  # a single word, hot: its earliest lines stay for those to come
                yield found(entries)
                held = [[x[np.argsort(entries[1])[:FEW]] for x in entries]]
            rows = len(held[0][0])
        if rows:
            yield found([np.concatenate(x) for x in zip(*held, strict=True)])

    return meeting


def _spot(rid: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (mix(rid.view(U64) ^ mix(place.astype(U64))) >> U64(64 - FILTER_BITS)).astype(np.int64)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, bytes) of the filter over the lines that came to this task."""
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in batches:
        spot = _spot(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        np.bitwise_or.at(bits, spot >> 3, (128 >> (spot & 7)).astype(np.uint8))
    yield from _blocks(bits, "bits", lambda _, block: block)


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, bits in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total = sums.setdefault(block, np.zeros(BLOCK, np.uint8))
            total |= np.frombuffer(bits.as_buffer(), np.uint8)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
        names=["block", "bits"],
    )


def line_filter(lines: DataFrame) -> np.ndarray:
    """A filter of 2^27 bits over (rid, place), whatever the input's size; a line outside may pass, none within fails."""
    schema = "block long, bits binary"
    merged = lines.mapInArrow(_mark, schema).repartition("block").mapInArrow(_union, schema)
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in merged.toLocalIterator():
        bits[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _chosen(shared):
    """(rid, place, words) of the lines that pass the filter."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            rids = batch.column(0).to_numpy()
            for at, texts in chunks(batch.column(1), PART):
                lists = pc.split_pattern(texts, "\n")
                many = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                rid = np.repeat(rids[at : at + len(texts)], many)
                place = np.arange(len(rid)) - np.repeat(np.cumsum(many) - many, many)
                spot = _spot(rid, place)
                which = np.flatnonzero(bits[spot >> 3] & (128 >> (spot & 7)))
                words, sizes = word_hashes(lists.flatten().take(pa.array(which)))
                line, words = _distinct(np.repeat(np.arange(len(sizes)), sizes), words)
                ends = np.concatenate(([0], 8 * np.cumsum(np.bincount(line, minlength=len(which))))).astype(np.int32)
                sets = pa.Array.from_buffers(
                    pa.binary(), len(which), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(words.tobytes())]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[which]), pa.array(place[which], pa.int32()), sets], names=["rid", "place", "set"]
                )

    return chosen


def _similar(percent: int):
    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                both = np.concatenate([np.frombuffer(v.as_buffer(), U64) for v in (x, y)])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            picked = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("late").filter(picked)], names=["sid"])

    return similar


def _candidate(p: int, x: str, y: str):
    """The length, positional and sketch filter, for entries x and y of one word."""
    xn, yn = F.shiftright(f"{x}.ni", 32), F.shiftright(f"{y}.ni", 32)
    xi, yi = (F.col(f"{side}.ni").bitwiseAND(F.lit(0xFFFFFFFF)) for side in (x, y))
    need = F.ceil(F.lit(p) * (xn + yn) / F.lit(100 + p))
    differ = [F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in ("p1", "p2")]
    return (
        (F.col(f"{x}.sid") != F.col(f"{y}.sid"))
        & (100 * F.least(xn, yn) >= p * F.greatest(xn, yn))
        & (F.least(xn - xi, yn - yi) >= need)
        & (differ[0] + differ[1] <= xn + yn - 2 * need)
    )


def _identified(docs: DataFrame, last: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row that stays the same whenever it is read, and the name of that column.

    Rows that come straight from Parquet files are known by file and place in it, hashed to 64 bits; other rows are
    written down with their numbers.
    """
    rid = fresh("_row", docs.columns)
    try:
        return docs.withColumn(rid, F.xxhash64("_metadata.file_path", "_metadata.row_index")), rid
    except AnalysisException:  # not a plain scan of such files
        return last.table(docs.withColumn(rid, F.monotonically_increasing_id()), "lines-rows"), rid


def repeated_lines(docs: DataFrame, copies: LineCopies, last: Scratch) -> tuple[DataFrame, DataFrame, str]:
    """(rows of ``docs`` with an id, (id, places of lines to remove), name of the id column)."""
    spark, p = docs.sparkSession, copies.percent
    work = Scratch(spark)
    rows, rid = _identified(docs, last)
    texts = rows.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    counts = spark.sparkContext.broadcast(rarity(texts.select("text"), copies.min_words))
    schema = LINES + "".join(f", e{i} array<long>" for i in range(copies.passes))
    lines = work.table(texts.mapInArrow(_index(counts, copies), schema), "lines-index")
    counts.unpersist()
    work.tasks = last.tasks = few(lines)

    # Earlier means: smaller document id (null last), then row, then place.
    at = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid", "place")
    sets = work.table(lines.groupBy("sid").agg(F.min(at).alias("at")), "lines-sets")
    release(spark)

    def entries(part: int) -> DataFrame:
        some = lines.where("p1 is not null").select(
            F.explode(f"e{part}").alias("e"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "sid",
            F.shiftleft(F.col("n").cast("long"), 32).alias("n"), "p1", "p2",
        )
        return some.select(
            F.shiftright("e", 32).cast("int").alias("word"), "doc", "sid",
            F.col("n").bitwiseOR(F.col("e").bitwiseAND(F.lit(0xFFFFFFFF))).alias("ni"), "p1", "p2",
        )

    parts = []
    for part in range(copies.passes):
        some = entries(part).repartition("word").sortWithinPartitions("word")
        parts.append(work.table(work.gathered(some).mapInArrow(_meeting(p), "a long, b long, word int"), "lines-met"))
        release(spark)
    met = reduce(DataFrame.union, parts)
    first = work.table(met.where("word is null").select("a", "b").distinct(), "lines-pairs")
    done = work.table(_verified(first, rows, rid, sets, copies, work).distinct(), "lines-done")

    late = done
    hot = work.table(met.where("word is not null").select("word").distinct(), "lines-hot")
    if not hot.isEmpty():
        me = F.struct("sid", "ni", "p1", "p2")
        pairs = []
        for part in range(copies.passes):
            some = entries(part).join(hot, "word", "left_semi").dropDuplicates(["word", "sid"])
            some = work.table(some.drop("doc"), "lines-entries")
            open_ = some.join(done, "sid", "left_anti")
            some = open_.select("word", me.alias("x")).join(some.select("word", me.alias("y")), "word")
            some = some.where(_candidate(p, "x", "y")).select(
                F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")
            )
            pairs.append(work.table(some.distinct(), "lines-rest"))
            release(spark)
        rest = reduce(DataFrame.union, pairs).distinct().join(first, ["a", "b"], "left_anti")
        rest = work.table(rest, "lines-rest")
        if not rest.isEmpty():
            late = done.union(_verified(rest, rows, rid, sets, copies, work)).distinct()

    fate = sets.select("sid", "at").join(late.withColumn("late", F.lit(True)), "sid", "left")
    gone = lines.select("sid", "rid", "place").join(fate, "sid").where(
        F.col("late").isNotNull() | (F.col("rid") != F.col("at.rid")) | (F.col("place") != F.col("at.place"))
    )
    gone = last.table(gone.groupBy("rid").agg(F.collect_list("place").alias("places")), "lines-gone")
    work.drop()
    return rows, gone, rid


def _verified(
    pairs: DataFrame, rows: DataFrame, rid: str, sets: DataFrame, copies: LineCopies, work: Scratch
) -> DataFrame:
    """(sid) of the later line of each pair (a, b) whose sets are similar; only these lines are read again, and each carries
    its place to the pairs."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    asked = sets.join(wanted, "sid", "left_semi").select("sid", "at", F.col("at.rid").alias("rid"), F.col("at.place").alias("place"))
    asked = work.table(asked, "lines-asked")
    shared = work.spark.sparkContext.broadcast(line_filter(asked.select("rid", "place")))
    texts = rows.select(F.col(rid).alias("rid"), as_bytes().alias("text"))
    chosen = texts.mapInArrow(_chosen(shared), "rid long, place int, set binary").join(asked, ["rid", "place"])
    chosen = work.table(chosen.select("sid", "at", "set"), "lines-chosen")
    shared.unpersist()
    release(work.spark)
    both = pairs.join(chosen.toDF("a", "ata", "x"), "a").join(chosen.toDF("b", "atb", "y"), "b").select(
        F.when(F.col("ata") > F.col("atb"), F.col("a")).otherwise(F.col("b")).alias("late"), "x", "y"
    )
    return work.gathered(both).mapInArrow(_similar(copies.percent), "sid long")


def _without(text: int, places: int):
    """The batch, in parts, with the lines at ``places`` taken out of its text column, and their number in its last column."""

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column(text), PART):
                part = batch.slice(at, len(texts))
                off = part.column(places)
                gone = pc.fill_null(pc.list_value_length(off), 0)
                some = pc.and_(pc.greater(gone, 0), pc.is_valid(texts))
                left = []
                for data, lines in zip(texts.filter(some).to_pylist(), off.filter(some).to_pylist(), strict=True):
                    lines = set(lines)
                    left.append("\n".join(x for i, x in enumerate(data.split("\n")) if i not in lines))
                columns = list(part.columns)
                columns[text] = pc.replace_with_mask(texts, some, pa.array(left, pa.string()))
                columns[places] = gone
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return without


def drop_repeated_lines(
    docs: DataFrame, copies: LineCopies = LineCopies(), count: str | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """``docs`` without the lines that match an earlier line; documents that lose all their words go too.

    Lines are cut at \\n. Of equal or similar lines the one in the smallest document id stays (null ids
    come last, repeated ids in row order), then the first in its text; a line is also removed if the
    earlier match is itself removed. Lines with fewer than ``min_words`` distinct words stay. Null and
    empty texts, and texts without words, are returned as they are. Other columns are returned
    unchanged, also n_chars: the caller sets what depends on the text. ``count`` adds a column
    with the number of lines removed. The two tables that the result reads go to ``scratch``.
    """
    rows, gone, rid = repeated_lines(docs, copies, scratch or Scratch(docs.sparkSession))
    places = fresh("_places", rows.columns)
    # The few places are hashed, so that texts are not sorted.
    gone = gone.select(F.col("rid").alias(rid), F.col("places").alias(places)).hint("shuffle_hash")
    joined = rows.join(gone, rid, "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], places)
    fields = [f"`{f.name}` {'int' if f.name == places else f.dataType.simpleString()}" for f in joined.schema]
    out = joined.mapInArrow(_without(joined.columns.index("text"), joined.columns.index(places)), ", ".join(fields))
    some = F.col(places) == 0
    out = out.where(some | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumnRenamed(places, count) if count else out.drop(places)
