"""Cross-tokenizer alignment: galloping intersection of the byte ends of two tokenizations of a text.

Both tokenizers cover the same bytes, so the ends of their tokens are two increasing lists. Within a document the
shorter list drives: each of its ends is sought in the longer one from a finger at the proportional place, by steps of
doubling length until it is passed and by halving from there. An end found in both lists closes a group. The place
(rank) of an end in the longer list is the last token that a driving token overlaps, and the rank of the end before it
gives the first one, so differences of ranks are the overlap ranges. All documents of a piece of a batch are sought at once.

How many documents hold an id pair linked is counted over the corpus without moving links: a chunk of about
``chunk`` bytes of text keeps the distinct pairs of its documents, with the documents that hold them, and each document its places
in that list. Only the chunks' lists are summed and joined with the totals, and come back to their chunk.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, as_bytes
from .tokens import SYMBOLS, Tokens

#: Bytes of text that are aligned together.
PIECE = 1 << 21


@dataclass(frozen=True)
class Alignment:
    """Vocabulary files (None: the public ones of the query), and bytes of text that share a list of pairs."""

    byte_level: str | None = None
    pieces: str | None = None
    chunk: int = 1 << 25


class Entries:
    """The bytes of a vocabulary's entries, one behind the other."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(x) for x in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size


class ByteIds:
    """Ids of the byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str | None):
        self.tokens = Tokens(path)
        self.tokens.tokenizer.encode_special_tokens = True
        self.tokens.special = []
        byte = {symbol: value for value, symbol in SYMBOLS.items()}
        names = [self.tokens.tokenizer.id_to_token(i) or "" for i in range(self.tokens.tokenizer.get_vocab_size())]
        self.bytes = [bytes(byte[c] for c in e) if all(c in byte for c in e) else b"" for e in names]
        self.entries = Entries(self.bytes)

    def words(self, words: list[str]) -> list[bytes | None]:
        """Ids of a space and each word; None where they depend on the words around it."""
        return [self.tokens.behind_space(w) for w in words]

    def whole(self, text: str) -> np.ndarray:
        return np.frombuffer(self.tokens.of(" " + text), "<u4")


class PieceIds:
    """Ids of the piece vocabulary, as little-endian uint32.

    No piece holds a space behind another character, so words that single spaces divide are cut apart; texts with
    other runs of spaces, or with the character that stands for a space, are encoded whole.
    """

    ODD = re.compile("[▁\x00]")

    def __init__(self, path: str | None):
        from sentencepiece import SentencePieceProcessor

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.entries = Entries(self.bytes)
        self.by_word = not any(b" " in x[1:] and x.strip(b" ") for x in self.bytes)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.model.is_control(i) or self.model.is_unknown(i):
            return b""
        return piece.replace("▁", " ").encode()

    def words(self, words: list[str]) -> list[bytes | None]:
        """Ids of a space and each word; None for words that can't be encoded apart."""
        apart = [bool(self.by_word and w and not self.ODD.search(w)) for w in words]
        found = iter(self.model.encode([w for w, fit in zip(words, apart, strict=True) if fit], num_threads=1))
        return [array("I", next(found)).tobytes() if fit else None for fit in apart]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), "<u4")


class Words(dict):
    """Ids in both vocabularies by word; forgets all when it has grown large."""

    REMEMBERED = 400_000
    LONGEST = 64

    def __init__(self, sides: tuple):
        super().__init__()
        self.sides = sides

    def of(self, words: list[str]) -> list[tuple[bytes | None, bytes | None]]:
        found = list(map(self.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            asked = [words[i] for i in new]
            made = list(zip(*(side.words(asked) for side in self.sides), strict=True))
            if len(self) + len(new) > self.REMEMBERED:
                self.clear()
            for i, word, ids in zip(new, asked, made, strict=True):
                found[i] = ids
                if len(word) <= self.LONGEST:
                    self[word] = ids
        return found


def spread_out(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs with the given sizes, one run behind the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


def same_bytes(ids: np.ndarray, entries: Entries, data: np.ndarray) -> np.ndarray:
    """Whether each byte of the tokens, which together are as long as ``data``, equals the byte there."""
    return entries.data[spread_out(entries.start[ids], entries.size[ids])] == data


def gallop(targets: np.ndarray, finger: np.ndarray, longer: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Rank in ``longer`` of each target: the place of the first end that isn't before it.

    The rank lies in [first, last]; the search starts at ``finger``, goes on by doubling steps to either side
    until it has passed the target, and then halves.
    """
    low, high = first.copy(), last.copy()
    before = longer[finger] < targets
    low[before] = finger[before] + 1
    high[~before] = finger[~before]
    step = 1
    right, left = np.flatnonzero(before & (low < high)), np.flatnonzero(~before & (low < high))
    while len(right) or len(left):
        probe = np.minimum(low[right] + step - 1, high[right] - 1)
        passed = longer[probe] >= targets[right]
        high[right[passed]] = probe[passed]
        right, probe = right[~passed], probe[~passed]
        low[right] = probe + 1
        right = right[low[right] < high[right]]
        probe = np.maximum(high[left] - step, low[left])
        passed = longer[probe] < targets[left]
        low[left[passed]] = probe[passed] + 1
        left, probe = left[~passed], probe[~passed]
        high[left] = probe
        left = left[low[left] < high[left]]
        step *= 2
    rest = np.flatnonzero(low < high)
    while len(rest):
        middle = (low[rest] + high[rest]) >> 1
        less = longer[middle] < targets[rest]
        low[rest[less]] = middle[less] + 1
        high[rest[~less]] = middle[~less]
        rest = rest[low[rest] < high[rest]]
    return low


@dataclass(frozen=True)
class Aligned:
    """Of several documents: document, a token and b token of each link, and the common ends by token."""

    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Links and common ends of documents that lie one behind the other.

    ends: byte ends of all tokens, counted from the first document's start; size: tokens per document. The last ends of each
    document are equal.
    """
    common = (np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool))
    found = []
    for ends, other, sizes, others, mine, theirs, swap in (
        (ends_a, ends_b, size_a, size_b, *common, False), (ends_b, ends_a, size_b, size_a, *common[::-1], True)
    ):
        drives = (sizes < others) if swap else (sizes <= others)
        starts, other_starts = np.cumsum(sizes) - sizes, np.cumsum(others) - others
        docs = np.flatnonzero(drives & (sizes > 0))
        doc = np.repeat(docs, sizes[docs])
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(sizes[docs]) - sizes[docs], sizes[docs])
        token = starts[doc] + rank
        first, last = other_starts[doc], other_starts[doc] + others[doc] - 1
        place = gallop(ends[token], first + rank * others[doc] // sizes[doc], other, first, last)
        same = other[place] == ends[token]
        mine[token[same]] = True
        theirs[place[same]] = True
        begin = np.empty(len(place), np.int64)
        begin[1:] = place[:-1] + same[:-1]
        begin[rank == 0] = first[rank == 0]
        many = place - begin + 1
        left = np.repeat(token, many)
        right = np.arange(len(left)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
        found.append((np.repeat(doc, many), *((right, left) if swap else (left, right))))
    doc, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return Aligned(doc, a, b, *common)


class GroupText:
    """Writes `a1,a2|b1;a3|b2,b3` of documents; knows each id with each mark behind it as bytes."""

    def __init__(self, ids: int):
        self.names = [b"%d%c" % (i, mark) for i in range(ids) for mark in b",|;"]
        self.size = np.array([len(x) for x in self.names], np.int64)

    def of(self, ids_a, ids_b, ends_a, ends_b, tokens: np.ndarray) -> list[memoryview]:
        """The text of each document; ends: whether a token closes a group; tokens: of both kinds per document."""

        def groups(ends: np.ndarray) -> np.ndarray:
            return np.cumsum(ends) - ends

        total = int(ends_a.sum())
        group_a, group_b = groups(ends_a), groups(ends_b)
        per_a, per_b = (np.bincount(x, minlength=total) for x in (group_a, group_b))
        name = np.empty(len(ids_a) + len(ids_b), np.int64)
        name[np.arange(len(ids_a)) + (np.cumsum(per_b) - per_b)[group_a]] = 3 * ids_a + ends_a
        name[np.arange(len(ids_b)) + np.cumsum(per_a)[group_b]] = 3 * ids_b + 2 * ends_b
        text = memoryview(b"".join(map(self.names.__getitem__, name.tolist())))
        ends = np.concatenate(([0], np.cumsum(self.size[name])))[np.concatenate(([0], np.cumsum(tokens)))].tolist()
        return [text[low : max(low, high - 1)] for low, high in zip(ends[:-1], ends[1:], strict=True)]


#: Rows of documents, and (with pairs) one row for a chunk's list.
CHUNKS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, "
    "places binary, times binary, pairs array<long>, docs array<int>"
)


def _slim(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def _wide(data: bytes, many: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // many}").astype(np.int64) if many else np.empty(0, np.int64)


class Vocabularies:
    """Both vocabularies, loaded once per task."""

    def __init__(self, alignment: Alignment):
        self.a, self.b = ByteIds(alignment.byte_level), PieceIds(alignment.pieces)
        self.words = Words((self.a, self.b))
        self.text = GroupText(max(len(self.a.bytes), len(self.b.bytes)))

    def by_word(self, data: list[bytes]) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """(texts whose words can all be encoded apart, ids of all texts by vocabulary): each distinct word once."""
        words = pc.split_pattern(pa.array(data, pa.binary()).cast(pa.string()), " ")
        many = words.value_lengths().to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        known = self.words.of(coded.dictionary.to_pylist())
        first = np.cumsum(many) - many
        apart = np.ones(len(data), bool)
        sides = []
        for ids in zip(*known, strict=True):
            apart &= np.logical_and.reduceat(np.array([x is not None for x in ids])[code], first)
            size = np.array([len(x) // 4 if x else 0 for x in ids], np.int64)
            start = np.cumsum(size) - size
            flat = np.frombuffer(b"".join([x for x in ids if x]), "<u4")
            cuts = np.cumsum(np.add.reduceat(size[code], first))[:-1]
            sides.append(np.split(flat[spread_out(start[code], size[code])], cuts))
        return apart, sides

    def tokens(self, data: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text; none for texts that are empty or that either vocabulary doesn't give back."""
        none = np.empty(0, "<u4")
        apart, sides = self.by_word(data)
        for i in np.flatnonzero(~apart):
            for own, side in zip((self.a, self.b), sides, strict=True):
                side[i] = own.whole(data[i].decode()) if data[i] else none
        for own, side in zip((self.a, self.b), sides, strict=True):
            side[:] = [x if own.entries.size[x].sum() == len(d) + 1 else none for x, d in zip(side, data, strict=True)]
        fits = [bool(d) and len(x) > 0 and len(y) > 0 for d, x, y in zip(data, *sides, strict=True)]
        whole = np.frombuffer(b"".join([b" " + d for d, fit in zip(data, fits, strict=True) if fit]), np.uint8)
        sizes = np.array([len(d) + 1 for d, fit in zip(data, fits, strict=True) if fit], np.int64)
        good = np.ones(len(sizes), bool)
        for own, side in zip((self.a, self.b), sides, strict=True):
            if len(sizes):
                ids = np.concatenate([x for x, fit in zip(side, fits, strict=True) if fit])
                good &= np.logical_and.reduceat(same_bytes(ids, own.entries, whole), np.cumsum(sizes) - sizes)
        good = iter(good.tolist())
        fits = [fit and next(good) for fit in fits]
        return tuple([x if fit else none for x, fit in zip(side, fits, strict=True)] for side in sides)


class _Piece:
    """The alignment of some documents: one value per document, and the pairs of each document with their times."""

    def __init__(self, texts: list[bytes], known: Vocabularies):
        ids_a, ids_b = known.tokens(texts)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (ids_a, ids_b))
        ids_a, ids_b = (np.concatenate(side).astype(np.int64) for side in (ids_a, ids_b))
        size_a, size_b = known.a.entries.size, known.b.entries.size
        found = align(np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b]), self.n_a, self.n_b)
        groups = known.text.of(ids_a, ids_b, found.ends_a, found.ends_b, self.n_a + self.n_b)
        self.hashes = [hashlib.sha256(x).hexdigest() if len(x) else "" for x in groups]
        doc = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(doc[found.ends_a], minlength=len(texts))
        self.n_links = np.bincount(found.doc, minlength=len(texts))
        space = len(size_a) * len(size_b)
        keys, self.times = np.unique(found.doc * space + ids_a[found.a] * len(size_b) + ids_b[found.b], return_counts=True)
        self.doc, pairs = np.divmod(keys, space)
        a, b = np.divmod(pairs, len(size_b))
        self.pairs = a << 32 | b


def _chunks(alignment: Alignment):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabularies(alignment)
        # The task's number and a count within it name a chunk; the table they go to is written once.
        number = TaskContext.get().partitionId() << 32
        pieces: list[tuple[list, _Piece]] = []
        names = [part.split(" ")[0] for part in CHUNKS.split(", ")]

        def table() -> Iterator[pa.RecordBatch]:
            pairs, places, docs = np.unique(
                np.concatenate([p.pairs for _, p in pieces]), return_inverse=True, return_counts=True
            )
            at = 0
            for ids, piece in pieces:
                mine = places[at : at + len(piece.pairs)]  # rises within a document, as its pairs do
                at += len(piece.pairs)
                cuts = np.searchsorted(piece.doc, np.arange(len(ids) + 1)).tolist()
                spots, times = [], []
                for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                    spots.append(_slim(np.diff(mine[low:high], prepend=0)).tobytes())
                    times.append(_slim(piece.times[low:high]).tobytes())
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * n, pa.int64()), pa.array(ids, pa.int64()), pa.array(piece.n_a), pa.array(piece.n_b),
                        pa.array(piece.n_groups), pa.array(piece.n_links), pa.array(piece.hashes),
                        pa.array(np.diff(cuts).astype(np.int32)), pa.array(spots, pa.binary()), pa.array(times, pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32())),
                    ],
                    names=names,
                )
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(x))
                for x in (pairs.astype(np.int64), docs.astype(np.int32))
            ]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.nulls(1, k) for k in kinds], *lists], names=names)

        size = 0
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held >= PIECE:
                    pieces.append((ids, _Piece(texts, known)))
                    size, ids, texts, held = size + held, [], [], 0
                    if size >= alignment.chunk:
                        yield from table()
                        pieces, size, number = [], 0, number + 1
            if ids:
                pieces.append((ids, _Piece(texts, known)))
                size += held
        if pieces:
            yield from table()

    return chunks


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _weighed(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of a chunk with the sums over their links of what the corpus counts for the chunk's pairs."""
    many, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
    place = counts.column("place").to_numpy()
    many[place], best[place] = counts.column("n").to_numpy(), counts.column("best").to_numpy()
    n_best, total = [], []
    columns = (docs.column(c).to_pylist() for c in ("places", "times", "n_pairs"))
    for spots, times, n in zip(*columns, strict=True):
        at, times = np.cumsum(_wide(spots, n)), _wide(times, n)
        n_best.append(int((times * best[at]).sum()))
        total.append(int((times * many[at]).sum()))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    sums = [pa.array(n_best, pa.int64()), pa.array(total, pa.int64())]
    return pa.table(
        [*[docs.column(c) for c in names], *sums, docs.column("groups_sha256")],
        names=[*names, "n_best", "count_sum", "groups_sha256"],
    )


def aligned(docs: DataFrame, alignment: Alignment = Alignment(), scratch: Scratch | None = None) -> DataFrame:
    """One row per document: doc_id, tokens (n_a, n_b), groups, links, and over its links n_best and count_sum; the
    groups as a hash.

    An id pair's count is the number of documents (rows) that hold it linked; a link is best if no pair of its a id
    has a higher count. Texts that are null, empty, or that a tokenizer doesn't give back byte by byte behind
    a space have no tokens: zeros and an empty string. Null and repeated ids are rows like others. Columns other
    than doc_id and text are ignored. An empty table gives no rows. The tables that the result reads go to ``scratch``.
    """
    last = scratch or Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes().alias("text"))
    chunks = last.table(rows.mapInArrow(_chunks(alignment), CHUNKS), "alignment-chunks")
    lists = chunks.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "one"))
    lists = lists.select(F.col("chunk").alias("of"), "place", F.col("one.pairs").alias("pair"), F.col("one.docs").alias("docs"))
    counts = lists.groupBy("pair").agg(F.sum("docs").alias("n"))
    # A pair's a id has no more pairs than the other vocabulary has ids.
    mine = Window.partitionBy(F.floor(F.col("pair") / F.lit(1 << 32)))
    counts = last.table(counts.select("pair", "n", (F.col("n") == F.max("n").over(mine)).alias("best")), "alignment-counts")
    weights = lists.join(counts, "pair").select("of", "place", "n", F.col("best").cast("long").alias("best"))
    texts = chunks.where("pairs is null").drop("pairs", "docs")
    return texts.groupBy("chunk").cogroup(weights.groupBy("of")).applyInArrow(_weighed, ALIGNED)
