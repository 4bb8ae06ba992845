"""Subword lattice likelihood: the marginal probability of a text over all its segmentations.

A word's lattice has an arc for each piece of an existing subword vocabulary, and one arc over the
whole word if training documents hold it. A forward recursion in log space adds up all paths:

    P(word) = (c - d) / N  +  (d V / N) * sum over segmentations of the product of piece weights

with c the word's count, N all tokens, V distinct ones and d the absolute discount n1 / (n1 + 2 n2). The
piece weights sum to one. They start from the vocabulary's own scores (its ranks, by Zipf's law) and are
refitted by expectation maximisation over all distinct training words, each once: discounting takes d from
every distinct word, and what it takes is what the pieces share out. Every byte is a piece of its own, so
every word has a path. A text is a sequence of words and one end token, whose weight
comes from the number of training documents; all tokens together have probability one.

Word counts are gathered from all training documents: words travel once per chunk of documents, not once
per document, and their counts and probabilities travel back to the chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import U64, as_bytes, folded, mix, remainder

LOG10 = float(np.log(10))
NEVER = -1e30


@dataclass(frozen=True)
class LatticeModel:
    """vocabulary: a sentencepiece model file, None for ``public_tokenizers``' 32k pieces.

    passes: refits of the piece weights. fold, held: documents whose crc32 of the id leaves
    ``held`` modulo ``fold`` are not learned from. chunk_bytes: text whose words travel together.
    """

    vocabulary: str | None = None
    passes: int = 3
    fold: int = 7
    held: int = 2
    chunk_bytes: int = 12_000_000


class Pieces:
    """Pieces as byte strings, looked up by the hash of their bytes."""

    def __init__(self, path: str | None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        rank: dict[bytes, float] = {bytes([b]): 1.0 for b in range(256)}
        for i in range(model.get_piece_size()):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i)):
                text = model.id_to_piece(i).replace("▁", " ").encode()
                rank.setdefault(text, 1.0)
                # A word is a space and then its bytes; the scores are minus the rank of the merge.
                rank[text] = 1.0 / (10.0 + min(abs(model.get_score(i)), 1e6))
        rank = {k: v for k, v in rank.items() if b" " not in k[1:] and k == k.lower()}
        self.texts = sorted(rank, key=lambda k: (len(k), k))
        self.lengths = np.array([len(k) for k in self.texts])
        self.longest = int(self.lengths.max())
        weight = np.array([rank[k] for k in self.texts])
        self.log = np.log(weight / weight.sum())
        codes = np.array([self._hash(np.frombuffer(k, np.uint8)[None, :])[0] for k in self.texts], U64)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], order
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[codes >> U64(44)] = True

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        h = np.full(len(rows), rows.shape[1], U64)
        raw = np.zeros(len(rows), U64)
        for j in range(rows.shape[1]):
            raw = raw * U64(0x100000001B3) + rows[:, j].astype(U64) + U64(1)
        return mix(raw ^ (h << U64(56)))

    def spans(self, rows: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, word, start, piece) of all pieces in words of one length, by length."""
        out, raw = [], np.zeros(rows.shape, U64)
        n, width = rows.shape
        for size in range(1, min(self.longest, width) + 1):
            raw = raw[:, : width - size + 1] * U64(0x100000001B3) + rows[:, size - 1 :].astype(U64) + U64(1)
            code = mix(raw ^ (U64(size) << U64(56)))
            word, start = np.nonzero(self.maybe[code >> U64(44)])
            code = code[word, start]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            out.append((size, word[hit], start[hit], self.ids[at[hit]]))
        return out

    def lattice(self, words: list[bytes], counts: np.ndarray | None, log: np.ndarray):
        """Log marginals of the words; with counts also the expected uses of each piece."""
        words = [b" " + w for w in words]
        result, uses = np.empty(len(words)), np.zeros(len(self.texts))
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes):
            group = np.flatnonzero(sizes == size)
            step = max(1, 400_000 // int(size))
            for at in range(0, len(group), step):
                part = group[at : at + step]
                rows = np.frombuffer(b"".join([words[i] for i in part]), np.uint8).reshape(len(part), size)
                spans = self.spans(rows)
                # weight[l][word, start]: log weight of the piece of length l that begins there.
                weight = []
                for length, word, start, piece in spans:
                    w = np.full((size - length + 1, len(part)), NEVER)
                    w[start, word] = log[piece]
                    weight.append(w)
                forward = self._forward(weight, size, len(part))
                result[part] = forward[size]
                if counts is not None:
                    backward = self._backward(weight, size, len(part))
                    for (length, word, start, piece) in spans:
                        share = forward[start, word] + log[piece] + backward[start + length, word] - forward[size, word]
                        uses += np.bincount(piece, np.exp(share) * counts[part][word], len(uses))
        return result, uses

    @staticmethod
    def _forward(weight: list[np.ndarray], size: int, n: int) -> np.ndarray:
        out = np.full((size + 1, n), NEVER)
        out[0] = 0
        for end in range(1, size + 1):
            paths = np.stack([out[end - k] + weight[k - 1][end - k] for k in range(1, min(end, len(weight)) + 1)])
            top = paths.max(axis=0)
            out[end] = top + np.log(np.exp(paths - top).sum(axis=0))
        return out

    @staticmethod
    def _backward(weight: list[np.ndarray], size: int, n: int) -> np.ndarray:
        out = np.full((size + 1, n), NEVER)
        out[size] = 0
        for start in range(size - 1, -1, -1):
            paths = np.stack(
                [out[start + k] + weight[k - 1][start] for k in range(1, min(size - start, len(weight)) + 1)]
            )
            top = paths.max(axis=0)
            out[start] = top + np.log(np.exp(paths - top).sum(axis=0))
        return out


CHUNKS = "chunk long, place int, word binary, uses long, doc_id long, held_out boolean, words binary"


def _chunked(limit: int):
    """Rows of two kinds: a chunk's distinct words with their training uses, and its documents.

    ``words`` of a document: its distinct words as places in the chunk, and their counts (int32 pairs).
    """

    def flush(chunk: int, found: dict, docs: list) -> pa.RecordBatch:
        names, uses = list(found), np.zeros(len(found), np.int64)
        packed = []
        for _, held, words in docs:
            place, count = np.unique(np.fromiter(map(found.__getitem__, words), np.int32, len(words)), return_counts=True)
            if not held:
                uses[place] += count
            packed.append(np.concatenate((place, count.astype(np.int32))).tobytes())
        v, d = len(names), len(docs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([chunk] * (v + d), pa.int64()),
                pa.array(list(range(v)) + [None] * d, pa.int32()),
                pa.array(names + [None] * d, pa.binary()),
                pa.array(uses.tolist() + [None] * d, pa.int64()),
                pa.array([None] * v + [x[0] for x in docs], pa.int64()),
                pa.array([None] * v + [x[1] for x in docs], pa.bool_()),
                pa.array([None] * v + packed, pa.binary()),
            ],
            names=["chunk", "place", "word", "uses", "doc_id", "held_out", "words"],
        )

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        found: dict[bytes, int] = {}
        docs, size = [], 0
        for batch in batches:
            for doc_id, held, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                data = data.as_py()
                words = folded(data)
                for w in words:
                    if w not in found:
                        found[w] = len(found)
                docs.append((doc_id.as_py(), held.as_py(), words))
                size += len(data)
                if size >= limit:
                    yield flush(chunk, found, docs)
                    chunk, found, docs, size = chunk + 1, {}, [], 0
        if docs:
            yield flush(chunk, found, docs)

    return chunked


def _expected(pieces, log):
    def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(pieces.value.texts))
        for rows in batches:
            total += pieces.value.lattice(list(rows["word"]), np.ones(len(rows)), log)[1]
        used = np.flatnonzero(total)
        yield pd.DataFrame({"piece": used.astype(np.int32), "uses": total[used]})

    return expected


def _marginals(pieces, log, discount: float, rest: float, tokens: int):
    def marginals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            count = rows["count"].to_numpy(float)
            subword = pieces.value.lattice(list(rows["word"]), None, log)[0] + np.log(rest)
            whole = np.log(np.maximum(count - discount, 1e-300) / max(tokens, 1))
            rows["log10"] = np.where(count > 0, np.logaddexp(whole, subword), subword) / LOG10
            yield rows[["word", "count", "log10"]]

    return marginals


def _scored(tokens: int, types: int, ends: int, end_log10: float):
    def base(count):
        return np.log10((count + 1) / (tokens + types + 1))

    def scored(key, words: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        count, log10 = np.zeros(len(words), np.int64), np.zeros(len(words))
        count[words["place"]], log10[words["place"]] = words["count"], words["log10"]
        first = base(count.astype(float))
        out = []
        for data in docs["words"]:
            place, times = np.frombuffer(data, np.int32).reshape(2, -1)
            seen = count[place] > 0
            out.append((
                int(times.sum()) + 1, int(times[seen].sum()) + (ends > 0),
                float((first[place] * times).sum() + base(float(ends))), float((log10[place] * times).sum() + end_log10),
            ))
        frame = pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score", "score"])
        frame["train_tokens"] = tokens
        frame["doc_id"], frame["held_out"] = docs["doc_id"].astype("Int64").to_numpy(), docs["held_out"].to_numpy()
        return frame[["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]]

    return scored


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def lattice_scores(docs: DataFrame, model: LatticeModel = LatticeModel()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    score: log10 of the model's probability of the text. base_score: the same for add-one counts of whole
    words. A null text is empty and holds the end token only; a null id counts as training; repeated ids and
    texts each get a row. Without training documents all words go through the pieces alone, the
    end has probability one half, and N is 0. Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (remainder("doc_id", model.fold) == model.held).alias("held_out"),
        as_bytes().alias("text"),
    )
    chunks = materialize(rows.mapInArrow(_chunked(model.chunk_bytes), CHUNKS), "lattice-chunks")
    words = chunks.where("word is not null").select("chunk", "place", "word", "uses")
    texts = chunks.where("word is null").select(F.col("chunk").alias("of"), "doc_id", "held_out", "words")

    counted = materialize(words.groupBy("word").agg(F.sum("uses").alias("count")), "lattice-words")
    stats = counted.agg(
        F.sum("count"), F.count_if(F.col("count") > 0), F.count_if(F.col("count") == 1), F.count_if(F.col("count") == 2)
    ).first()
    total, types, once, twice = (int(x or 0) for x in stats)
    ends = texts.where("not held_out").count()
    tokens, types = total + ends, types + (ends > 0)
    discount = once / (once + 2 * twice) if once and twice else 0.75
    rest = discount * types / tokens if tokens else 0.5
    end_log10 = float(np.log10((ends - discount) / tokens)) if ends else float(np.log10(0.5))

    pieces = Pieces(model.vocabulary)
    log = pieces.log
    shared = spark.sparkContext.broadcast(pieces)  # the vocabulary file's pieces, whatever the input
    known = counted.where("count > 0")
    for _ in range(model.passes):
        uses = known.mapInPandas(_expected(shared, log), "piece int, uses double").groupBy("piece").agg(F.sum("uses"))
        prior = np.exp(pieces.log)  # one use in all, spread as the vocabulary's scores say
        for piece, use in uses.collect():  # one row per piece of the vocabulary
            prior[piece] += use
        log = np.log(prior / prior.sum())
    scored = counted.mapInPandas(
        _marginals(shared, log, discount, rest, tokens), "word binary, count long, log10 double"
    )
    scored = materialize(scored, "lattice-marginals")
    back = words.select("chunk", "place", "word").join(scored, "word").select("chunk", "place", "count", "log10")
    return (
        back.groupBy("chunk").cogroup(texts.groupBy("of"))
        .applyInPandas(_scored(tokens, types, ends, end_log10), SCORES)
    )
