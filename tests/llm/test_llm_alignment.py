"""Token alignment against a walk over byte spans; the galloping search against numpy."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barograph.llm import alignment
from barograph.llm.alignment import Alignment, Vocabularies, aligned, gallop


@pytest.fixture(scope="module")
def known():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    both = Vocabularies(Alignment())
    return byte_level, pieces, both.a.bytes, both.b.bytes


def spans(ids, entries):
    ends = np.cumsum([len(entries[i]) for i in ids]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def plain(rows, known):
    """The contract, link by link."""
    byte_level, pieces, bytes_a, bytes_b = known
    held, counts = [], Counter()
    for doc_id, text in rows:
        row, links = [doc_id, 0, 0, 0, 0, ""], []
        a = byte_level.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pieces.encode(text or "")
        whole = b" " + (text or "").encode()
        if text and b"".join(bytes_a[i] for i in a) == whole == b"".join(bytes_b[i] for i in b):
            at, bt = spans(a, bytes_a), spans(b, bytes_b)
            links = [(x, y) for x, (s, e) in zip(a, at) for y, (t, f) in zip(b, bt) if s < f and t < e]
            ends = sorted({e for _, e in at} & {e for _, e in bt})
            groups = [
                ",".join(str(x) for x, (_, e) in zip(a, at) if low < e <= high) + "|"
                + ",".join(str(x) for x, (_, e) in zip(b, bt) if low < e <= high)
                for low, high in zip([0, *ends[:-1]], ends)
            ]
            row = [doc_id, len(a), len(b), len(ends), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest()]
        counts.update(set(links))
        held.append((row, links))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return sorted(
        [(*row[:5], sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links), row[5]) for row, links in held],
        key=str,
    )


TEXTS = [
    None, "", " ", "  two  spaces ", " lead", "trail ", "plain words and more words", "plain words and more words",
    "<|endoftext|> <s>tag</s> <0x41>", "a\nb\r\n\tc\x0cd", "\x00nul", "▁mark", "日本語 テキスト 👍🏽 é à", "x" * 3000, "ｆｕｌｌ ﬁ",
    "don't we'll 12345 67,89", "non\u00a0break\u3000wide", "e\u0301 combining", "Ünïcödé straße", "\ufeffbom",
]


def test_alignment_equals_walk(documents, known):
    rng = random.Random(5)
    words = ["the", "The", "lumenor", "x1", "über", "naïve", "1,000", "a", "日本", "end."]
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "same id")]
    rows += [(100 + i, rng.choice(["\n", " "]).join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(60)]
    got = aligned(documents(rows).repartition(3), Alignment(chunk=300))
    assert got.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, known)


def test_pieces_of_a_batch_and_the_cache_change_nothing(documents, known, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE", 50)
    monkeypatch.setattr(alignment.Words, "REMEMBERED", 5)
    rows = list(enumerate(TEXTS))
    found = alignment._chunks(Alignment(chunk=100))
    rows_of = documents(rows).select("doc_id", alignment.as_bytes().alias("text")).coalesce(1)
    got = rows_of.mapInArrow(found, alignment.CHUNKS).where("pairs is null").select("doc_id", "n_a", "n_b", "groups_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(*r[:3], r[7]) for r in plain(rows, known)], key=str)


def test_alignment_of_odd_rows(odd, spark):
    got = aligned(odd).collect()
    assert len(got) == odd.count()
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in got)
    assert aligned(odd.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=60, unique=True), st.lists(st.integers(1, 400), min_size=1, max_size=60))
def test_gallop_is_lower_bound(longer, targets):
    longer = np.array(sorted([*longer, 401]))
    targets = np.array(targets)
    first, last = np.zeros(len(targets), np.int64), np.full(len(targets), len(longer) - 1)
    for finger in (first, last, np.arange(len(targets)) % len(longer)):
        assert (gallop(targets, finger, longer, first, last) == np.searchsorted(longer, targets)).all()
