"""Similarity joins, neighbours and packing against brute force."""

import os
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from barograph.llm import jaccard, linededup, neighbours, packing, queries
from barograph.llm.common import IdFilter, Scratch
from barograph.llm.tokens import Tokens


def near_texts(seed=3, groups=12, size=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = {}
    for g in range(groups):
        base = [rng.choice(words) for _ in range(size + 5 * g)]
        for c in range(8):
            text = list(base)
            for _ in range(c % 5):
                text[rng.randrange(len(text))] = rng.choice(words)
            out[len(out) * 3 + 1] = " ".join(text).upper() if c == 3 else " ".join(text)
    return out


def classes(texts, words, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_near_documents(documents, words, percent):
    texts = near_texts() | {1000: "", 1001: None, 1002: "a b", 1003: "A  b", 1004: "a"}
    got = jaccard.near_documents(documents(texts), jaccard.Near(words, percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == classes(texts, words, percent)


def test_near_documents_odd_rows(odd, spark):
    got = jaccard.near_documents(odd).collect()
    assert len(got) == odd.count()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 2), (3, 3), (None, 4), (4, 4), (5, 5), (6, 6)}
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6]
    assert jaccard.near_documents(odd.limit(0)).count() == 0


def test_sketch_bound():
    """Sets within k shingles share a key, whichever shingles differ."""
    rng = np.random.default_rng(1)
    bands = jaccard.Bands(jaccard.Near(3, 90))
    for n in (20, 57, 300, 1000):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(20):
            other = base[rng.random(n) > 0.09]
            other = np.union1d(other, rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64))
            shared = len(np.intersect1d(base, other))
            if 100 * shared >= 90 * (len(base) + len(other) - shared):
                assert np.intersect1d(bands.keys(base), bands.keys(other)).size


def brute_lines(rows, least=5, percent=80):
    seen, out = [], []
    for i, t in rows:
        kept, gone = [], 0
        for line in (t or "").split("\n"):
            s = set(line.lower().split())
            if len(s) >= least:
                hit = any(100 * len(s & o) >= percent * len(s | o) for o in seen)
                seen.append(s)
                if hit:
                    gone += 1
                    continue
            kept.append(line)
        text = "\n".join(kept)
        if not gone or text.split():
            out.append((i, t if t is None else text, gone))
    return out


def test_line_dedup(documents):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(150)]
    base = [" ".join(rng.choices(words, k=rng.randint(3, 25))) for _ in range(60)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(base).split()
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    got = linededup.drop_repeated_lines(documents(rows), count="gone").collect()
    assert sorted((r.doc_id, r.text, r.gone) for r in got) == sorted(brute_lines(rows))


def test_registered_line_dedup_covers_short_lines(spark, documents, folder):
    rng = random.Random(8)
    words = [f"v{i}" for i in range(12)]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 7))) for _ in range(rng.randint(1, 5))]
        rows.append((i, "\n".join([*lines, "all rights reserved."] if i % 4 == 0 else lines)))
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    want = sorted(brute_lines(rows, least=1))
    got = queries.QUERIES["op5_line_dedup"](spark, folder).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [x[:2] for x in want]
    got = corpus_pipeline.line_dedup(spark, documents(rows), folder).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [x[:2] for x in want]


def line_entries(texts, copies):
    """The entries of the first pass, sorted by word, as the index of one task gives them, and the id of each text."""
    from types import SimpleNamespace

    import pyarrow as pa

    counts = np.full(1 << linededup.BUCKET_BITS, 9, np.uint8)
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array([t.encode() for t in texts])], names=["rid", "doc_id", "text"])
    (rows,) = linededup._index(SimpleNamespace(value=counts), copies)(iter([batch]))
    rows = rows.to_pydict()
    out = [
        (e >> 32, doc, sid, (n << 32) | (e & 0xFFFFFFFF), p1, p2)
        for doc, sid, n, p1, p2, some in zip(*[rows[c] for c in ("doc_id", "sid", "n", "p1", "p2", "e0")], strict=True)
        for e in some
    ]
    columns = zip(*sorted(out), strict=True)
    kinds = [pa.int32(), *[pa.int64()] * 5]
    arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "doc", "sid", "ni", "p1", "p2"]), rows["sid"]


def similar_texts(texts):
    sets = [set(t.split()) for t in texts]
    pairs = [(i, j) for j in range(len(sets)) for i in range(j)]
    return {(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}


@pytest.mark.parametrize("limits", [{}, {"CROWD": 8, "FEW": 2, "ROOM": 40}, {"FEW": 1, "ROOM": 40}])
def test_candidates_of_lines_hold_every_link(monkeypatch, limits):
    """Each late line meets an earlier similar one, unless a word of both is hot."""
    for name, value in limits.items():
        monkeypatch.setattr(linededup, name, value)
    rng = random.Random(3)
    base = [rng.sample([f"v{i}" for i in range(400)], rng.randint(5, 120)) for _ in range(12)]
    texts = set()
    for _ in range(150):
        line = list(rng.choice(base))
        for _ in range(rng.randint(0, len(line) // 8)):
            line[rng.randrange(len(line))] = f"x{rng.randrange(40)}"
        texts.add(" ".join(sorted(set(line))))
    texts = sorted(texts)
    batch, ids = line_entries(texts, linededup.LineCopies(min_words=1, passes=1))
    met, hot = set(), set()
    for out in linededup._meeting(80)(iter([batch.slice(i, 25) for i in range(0, batch.num_rows, 25)])):
        met |= {(r["a"], r["b"]) for r in out.to_pylist() if r["word"] is None}
        hot |= {r["word"] for r in out.to_pylist() if r["word"] is not None}
    words = {}
    for r in batch.to_pylist():
        words.setdefault(r["sid"], set()).add(r["word"])
    links = similar_texts(texts)
    assert links and (hot or not limits) and all(a < b for a, b in met)
    of = {i: {j for j in range(i) if (j, i) in links} for i in range(len(texts))}
    for i, earlier in of.items():
        if earlier and not any((min(ids[i], ids[j]), max(ids[i], ids[j])) in met for j in earlier):
            assert any(words[ids[i]] & words[ids[j]] & hot for j in earlier)


def test_long_lines_under_a_word_are_no_candidates(documents, monkeypatch):
    """Lines of 150 words that share a few rare ones differ too much: hardly a pair reaches verification."""
    seen, verified = [], linededup._verified

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(linededup, "_verified", counted)
    rng = random.Random(9)
    rare = [f"r{i}" for i in range(8)]
    texts = [" ".join([*rng.sample(rare, 4), *rng.sample([f"v{i}" for i in range(300)], 146)]) for _ in range(80)]
    got = linededup.drop_repeated_lines(documents(list(enumerate(texts))), count="gone").collect()
    assert sorted((r.doc_id, r.text, r.gone) for r in got) == brute_lines(list(enumerate(texts)))
    assert sum(seen) < 20


def _peak_mb(step, batch):
    tracemalloc.start()
    try:
        for _ in step(iter([batch])):
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_line_dedup_tables_of_a_task_are_held_once():
    rng = np.random.default_rng(8)
    texts = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 200)).encode() for _ in range(500)], pa.binary())
    assert _peak_mb(linededup._count(1), pa.RecordBatch.from_arrays([texts], names=["text"])) < 110
    lines = [pa.array(rng.integers(0, 1 << 60, 100_000)), pa.array(np.arange(100_000), pa.int32())]
    batch = pa.RecordBatch.from_arrays(lines, names=["rid", "place"])
    assert _peak_mb(linededup._mark, batch) < 40
    bits = np.zeros(1 << (linededup.FILTER_BITS - 3), np.uint8)
    for out in linededup._mark(iter([batch])):
        for block, data in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            bits[block * linededup.BLOCK : (block + 1) * linededup.BLOCK] = np.frombuffer(data, np.uint8)
    spots = np.unique(linededup._spot(lines[0].to_numpy(), lines[1].to_numpy()))
    assert np.array_equal(np.flatnonzero(np.unpackbits(bits)), spots)


def test_counts_of_lines_are_held_in_16_bits():
    """The table takes half of what it did, and words found more often than 16 bits hold keep their counts."""
    texts = pa.array([b"often " * 70_000, b"often once\nonce twice twice", b"often " * 61_071], pa.binary())
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    assert _peak_mb(linededup._count(1), batch) < 66
    found = np.zeros(1 << linededup.BUCKET_BITS, np.uint8)
    for out in linededup._count(1)(iter([batch])):
        for block, data in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            found[block * linededup.BLOCK : (block + 1) * linededup.BLOCK] = np.frombuffer(data, np.uint8)
    words = linededup.word_hashes(pa.array(["often", "once", "twice"]))[0]
    assert found[linededup.bucket_of(words)].tolist() == linededup.logarithmic(np.array([131_072, 2, 2])).tolist()
    assert np.count_nonzero(found) == 3


def test_near_copies_hand_keys_and_sets_on_in_parts():
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 300)).encode() for _ in range(2500)], pa.binary())
    near = jaccard.Near()
    ids = pa.array(range(len(texts)))
    out = list(jaccard._sign(near)(iter([pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])])))
    assert len(out) > 5 and max(x.nbytes for x in out) < 4 << 20
    rows = pa.Table.from_batches(out)
    assert rows["doc_id"].to_pylist() == ids.to_pylist() and set(rows["n_shingles"].to_pylist()) == {296}
    sets = list(jaccard._sets(near)(iter([pa.RecordBatch.from_arrays([texts], names=["text"])])))
    assert len(sets) > 5 and max(x.nbytes for x in sets) < 2 << 20
    assert pa.Table.from_batches(sets)["sid"].to_pylist() == rows["sid"].to_pylist()


def test_near_copies_hold_little_on_disk(documents, monkeypatch):
    """Keys are gone when sets are compared, pairs are compared part by part, and only copies' texts are dealt out."""
    paths, held, table = {}, [], Scratch.table

    def watched(self, df, label):
        out = table(self, df, label)
        paths.setdefault(label, []).append(self.paths[-1].removeprefix("file:"))
        if label == "jaccard-links":
            held.append({k: sum(map(os.path.exists, v)) for k, v in paths.items()})
        return out

    monkeypatch.setattr(Scratch, "table", watched)
    monkeypatch.setattr(jaccard, "LEAST", 1, raising=False)
    texts = near_texts(groups=5) | {1000: "", 1001: "a b"}
    rows = [*texts.items(), (1, texts[1]), (1, "other words"), (1001, "a b"), (None, texts[7])]
    kept = jaccard.one_of_each(documents(rows), jaccard.Near(5, 80))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert sum(x["jaccard-signed"] for x in held) == 0 and all(x["jaccard-sets"] == 1 for x in held), held
    assert len(held) > 2 and not any(os.path.exists(x) for x in paths["jaccard-sets"])
    assert plan.splitlines()[0].startswith("Union") and "Join LeftAnti" in plan.partition("Aggregate [doc_id")[0]
    least = {root for _, root in classes(texts, 5, 80).values()}
    got = sorted((r.doc_id, r.text) for r in kept.collect())
    assert got == sorted([*((i, texts[i]) for i in least), (1, "other words")])


def test_filter_of_ids(spark):
    for n in (0, 1, 5000):
        ids = spark.range(n).selectExpr("if(id = 3, null, id * 7) as k")
        rows = spark.range(40_000).selectExpr("if(id = 21, null, id) as doc_id", "1 as _bits", "'x' as _block")
        chosen = IdFilter(ids, "k")
        within, outside = chosen.within(rows, "doc_id"), chosen.outside(rows, "doc_id")
        assert within.columns == outside.columns == rows.columns
        inside, others = ({r.doc_id for r in x.collect()} for x in (within, outside))
        meant = {r.k for r in ids.collect()}
        assert meant <= inside and not meant & others and len(inside) + len(others) == 40_000
        assert len(inside) - len(meant) < 400 and chosen.blocks == (8 if n == 5000 else 1)


def test_line_dedup_hands_texts_on_in_parts():
    texts = [None, "", *["é\n" + "x" * 50_000 + "\né"] * 100, "y" * 3_000_000]
    places = [None, None, *[[2], [0, 1]] * 50, None]
    columns = [pa.array(range(len(texts))), pa.array(texts), pa.array(places, pa.list_(pa.int32()))]
    batch = pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "places"])
    out = list(linededup._without(1, 2)(iter([batch])))
    assert all(x.num_rows == 1 or x.column(1).nbytes < 1 << 21 for x in out)
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    assert [r["text"] for r in rows] == [None, "", *["é\n" + "x" * 50_000, "é"] * 50, texts[-1]]
    assert [r["places"] for r in rows] == [0, 0, *[1, 2] * 50, 0]


def test_small_work_tables_are_few_files(spark, documents, monkeypatch):
    """With many shuffle partitions, tables that are small beside the lines are not a file for each of them."""
    files, table = {}, Scratch.table

    def counted(self, df, label):
        out = table(self, df, label)
        files.setdefault(label, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(Scratch, "table", counted)
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    texts = near_texts(groups=4)
    rows = [(i, f"{t}\nline {i} x\nsame line here") for i, t in texts.items()]
    most = 2 * spark.sparkContext.defaultParallelism
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        lines = linededup.drop_repeated_lines(documents(rows), linededup.LineCopies(min_words=1), count="gone")
        got = sorted((r.doc_id, r.text, r.gone) for r in lines.collect())
        assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
        assert got == brute_lines(rows, 1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert most < 60 and len(files) > 5 and max(map(max, files.values())) <= most, files


def test_line_dedup_odd_rows(odd):
    got = linededup.drop_repeated_lines(odd, count="n")
    assert got.columns == [*odd.columns, "n"]
    rows = sorted(((r.doc_id is None, r.doc_id, r.text) for r in got.collect()), key=str)
    assert sum(x[2] == "a b c d e f g" for x in rows) == 1 and len(rows) == 6
    assert linededup.drop_repeated_lines(odd.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 1, (300, 12)).astype(np.float32)
    vectors[50:90] = vectors[7]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [None] * 12), (None, [1.0] * 12), (904, [])]
    df = spark.createDataFrame(rows + bad + rows[:5], "vec_id long, embedding array<float>")
    blocks = neighbours.Blocks(k=7, query_rows=8, candidate_rows=20, merged=3)
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, blocks).collect()
    full = vectors.astype(float)
    want = []
    for q in range(0, 300, 20):
        score = neighbours.products(np.repeat(full[q : q + 1], 300, 0), full)
        order = [i for i in np.lexsort((np.arange(300), -score)) if i != q][:7]
        want += [(q, k + 1, i, score[i]) for k, i in enumerate(order)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = neighbours.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r.rank for r in few] == [1, 2]


def test_neighbours_of_repeated_ids_other_lengths_and_tiny_vectors(spark):
    """Every vector takes part; a pair of ids counts once, with its largest product, among vectors of one length."""
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=6)) for i in rng.integers(0, 40, 120)] + [(i, rng.normal(size=3)) for i in range(40, 60)]
    rows += [(20, np.array([1e-323, 0, 0, 0, 0, 0])), (60, np.array([1e-323, 1e-323, 0])), (61, np.array([0.0, 1e300, 0]))]
    rows += [rows[0], (40, rng.normal(size=6)), (80, np.full(1500, 0.5)), (81, np.full(1500, -0.25)), (82, rng.normal(size=1500))]
    df = spark.createDataFrame([(i, v.tolist(), 1, 2) for i, v in rows], "vec_id long, embedding array<double>, query int, id int")
    for blocks in (neighbours.Blocks(k=5), neighbours.Blocks(k=5, query_rows=2, candidate_rows=9, merged=2)):
        got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, blocks).collect()
        want = {}
        for i, v in rows:
            for j, w in rows:
                if i % 20 == 0 and i != j and len(v) == len(w):
                    score = float(neighbours.products(v[None], w[None])[0])
                    want[i, j] = max(want.get((i, j), -np.inf), score)
        listed = []
        for q in sorted({i for i, _ in want}):
            near = sorted((-s, j) for (i, j), s in want.items() if i == q)[:5]
            listed += [(q, k + 1, j, -s) for k, (s, j) in enumerate(near)]
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == listed


def test_fill_is_optimal():
    rng = random.Random(4)
    for _ in range(60):
        counts = Counter({rng.randint(1, 60): rng.randint(1, 3) for _ in range(rng.randint(1, 6))})
        room = rng.randint(1, 100)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        chosen = packing.fill(sorted(counts, reverse=True), counts, room)
        assert all(chosen[k] <= counts[k] for k in chosen)
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)


def test_packing(documents):
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choices(["one", "Two's", "drei", "ça", "x1y2", "。", "  "], k=rng.randint(0, 300))))
             for i in range(60)]
    texts += [(100, None), (101, ""), (7, "again"), (None, "no id"), (102, "<|endoftext|> a")]
    got = packing.pack_documents(documents(texts), packing.Packing(capacity=64, bucket_rows=16)).toPandas()
    tokens = Tokens()
    ids = [(i, np.frombuffer(tokens.whole(t or "") + (0).to_bytes(4, "little"), "<u4")) for i, t in texts]
    assert got["length"].sum() == sum(len(x) for _, x in ids)
    for i, x in ids:
        if i == 7 or i is None:
            continue
        part = got[got["doc_id"] == i].sort_values("start")
        assert part["start"].tolist() == np.cumsum([0, *part["length"]])[:-1].tolist()
        assert all(zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in part.itertuples())
        assert set(part["doc_tokens"]) == {len(x)}
    filled = got.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 64 and (filled < 64).sum() <= 8
    ordered = got.sort_values(["sequence_id", "offset"])
    ends = ordered["offset"] + ordered["length"]
    assert (ordered["offset"] == ends.groupby(ordered["sequence_id"]).shift(fill_value=0)).all()
    assert packing.pack_documents(documents([]), packing.Packing()).count() == 0


def test_tokens_match_the_tokenizer():
    import public_tokenizers

    tokens, whole = Tokens(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["a  b\n\n c's DON'T 123abc  ", "x\t\ty ñandú's  \r\n z", " ", "", "²½ ª º", "a\x0bb", "é'll  ''s", "日本 x",
                 "a\n b \u3000c", "to be, to  be", "one <|endoftext|> two", "x\x1c y \x1c z ", "w" * 100 + " \u0301a\nb c"]:
        assert np.frombuffer(tokens.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    from barograph.llm.common import chunks, folded, word_hashes
    from barograph.llm.linededup import line_sets

    long = b"y" * 300
    texts = [b" A\x0bb \x1c c\xc2\xa0d ", b"", b"   ", b"\n x y z u v w v\n\r\nX", b"\xff E e\x00f", long + b" " + long.upper(), long[:-1]]
    column = pa.array([b"skipped", *texts], pa.binary()).slice(1)
    ((at, chunk),) = chunks(column)
    hashes, sizes = word_hashes(chunk)
    words = [folded(x) for x in texts]
    flat = [w for x in words for w in x]
    assert at == 0 and sizes.tolist() == [len(x) for x in words]
    assert len(set(hashes.tolist())) == len(set(flat)) == len(set(zip(hashes.tolist(), flat, strict=True)))
    found = line_sets(chunk, 5)
    assert (found.text.tolist(), found.place.tolist(), found.size.tolist()) == ([3], [1], [6])
    assert word_hashes(pa.array([], pa.string()))[0].size == 0


def test_words_of_all_kinds_have_the_vocabulary_s_ids(monkeypatch):
    """Simple words take a short way, many are remembered, and a special token is found wherever it is."""
    from barograph.llm import tokens as module

    tokens = Tokens()
    whole = tokens.tokenizer
    words = ["to", "be,", "To:", "ñandú", "ñandú!", "Ünïted?", "a1", "1a.", "don't", "e.\nThe", "it!!", "I;", ".", "日本", "²", "ª.",
             "straße,", "ſ", "K", "x" * 70, "x" * 70 + ".", "<", "|", "<|endoftext|>", "a<|endoftext|>b", "İx", "ı", "µ", "é\nè,"]
    rng = random.Random(4)
    monkeypatch.setattr(module, "WORDS", 6)
    for _ in range(200):
        text = " ".join(rng.choices(words, k=rng.randint(1, 9)))
        assert np.frombuffer(tokens.of(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    monkeypatch.undo()
    tokens = Tokens()
    tokens.of(" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{'z' * (i // 17576)}" for i in range(310_000)))
    assert len(tokens.words) > 300_000
