"""Scores, rules, mixing and extraction on small fixtures."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from barograph.llm import html, mixing, quality, rules, scoring, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_lattice_is_the_sum_over_segmentations():
    pieces = scoring.Pieces(None)
    weight = dict(zip(pieces.texts, np.exp(pieces.log), strict=True))
    for word in (b"the", b"er", b"x", "né".encode()):
        text, total = b" " + word, 0.0
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
            total += math.prod(weight.get(text[a:b], 0.0) for a, b in itertools.pairwise(at))
        got, uses = pieces.lattice([word], np.ones(1), pieces.log)
        assert got[0] == pytest.approx(math.log(total))
        assert (uses * pieces.lengths).sum() == pytest.approx(len(text))
    assert np.exp(pieces.log).sum() == pytest.approx(1)


def test_lattice_scores(documents, odd):
    texts = {i: f"the word {'again ' * (i % 4)}Word{i % 9} number{i}" for i in range(60)} | {61: "", 62: None}
    got = {r.doc_id: r for r in scoring.lattice_scores(documents(texts)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    tokens = {i: (t or "").lower().split() + [None] for i, t in texts.items()}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known) == (held[i], len(ws), sum(count[w] > 0 for w in ws))
        assert r.train_tokens == n and r.score < 0
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
    assert scoring.lattice_scores(odd).count() == odd.count()
    assert scoring.lattice_scores(odd.limit(0)).count() == 0


def base_measures(text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.translate({c: " " for c in range(9, 14)}).strip(" ")]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_rules(documents, odd):
    good = " ".join(f"word{i}" for i in range(80))
    texts = {
        1: good, 2: "a b c " * 30, 3: "short", 4: good.upper(), 5: good.replace(" ", "*** "), 6: None, 7: "\n\n a \n a",
        8: "x y z x y z q " * 9, 9: good + "\nsame line\nsame line", 10: "\n".join(["one line of it"] * 20),
    }
    got = {r.doc_id: r for r in rules.quality_rules(documents(texts)).collect()}
    for i, text in texts.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_measures(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    kept = {i for i, r in got.items() if r.kept}
    assert kept == {1, 9}
    assert {r.doc_id for r in rules.keep_good(documents(texts)).collect()} == kept
    assert rules.quality_rules(odd).count() == odd.count() and rules.keep_good(odd).columns == odd.columns
    assert rules.quality_rules(odd.limit(0)).count() == 0 and rules.keep_good(odd.limit(0)).count() == 0


def test_rule_order_does_not_change_the_verdict(documents):
    checks = rules.rules(rules.Limits())
    docs = documents({1: "a b", 2: "WORD " * 60}).selectExpr("doc_id", "text AS __text")
    for order in (list(checks), list(checks)[::-1]):
        assert docs.where(rules.verdict(order, checks)).count() == 0


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_scores(spark, odd, module, label):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    run = getattr(module, f"{module.__name__.split('.')[-1]}_scores")
    got = run(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got["held_out"]]
    one, zero = held[held[label] == 1]["score"].to_numpy(), held[held[label] == 0]["score"].to_numpy()
    assert (one[:, None] > zero).mean() > 0.95
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.3)).all()
    assert run(odd, labels.limit(0)).toPandas()["score"].tolist() == pytest.approx([0.5] * odd.count(), abs=1e-3)
    assert run(odd.limit(0), labels).count() == 0


def test_mixing_meets_targets(spark, odd):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows, report = mixing.with_rates(docs, labels, mixing.Mixing(close=0.01, steps=60))
    sums = rows.selectExpr("sum(__rate * __tokens * __members[0]) a", "sum(__rate * __tokens * __members[1]) b",
                           "min(__rate) r").first()
    report = {r.domain: r for r in report.collect()}
    most = max(r.target for r in report.values())
    assert sums.r >= 0 and abs(sums.a - report["clean"].target) < 0.02 * most
    assert abs(sums.b - report["low"].target) < 0.05 * most
    assert mixing.mixed(odd, labels).columns == odd.columns
    assert mixing.document_rates(odd, labels.limit(0)).count() == odd.count()
    assert mixing.mixed(odd.limit(0), labels).count() == 0


PAGE = """<html><head><title>T</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="ad">Buy this.</div><article><h1>Big &amp; bold</h1><p>First <b>words</b>
 here.<p>Second&nbsp;one.<br></article><div class="comments"><p>Nice article, thank you so much.</p></div>
<footer>&copy; site</footer></body>"""


def members_of(spark, rows):
    schema = "__tokens long, __members array<double>"
    return spark.createDataFrame([(n, [float(v) for v in p]) for n, p in rows], schema)


@pytest.mark.parametrize("words", [100_000, 1_000_000])
def test_mixing_meets_all_targets_beside_very_long_documents(spark, words):
    sure = 0.005 + 0.985 * np.eye(3)
    rows = [(40 + i % 300, sure[i % 3]) for i in range(900)] + [(words, sure[0])] * 3
    _, target, totals = mixing.rates(members_of(spark, rows), mixing.Mixing())
    assert totals == pytest.approx(target, rel=1e-3)
    start = sum(n * np.array(p) for n, p in rows)
    assert target == pytest.approx(start * (1.0, 0.5, 0.25))


def test_mixing_drops_and_multiplies_documents(spark):
    rng = np.random.default_rng(2)
    rows = [(int(n), p) for n, p in zip(rng.integers(1, 5_000, 300), rng.dirichlet((0.3, 0.3, 0.3), 300), strict=True)]
    start = sum(n * p for n, p in rows)
    want = tuple(start * (1.6, 0.9, 0.1))
    made = members_of(spark, [*rows, (0, (0.2, 0.3, 0.5))])
    rate, _, totals = mixing.rates(made, mixing.Mixing(totals=want))
    assert totals == pytest.approx(want, rel=1e-3)
    got = made.select("__tokens", "__members", rate.alias("rate")).collect()
    assert sum(r.rate * r["__tokens"] * np.array(r["__members"]) for r in got) == pytest.approx(want, rel=1e-3)
    assert min(r.rate for r in got) == 0 and [r.rate for r in got if not r["__tokens"]] == [1]


def test_mixing_says_when_no_rates_reach_the_targets(spark):
    p, want = np.array((0.5, 0.3, 0.2)), np.array((900.0, 100.0, 50.0))
    with pytest.warns(UserWarning, match="no rates reach"):
        _, _, totals = mixing.rates(members_of(spark, [(100, p)] * 20), mixing.Mixing(totals=tuple(want)))
    assert totals == pytest.approx(p * (p @ want) / (p @ p), rel=1e-2)


def test_main_text(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "<script>x</script"), (4, "u", "<<<a <p>&lt;"), (1, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html.main_texts(pages).collect()
    want = "Big & bold\nFirst words here.\nSecond one."
    assert [r.text for r in got if r.page_id == 1] == [want] * 2
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == 6
    assert [r.text for r in got if r.page_id in (2, 3, None)] == [""] * 3
    assert html.main_texts(pages.limit(0)).count() == 0


def test_marginals_by_enumeration():
    page = html.Page("<div><p>Some text.</p><ul><li>x</li></ul></div>")
    forest = html.Forest([page], [page.features()])
    unary, pair = html.prior()
    n, total, one = len(page.tags), 0.0, np.zeros(len(page.tags))
    for labels in itertools.product([0, 1], repeat=n):
        w = sum(forest.x[i] @ unary for i in range(n) if labels[i])
        w += sum(pair[forest.kind[i], labels[page.parent[i]], labels[i]] for i in range(1, n))
        total += math.exp(w)
        one += math.exp(w) * np.array(labels)
    assert forest.marginals(unary, pair)[0][:, 1] == pytest.approx(one / total)


def test_gradients_of_the_recurrent_network():
    t = toxicity.Toxicity(words=64, grams=64, width=3, hidden=2, steps=4, stride=3)
    net = toxicity.Network(t)
    net.params = [p.astype(np.float64) for p in net.params]
    v = toxicity.Vocabulary([b"one two three four five", b"two six"], t)
    rows = np.concatenate([toxicity.windows(p, 4, 3) for p in v.places])
    labels, x = np.array([1.0, 0, 1][: len(rows)]), net.inputs(v).astype(np.float64)

    def loss():
        z = net.forward(net.gates(x), rows)
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    dx, grads = net.gradients(x, rows, labels)
    for p, g in [(x, dx), *zip(net.params[2:], grads, strict=True)]:
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        p[at] += 1e-3
        up = loss()
        p[at] -= 2e-3
        assert (up - loss()) / 2e-3 == pytest.approx(g[at], rel=2e-2, abs=1e-5)
        p[at] += 1e-3


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        assert out.count() > 0 and set(r.doc_id for r in out.collect()) <= set(r.doc_id for r in docs.collect())
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).toPandas()
    assert set(packed["doc_id"]) == set(r.doc_id for r in docs.collect())
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_quality_vectors_pooling_and_gradients_equal_plain_loops(documents):
    """Random indexing, pooling and the network's training step, written out word by word."""
    q = quality.Quality(buckets=64, width=8)
    texts = ["alpha beta gamma beta!", "", "beta alpha delta " * 20, "gamma\nbeta, Alpha", "x"]
    rows = documents(list(enumerate(texts))).select(quality.as_bytes().alias("text")).repartition(3)
    vectors = quality.word_vectors(rows, q)
    buckets, index = quality.Buckets(64), quality.index_vectors(64, 8, q.seed)
    ids = [buckets.of(quality.PARTS.findall(t.encode())).tolist() for t in texts]
    total = np.zeros((64, 8))
    for one in ids:
        for i, word in enumerate(one):
            for j in range(max(0, i - 2), min(len(one), i + 3)):
                if j != i:
                    total[word] += index[one[j]]
    used = total.any(axis=1)
    total[used] -= total.sum(axis=0) / used.sum()
    want = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    np.testing.assert_allclose(vectors, want, atol=1e-5)
    for one in ids:
        mean = [sum(vectors[w][k] for w in one) / len(one) if one else 0 for k in range(8)]
        steps = [
            sum(abs(vectors[b][k] - vectors[a][k]) for a, b in zip(one, one[1:])) / (len(one) - 1) if len(one) > 1 else 0
            for k in range(8)
        ]
        plain = [*mean, *steps, 1 / len(one) if one else 0]
        np.testing.assert_allclose(quality.pooled(np.array(one, int), vectors), plain, atol=1e-5)


def test_quality_scores_do_not_depend_on_partitions(spark, documents):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(words[: 30 + 30 * (i % 2)], 40))) for i in range(240)] + [(3, "other text"), (3, None)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(240)], "doc_id long, quality int, toxic int")
    q, found = quality.Quality(epochs=5), []
    for parts in (1, 5):
        docs = documents(rows if parts == 1 else rows[::-1]).repartition(parts)
        got = quality.quality_scores(docs, labels.repartition(parts), q).collect()
        found.append(sorted((r.doc_id, r.score, r.predicted) for r in got))
    assert found[0] == found[1]
