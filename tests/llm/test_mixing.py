import numpy as np
import pytest

from spanloom.llm import mixing, tokenizer


def test_tree_is_exact_and_even():
    rng = np.random.default_rng(1)
    counts = np.array([1000, 10, 0, 333])
    out = mixing.splitting_tree(counts, 13, rng)
    assert (out.sum(0) == counts).all() and (out >= 0).all()
    assert out.sum(1).max() - out.sum(1).min() <= 8
    mean = np.mean([mixing.splitting_tree(counts, 4, rng)[0] for _ in range(400)], 0)
    assert np.allclose(mean, counts / 4, rtol=0.1, atol=0.6)


def test_tree_in_two_levels():
    counts = np.array([100_000, 7, 33_333])
    groups = mixing.splitting_tree(counts, 1000, np.random.default_rng(1), 64)
    assert groups.shape == (16, 3) and (groups.sum(0) == counts).all()
    sizes = groups.sum(1)
    assert sizes[:15].max() - sizes[:15].min() <= 8 and abs(sizes[15] / sizes[0] - 40 / 64) < 0.01


def test_a_hundred_thousand_shards():
    counts = np.array([10**7, 10**6, 3])
    groups = mixing.splitting_tree(counts, 100_000, np.random.default_rng(1), mixing.GROUP_SHARDS)
    assert (groups.sum(0) == counts).all() and (groups >= 0).all()
    own = mixing.splitting_tree(groups[5], mixing.GROUP_SHARDS, np.random.default_rng([1, 5]))
    assert (own.sum(0) == groups[5]).all() and abs(own.sum(1) - 110).max() <= 8


@pytest.mark.parametrize("good,bad,draws", [(40, 60, 30), (5, 500, 200), (3000, 2000, 2500)])
def test_rejection_draws_the_same_distribution(good, bad, draws):
    rng = np.random.default_rng(4)
    a = np.array([mixing.rejected_hypergeometric(rng, good, bad, draws) for _ in range(20_000)])
    b = rng.hypergeometric(good, bad, draws, 20_000)
    edges = np.unique(np.quantile(b, np.linspace(0, 1, 9)))
    x, y = (np.histogram(v, edges)[0] for v in (a, b))
    assert ((x - y) ** 2 / np.maximum(x + y, 1)).sum() < 30  # chi squared of at most 8 bins


def test_rejection_at_sizes_beyond_the_library():
    rng = np.random.default_rng(4)
    got = np.array([mixing._hypergeometric(rng, 4 * 10**10, 6 * 10**10, 10**10) for _ in range(3000)], float)
    deviation = np.sqrt(1e10 * 0.4 * 0.6 * 0.9)
    assert abs(got.mean() - 4e9) < 5 * deviation / np.sqrt(3000) and abs(got.std() / deviation - 1) < 0.06
    assert mixing._hypergeometric(rng, 2 * 10**9, 1, 2 * 10**9 + 1) == 2 * 10**9


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(3)
    words = "river stone meadow clock lantern harbour".split()
    docs = [(i, s, " ".join(rng.choice(words, rng.integers(5, 60)))) for i, s in enumerate(["big"] * 900 + ["small"] * 40 + ["other"] * 30)]
    docs += [(2000, "big", None), (2001, "small", ""), (2002, None, "river"), (2003, "small", docs[900][2])]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, source string, text string, repeat int, tokens int")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.4, 3), ("gone", 0.1, 5)], "source string, target_share double, max_repeats int")
    return df, targets


@pytest.mark.parametrize("shard", [10**9, 700])
def test_shares_and_repeats(spark, corpus, monkeypatch, shard):
    monkeypatch.setattr(mixing, "GROUP_SHARDS", 3)
    df, targets = corpus
    mixed = mixing.mix(df, targets, shard_tokens=shard)
    got = mixed.collect()
    tokens = {(r["doc_id"]): r["tokens"] for r in tokenizer.token_counts(df, ["doc_id"]).collect()}
    assert all(tokens[r["doc_id"]] == r["tokens"] > 0 for r in got)
    assert len({(r["doc_id"], r["repeat"]) for r in got}) == len(got)
    assert len({(r["shard"], r["place"]) for r in got}) == len(got)
    uses = {}
    for r in got:
        uses[r["doc_id"]] = uses.get(r["doc_id"], 0) + 1
    small = {i for i in uses if 900 <= i < 940 or i == 2003}
    assert len(small) == 41 and all(uses[i] == 3 for i in small) and max(uses.values()) == 3
    report = {r["source"]: r for r in mixing.reached(mixed, targets).collect()}
    assert abs(report["big"]["actual_share"] - 5 / 9) < 0.01 and abs(report["small"]["actual_share"] - 4 / 9) < 0.01
    assert report["gone"]["tokens"] == 0
    if shard == 700:
        sizes = np.bincount([r["shard"] for r in got], [r["tokens"] for r in got])
        assert len(sizes) > 5


def test_total_and_empty(corpus):
    df, targets = corpus
    with pytest.raises(ValueError):
        mixing.mix(df, targets, total=10**9)
    part = mixing.mix(df, targets, total=3000).collect()
    assert abs(sum(r["tokens"] for r in part) - 3000) < 200 and max(r["repeat"] for r in part) == 0
    assert mixing.mix(df.limit(0), targets).count() == 0


def test_cut_within_many_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCHES", 2)
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 4)
    df, targets = corpus
    for total in (3000, 9000):
        got = mixing.mix(df, targets, total=total).collect()
        by = {}
        for r in got:
            by[r["source"]] = by.get(r["source"], 0) + r["tokens"]
        assert abs(by["big"] - total * 5 / 9) <= 60 and abs(by["small"] - total * 4 / 9) <= 60
