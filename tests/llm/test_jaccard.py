import random

import numpy as np
import pytest
from helpers import SCHEMA, components, docs, odd_texts, shingles
from pyspark.sql import functions as F

from chronolex.llm import jaccard
from chronolex.llm.graph import components as graph_components
from chronolex.llm.shingles import sets


def corpus(seed, n=60, cloud=150):
    """Random texts, near copies at all distances, a passage that many share, exact copies, and a cloud larger than REGION."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=25)
    texts = []
    for _ in range(n):
        base = rng.choices(words, k=rng.randint(5, 120))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            copy = [w if rng.random() > rng.choice([0.005, 0.02, 0.05]) else rng.choice(words) for w in base]
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    for _ in range(100):
        texts.append(" ".join(rng.choices(words, k=rng.randint(10, 40)) + passage + rng.choices(words, k=rng.randint(0, 20))))
    base = rng.choices(words, k=80)
    for _ in range(cloud):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(80)] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += texts[:5] * 4 + odd_texts()
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("k", "num", "seed"), [(4, 85, 1), (5, 80, 2)])
def test_against_all_pairs(spark, k, num, seed):
    texts = corpus(seed)
    df = docs(spark, texts).withColumns({"key": F.lit(1), "id": F.lit(2), "n": F.lit(3)}).repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, k, num, 100).collect()}
    assert [got[i] for i in range(len(texts))] == components(texts, k, num, 100)


@pytest.mark.parametrize("gain", [jaccard.GAIN, 1e9])
def test_clouds_alone_lose_no_link(spark, monkeypatch, gain):
    """With tiny regions and blocks everything goes through dissolved regions and clouds, dealt by pivots where that pays, or always."""
    monkeypatch.setattr(jaccard, "REGION", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "GAIN", gain)
    texts = corpus(3, n=30, cloud=40)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs(spark, texts), 4, 85, 100).collect()}
    assert [got[i] for i in range(len(texts))] == [c for _, c in components(texts, 4, 85, 100)]


def test_large_regions_are_dissolved(spark, monkeypatch):
    """Without the look at chunks, shared passages make regions that are found to be large only when they meet."""
    monkeypatch.setattr(jaccard, "CHUNK_SHARED", 1 << 30)
    monkeypatch.setattr(jaccard, "REGION", 8)
    monkeypatch.setattr(jaccard, "MEET_ROWS", 64)
    texts = corpus(4, n=30, cloud=40)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs(spark, texts), 5, 80, 100).collect()}
    assert [got[i] for i in range(len(texts))] == [c for _, c in components(texts, 5, 80, 100)]


def test_edges(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA), 4, 85, 100).count() == 0
    rows = jaccard.jaccard_components(docs(spark, ["a b c d", "a b c d", None, "x"], ids=[4, 4, 2, None]), 4, 85, 100).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows if r["doc_id"] is not None) == [(2, 2), (4, 4), (4, 4)]
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]


def test_stage_keeps_the_smallest(spark):
    texts = corpus(5, n=20, cloud=10)
    df = docs(spark, texts)
    kept = sorted(r["doc_id"] for r in jaccard.stage(spark, df, "").collect())
    assert kept == sorted({c for _, c in components(texts, 5, 80, 100)})


def test_sets_match_words():
    texts = odd_texts()
    for k in (4, 5):
        found = sets(texts, k)
        for a, t in zip(found, texts):
            assert len(a) == len(shingles(t, k)) and (np.diff(a) > 0).all()
    assert sets(["a b C d"], 4)[0].tolist() == sets(["A\tb\x0bc  d\n"], 4)[0].tolist()


def test_sets_do_not_depend_on_chunks(monkeypatch):
    from chronolex.llm import shingles as sh

    whole = sets(odd_texts(), 4)
    monkeypatch.setattr(sh, "CHUNK", 1000)
    assert all((a == b).all() for a, b in zip(whole, sets(odd_texts(), 4)))


def test_windows_meet():
    """Any pair of sets at the threshold shares a pivot of both windows, in any order of pivots."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        n, share = int(rng.integers(1, 80)), int(rng.integers(1, 80))
        common = rng.integers(-(1 << 60), 1 << 60, share)
        x = np.unique(np.concatenate([common, rng.integers(-(1 << 60), 1 << 60, int(rng.integers(0, 1 + n // 6)))]))
        y = np.unique(np.concatenate([common, rng.integers(-(1 << 60), 1 << 60, int(rng.integers(0, 1 + n // 6)))]))
        moved = rng.integers(0, 256, 1 << 10, dtype=np.uint8)
        inter = len(np.intersect1d(x, y))
        if 100 * inter >= 85 * (len(x) + len(y) - inter):
            assert len(np.intersect1d(jaccard.first_pivots(x, moved, 85, 100), jaccard.first_pivots(y, moved, 85, 100)))
            assert 185 * jaccard.apart(jaccard.cells(x), jaccard.cells(y)) <= 15 * (len(x) + len(y))


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 301), (301, 302), (302, 300)]
    got = dict(graph_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300, 302: 300}
