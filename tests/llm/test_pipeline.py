import hashlib
import math
import random
import re
from collections import Counter

import corpus_pipeline
from helpers import WORD, components, docs, odd_texts
from test_jaccard import corpus
from test_native import water

import __spark_entry__ as entry


def test_pipeline_stage_by_stage(spark, tmp_path):
    rng = random.Random(1)
    texts = corpus(7, n=40, cloud=20)
    langs = ["en" if t and len(t) > 30 else None for t in texts]
    start = docs(spark, texts, sources=[rng.choice("abc") for _ in texts], langs=langs)
    now, seen = start, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == start.columns
        seen[name] = now.collect()
    lettered = {i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in seen["language_id"]} == lettered
    unique = {r["doc_id"] for r in seen["exact_dedup"]}
    assert unique <= lettered and len(unique) == len({re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]) for i in lettered})
    assert {r["doc_id"] for r in seen["ngram_jaccard_join"]} <= unique
    mixed = [r["doc_id"] for r in seen["mixing"]]
    assert set(mixed) <= {r["doc_id"] for r in seen["ngram_jaccard_join"]}
    assert sorted(r["doc_id"] for r in seen["packing"] if r["piece"] == 0) == sorted(mixed)


def brute_mix(rows):
    """Copies of each (id, source, size), by the order of the ids' digests within a source."""
    total, copies = Counter(), {}
    for _, source, size in rows:
        total[source] += size
    targets = water(dict(total))
    for source in total:
        share, at = targets[source] / total[source], 0
        for i, _, size in sorted((r for r in rows if r[1] == source), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
            copies[i] = math.floor(share) + (at + size / 2 < (share - math.floor(share)) * total[source])
            at += size
    return copies


def test_pipeline_against_brute_force(spark, tmp_path):
    from chronolex.llm import langid

    rng = random.Random(2)
    texts = [t for t in corpus(11, n=40, cloud=20) if len(t or "") < 20_000]
    sources, langs = [rng.choice("abc") for _ in texts], ["en" if t and len(t) > 30 else None for t in texts]
    start = docs(spark, texts, sources=sources, langs=langs)
    start.write.parquet(str(tmp_path / "documents.parquet"))
    rejected = langid.fit(start).predict(texts)[2]
    left = [i for i in range(len(texts)) if not rejected[i]]
    seen = {}
    for i in left:  # ids rise, so the first of equal texts has the smallest
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    left = sorted(seen.values())
    near = components([texts[i] for i in left], 5, 80, 100)
    left = [i for k, i in enumerate(left) if near[k][1] == k]
    copies = brute_mix([(i, sources[i], len(WORD.findall(texts[i]))) for i in left])
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter({i: n for i, n in copies.items() if n})
    single = [i for i, n in copies.items() if n == 1]
    loads = Counter()
    for r in rows:
        loads[r["sequence_id"]] += r["length"]
    assert max(loads.values()) <= 1024
    packed = {r["doc_id"]: r["ids_crc32"] for r in rows if r["doc_id"] in single and r["length"] < 1024 and r["piece"] == 0}
    from chronolex.llm import packing

    want = {r["id"]: r["ids_crc32"] for r in packing.pieces(start.where(start["doc_id"].isin(single))).collect() if r["piece"] == 0}
    assert packed.items() <= want.items()


def test_run_is_registered(spark, tmp_path):
    docs(spark, odd_texts(), langs=["en"] * len(odd_texts())).write.parquet(str(tmp_path / "documents.parquet"))
    rows = entry.queries()["pipeline"](spark, str(tmp_path)).collect()
    assert rows and {"doc_id", "piece", "sequence_id"} <= set(rows[0].asDict())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "mixing", "packing"]
    assert {f"op{n}_" for n in range(1, 11)} == {f"{k.split('_')[0]}_" for k in entry.queries() if k.startswith("op")}
