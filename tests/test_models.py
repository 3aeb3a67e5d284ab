import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolex.functions import codec, tokens
from chronolex.operators import embeddings as emb
from chronolex.operators import evaluation, progress, training
from chronolex.operators import ngrams as ops
from chronolex.operators import regression as reg
from chronolex.sources import models as src

NAMES = ["w2v_y1990_wbnone_vs004_w002_mc001_sg1_e003.kv", "w2v_y1991_wbnone_vs004_w002_mc001_sg0_e003.kv"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(n, f"w{i}", rng.normal(size=4).round(3).tolist()) for n in NAMES for i in range(30)]
    return spark.createDataFrame(rows, "model string, word string, vector array<double>")


def test_vectors_are_saved_and_loaded(spark, vectors, tmp_path):
    path = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        src.load_vectors(spark, path)
    src.save_vectors(vectors, path)
    back = src.load_vectors(spark, path, NAMES[1])
    assert back.count() == 30 and set(map(tuple, back.select("year", "approach", "epochs").distinct().collect())) == {(1991, "CBOW", 3)}
    assert "PartitionFilters: [isnotnull(model" in back._jdf.queryExecution().toString()
    with pytest.raises(FileNotFoundError):
        src.load_vectors(spark, path, "w2v_y1.kv")
    with pytest.raises(ValueError):
        src.save_vectors(vectors.where("false"), path)
    src.write_vector_text(vectors.where(F.col("model") == NAMES[0]), str(tmp_path / "t"))
    text = {r["word"]: r["vector"] for r in src.read_vector_text(spark, str(tmp_path / "t")).collect()}
    assert len(text) == 30 and all(len(v) == 4 for v in text.values())


def test_gold_sets(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("# note\nTiger\tcat\t7.35\nbad line\nx\ty\tz\n")
    assert [tuple(r) for r in src.similarity_pairs(spark, str(tmp_path / "s.tsv")).collect()] == [("tiger", "cat", 7.35)]
    (tmp_path / "a.txt").write_text(": capitals\nAthens Greece Oslo Norway\n\n: family\nboy girl he she\nshort line\n")
    assert [tuple(r) for r in src.analogies(spark, str(tmp_path / "a.txt")).collect()] == [("capitals", "athens", "greece", "oslo", "norway"), ("family", "boy", "girl", "he", "she")]


def test_all_models_are_evaluated_once(spark, vectors, tmp_path):
    path, out = str(tmp_path / "v"), str(tmp_path / "results")
    src.save_vectors(vectors.where(F.col("model") == NAMES[0]), path)
    pairs = spark.createDataFrame([(f"w{i}", f"w{i + 7}", float(i % 5)) for i in range(20)], "w1 string, w2 string, score double")
    questions = spark.createDataFrame([("s", f"w{i}", f"w{i + 1}", f"w{i + 2}", f"w{i + 3}") for i in range(9)], "section string, a string, b string, c string, d string")
    assert evaluation.evaluate_models(spark, path, out, pairs) == 1
    src.save_vectors(vectors.where(F.col("model") == NAMES[1]), path)
    assert evaluation.evaluate_models(spark, path, out, pairs, questions) == 1
    assert evaluation.evaluate_models(spark, path, out, pairs, questions) == 0
    rows = {r["model"]: r for r in src.read_results(spark, out).collect()}
    assert rows[NAMES[0]]["analogy_score"] is None and -1 <= rows[NAMES[0]]["similarity_score"] <= 1 and 0 <= rows[NAMES[1]]["analogy_score"] <= 1
    assert (rows[NAMES[1]]["year"], rows[NAMES[1]]["approach"], rows[NAMES[1]]["vector_size"]) == (1991, "CBOW", 4)
    assert evaluation.evaluate_models(spark, path, out, pairs, mode="overwrite") == 2 and src.read_results(spark, out).count() == 2


def test_training_modes(spark, vectors, tmp_path):
    path = str(tmp_path / "v")
    src.save_vectors(vectors, path)
    assert [tuple(r) for r in src.saved_models(spark, path).select("model", "valid").orderBy("model").collect()] == [(n, True) for n in NAMES]
    saved = src.saved_models(spark, path).withColumn("valid", F.col("model") == NAMES[0])
    wanted = training.grid(spark, [1990, 1991, 1992], weight_by=["none"], vector_size=[4], window=[2], min_count=[1], approach=["skip-gram"], epochs=[3])
    left, gone = training.to_train(wanted, saved)
    assert sorted(r["year"] for r in left.collect()) == [1991, 1992] and [r[0] for r in gone.collect()] == [NAMES[1]]
    left, gone = training.to_train(wanted, saved, "restart")
    assert left.count() == 3 and gone.count() == 2
    with pytest.raises(FileExistsError):
        training.to_train(wanted, saved, "new")
    assert training.to_train(wanted, saved.where("false"), "new")[0].count() == 3
    with pytest.raises(ValueError):
        training.to_train(wanted, saved, "other")
    assert training.model_folders("/d/NLP_corpora/x/5gram_files/", "t") == ("/d/NLP_corpora/x/5gram_files/5grams_pivoted.db", "/d/NLP_models/x/5gram_files/models_t", "/d/NLP_models/x/5gram_files/logs_t/training")
    with pytest.raises(ValueError):
        training.model_folders("/d/x/5gram_files", "t")


def test_training_with_unknown_words(spark):
    corpus = spark.createDataFrame([(1990, t.split(), 1) for t in ("a b c", "a <UNK> b", "<UNK> c", "b c d")], "year int, tokens array<string>, weight long")
    wanted = training.grid(spark, [1990], weight_by=["none"], vector_size=[4], window=[2], min_count=[1], approach=["CBOW"], epochs=[2])
    words = lambda unk: {r["word"] for r in training.train(corpus, wanted, unk=unk).collect()}
    assert words("reject") == words("strip") == {"a", "b", "c", "d"} and words("retain") == {"a", "b", "c", "d", "<UNK>"}
    losses = []
    rng = np.random.default_rng(2)
    sentences = [np.array([g * 5 + x for x in rng.integers(0, 5, 8)]) for g in (0, 1) for _ in range(60)]
    training.train_one(sentences, np.ones(120), np.full(10, 96.0), 8, 3, 12, True, rate=0.005, losses=losses)
    assert len(losses) == 12 and losses[-1] < losses[0]


def test_weat_series_exact_and_pairwise(spark):
    rng = np.random.default_rng(4)
    words = [(s, f"{s}{i}") for s, n in (("T1", 3), ("T2", 3), ("A1", 2), ("A2", 2)) for i in range(n)]
    models = spark.createDataFrame([(y, w, rng.normal(size=5).tolist()) for y in (2000, 2001) for _, w in words], "year int, word string, vector array<double>")
    sets = spark.createDataFrame(words, "set string, word string")
    exact = {r["year"]: r["p"] for r in emb.weat_p_values(models, sets, None, seed=0).collect()}
    drawn = {r["year"]: r["p"] for r in emb.weat_p_values(models, sets, 4000, seed=1).collect()}
    assert all(p * 20 == pytest.approx(round(p * 20)) and abs(p - drawn[y]) < 0.05 for y, p in exact.items())
    pair = {r["year"]: r["p"] for r in emb.weat_pairwise_p_values(models, sets, None, seed=0).collect()}
    assert all(0 < p <= 1 and abs(p - q["p"]) < 0.05 for q in emb.weat_pairwise_p_values(models, sets, 4000, seed=1).collect() for p in [pair[q["year"]]])
    assert [r["p"] for r in emb.weat_p_values(models.where("year = 2000"), sets, 0, seed=0).collect()][0] is None or math.isnan(emb.weat_p_values(models.where("year = 2000"), sets, 0, seed=0).first()["p"])
    flat = models.unionByName(spark.createDataFrame([(2002, w, [1.0, 0.0, 0.0, 0.0, 0.0]) for _, w in words], "year int, word string, vector array<double>"))
    rows = {r["year"]: r for r in emb.weat_series(flat, sets).collect()}
    assert rows[2002]["effect"] is None and rows[2002]["band"] == pytest.approx((rows[2000]["band"] + rows[2001]["band"]) / 2)


def test_alignment_verdicts_and_shared_vocabulary(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 4))
    turn, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    rows = [(y, f"w{i}", (x[i] if y == 2000 else x[i] @ turn).tolist()) for y in (2000, 2001) for i in range(30 if y == 2000 else 20)]
    models = spark.createDataFrame(rows, "year int, word string, vector array<double>")
    before = {r["year"]: r for r in emb.alignment_quality(models, 2000).collect()}
    assert before[2001]["verdict"] == "significant" and before[2000]["verdict"] == "minimal" and before[2000]["identical"] and not before[2001]["aligned"]
    for vocabulary, n in (("anchor", 50), ("all", 40)):
        turned = emb.aligned(models, 2000, vocabulary)
        assert turned.count() == n and all(r["aligned"] and r["verdict"] == "minimal" for r in emb.alignment_quality(turned, 2000).collect())


def test_analogies_against_brute_force(spark):
    rng = np.random.default_rng(7)
    table = {y: {f"w{i}": rng.normal(size=6) for i in range(40)} for y in (1, 2)}
    models = spark.createDataFrame([(y, w, v.tolist()) for y, t in table.items() for w, v in t.items()], "year int, word string, vector array<double>").repartition(5)
    asked = [(f"w{i}", f"w{i + 3}", f"w{(i * 7) % 40}", f"w{(i * 11) % 40}") for i in range(30)] + [("w0", "w1", "w2", "nowhere")]
    got = {r["year"]: (r["accuracy"], r["questions"]) for r in emb.analogy_accuracy(models, spark.createDataFrame([("s", *q) for q in asked], "section string, a string, b string, c string, d string")).collect()}
    for y, t in table.items():
        unit = {w: v / np.linalg.norm(v) for w, v in t.items()}
        known = [q for q in asked if all(w in unit for w in q)]
        hits = [max((w for w in unit if w not in (a, b, c)), key=lambda w: (round(float(unit[w] @ (unit[b] - unit[a] + unit[c])), 9), w)) == d for a, b, c, d in known]
        assert got[y] == (pytest.approx(np.mean(hits)), len(known))


def test_mixed_model_falls_back(spark):
    rng = np.random.default_rng(3)
    rows = [(float(2 + 3 * x + g + rng.normal() * 0.1), float(x), g) for g in range(6) for x in rng.normal(size=8)]
    table, names = reg.design(spark.createDataFrame(rows, "y double, x double, g int"), "y", ["x"], [], standardise=False, keep=("g",))
    kind, fit = reg.fitted(table, names, "g")
    assert kind == "mixed" and fit.coefficients[1] == pytest.approx(3, abs=0.1) and fit.group_variance > 1
    assert reg.fitted(table, names, None)[0] == "ols"
    few, names = reg.design(spark.createDataFrame(rows[:2], "y double, x double, g int"), "y", ["x"], [], standardise=False, keep=("g",))
    assert reg.fitted(few, names, "g")[0] == "ols"  # as many terms as rows


def test_progress(spark):
    units = spark.createDataFrame([("a", "pending", None, None), ("b", "processing", "w1", "a"), ("c", "processing", "w1", "a"), ("d", "completed", None, None), ("e", "failed", None, None)], "unit_id string, status string, claimed_by string, parent_id string")
    assert tuple(progress.status_counts(units).first()) == (0, 2, 1, 1, 1, 1)
    empty = spark.createDataFrame([], "bytes long, error string")
    assert tuple(progress.throughput(empty, 0.0).first()) == (0, 0, 0.0, 0.0, 0.0)
    assert spark.range(1).select(progress.ratio(F.lit(1), F.lit(0))).first()[0] == 0.0


def test_readable_keys_and_values(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    key, value = F.unhex(F.lit("000007D071")), codec.stats_value(F.lit(1234), F.lit(56))
    assert one(codec.format_key(key)) == one(codec.format_key(key, "pivot")) == "[2000] q" and one(codec.format_key(key, "hex")) == "000007d071"
    assert one(codec.format_key(F.encode(F.lit("the cat"), "UTF-8"))) == "the cat" and one(codec.format_key(F.unhex(F.lit("01")), "pivot")) == "<invalid pivot key: 1 bytes>"
    assert one(codec.format_key(F.unhex(F.lit("FF" * 21)))) == "<binary: " + "ff" * 20 + "...>"
    assert one(codec.format_value(value)) == "1,234 occurrences in 56 documents"
    assert one(codec.format_value(F.unhex(F.lit("00")))) == "<unknown format: 1 bytes>" and one(codec.format_value(F.unhex(F.lit("")), "summary")) == "No data"
    packed = codec.pack_records(F.array(F.struct(F.lit(2000).alias("year"), F.lit(5).alias("match_count"), F.lit(2).alias("volume_count"))))
    assert one(codec.format_value(packed, "packed")) == "(2000, 5, 2)" and one(codec.format_value(packed)) == "Total: 5 occurrences in 2 volumes (2000-2000, 1 years)"
    assert one(F.hex(codec.parsed_key(F.lit("[2000] q")))) == "000007D071" and one(F.hex(codec.parsed_key(F.lit("[2000]")))) == "000007D0" and one(F.hex(codec.parsed_key(F.lit("q")))) == "0000000071"
    assert one(codec.format_rate(F.lit(10000), F.lit(2.5), "records")) == "4,000 records/sec" and one(codec.format_rate(F.lit(1), F.lit(0.0))) == "0 items/sec"
    assert one(codec.format_percentage(F.lit(75), F.lit(100))) == "75.0%" and one(codec.format_elapsed(F.lit(3725))) == "1:02:05"
    assert one(codec.shorten_path(F.lit("/very/long/path/to/file.db"), 13)) == "...to/file.db"
    for f in (codec.format_key, codec.format_value):
        with pytest.raises(ValueError):
            f(key, "other")
    bad = spark.createDataFrame([(b"123",), (bytes(24),)], "x binary").select(codec.unpack_whole_records("x").alias("r"))
    assert [r[0] is None for r in bad.collect()] == [True, False]


def test_bounds_and_units(spark):
    keys = spark.range(100).select(F.format_string("k%03d", "id").alias("ngram")).repartition(7)
    assert [r["key"] for r in ops.density_bounds(keys, 4).orderBy("part").collect()] == ["k025", "k050", "k075"]
    assert ops.bounds(keys, 4).count() == 3 and [bytes(r["key"]) for r in ops.bounds(keys, 2).collect()] == [b"\x80"]
    assert len({ops.unit_name(None, b"a"), ops.unit_name(b"a", None), ops.unit_name(b"a", b"b")}) == 3
    assert ops.midpoint(b"\x40", b"\x80") == b"\x60" and ops.midpoint(None, None) == b"\x80" and b"a" < ops.midpoint(b"a", b"b") < b"b"
    assert ops.midpoint(b"a", b"a\x00") is None and ops.midpoint(b"b", b"a") is None
    assert [r[0] for r in ops.vocabulary_index(keys.unionByName(keys)).limit(2).collect()] == ["k000", "k001"]


def test_dictionaries_by_language(spark):
    words = spark.createDataFrame([("cat",), ("a1",), ("dog",)], "ngram string")
    dictionary = spark.createDataFrame([("en", "cat"), ("de", "hund"), ("en", "a1")], "lang string, word string")
    assert [r[0] for r in ops.spelled(words, dictionary, language="en").collect()] == ["cat"]
    assert ops.spelled(words, None).count() == 3
    with pytest.raises(ValueError):
        ops.spelled(words, dictionary, language="xx")


def test_rules_are_checked_and_lemmas_fall_back(spark, monkeypatch):
    for bad in ({"lower": 1}, {"min_bytes": True}, {"stop_words": ["a"]}, {"stop_words": (1,)}):
        with pytest.raises(TypeError):
            tokens.TokenRules(**bad)
    assert tokens.lemma_model("de") == "de_core_news_sm"
    with pytest.raises(ValueError):
        tokens.lemma_model("xx")
    rules = tokens.TokenRules()
    rows = ["dogs_NOUN running_VERB fast", "was_VERB classes_NOUN boxes_NOUN studies_VERB talked_VERB cities_NOUN glass", "ab _NOUN"]
    ngrams = spark.createDataFrame([(x,) for x in rows], "ngram string")
    lemmas = spark.createDataFrame([("was", "VERB", "being")], "token string, pos string, lemma string")
    want = {rows[0]: "dog run fast", rows[1]: "being class box study talk city glass", rows[2]: "<UNK> <UNK>"}
    del want[rows[2]]
    for limit in (tokens.BROADCAST_ROWS, 0):
        monkeypatch.setattr(tokens, "BROADCAST_ROWS", limit)
        got = tokens.normalise_with_tables(ngrams, rules, lemmas=lemmas, fallback=tokens.plain_english)
        assert {r["ngram"]: r["normalised"] for r in got.collect()} == want


def test_patterns_agree_with_the_rules_one_by_one(spark):
    """The patterns over a whole n-gram against split, strip, lower-case and test of every token."""
    import random

    rng = random.Random(3)
    bits = ["cat", "The", "_NOUN", "a_NOUN", "x_VERB_ADJ", "éa", "ß", "中", "ab", "don't", "of", "1984_NUM", "b_.", "<UNK>", "💥", "Élan_NOUN", "𝔸", "zz__X", "NOUN", "a_b_VERB", "", "", "\t", "é"]
    rows = list({" ".join(rng.choice(bits) for _ in range(rng.randint(1, 5))) for _ in range(1500)})
    df = spark.createDataFrame([(x,) for x in rows], "ngram string")
    for rules in (tokens.TokenRules(stop_words=("cat", "of")), tokens.TokenRules(alpha=False, short=False, stop=False), tokens.TokenRules(alpha=False, min_bytes=4), tokens.TokenRules(lower=False, min_bytes=2, stop_words=("The",)), tokens.TokenRules(min_bytes=6, unicode_lower=True)):
        each = F.transform(tokens.split_tokens(F.col("ngram")), lambda t: tokens.lowered(tokens.bare(t), rules))
        kept = F.transform(each, lambda t: F.struct(tokens.accepted(t, rules).alias("ok"), t.alias("t")))
        want = F.when(F.exists(kept, lambda x: x["ok"]), F.concat_ws(" ", F.transform(kept, lambda x: F.when(x["ok"], x["t"]).otherwise(F.lit(tokens.UNK)))))
        for r in df.select("ngram", tokens.normalise(F.col("ngram"), rules).alias("got"), want.alias("want")).collect():
            assert r["got"] == r["want"], (r["ngram"], rules)
