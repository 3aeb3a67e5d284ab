import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolex.functions import codec
from chronolex.operators import embeddings as emb
from chronolex.operators import ngrams as ops
from chronolex.operators import regression as reg
from chronolex.operators import series as ser
from chronolex.operators import training


def test_codec(spark):
    df = spark.createDataFrame([(1958, "the cat", 5, 2**40)], "year int, ngram string, m long, v long")
    key, value = codec.year_key(F.col("year"), F.col("ngram")), codec.stats_value(F.col("m"), F.col("v"))
    row = df.select(F.hex(key), codec.key_ngram(key), codec.key_year(key), codec.value_number(value, 0), codec.value_number(value, 1), F.octet_length(value)).first()
    assert tuple(row) == ("000007A674686520636174", "the cat", 1958, 5, 2**40, 16)
    bad = spark.createDataFrame([(b"123",)], "x binary")
    with pytest.raises(Exception, match="records"):
        bad.select(codec.unpack_records("x")).collect()


def test_formats(spark):
    df = spark.createDataFrame([(1024,), (1536000,), (5368709120,)], "n long")
    assert [r[0] for r in df.orderBy("n").select(codec.format_bytes(F.col("n"))).collect()] == ["1.00 KB", "1.46 MB", "5.00 GB"]


def test_format_bytes_rounds_as_printf_and_stops_at_the_largest_unit(spark):
    sizes = [None, 0, 1023, 1024 + 128, 1024 + 640, 2**20 - 1, 3 * 2**30 + 2**27, 2**40, 1009038190449744901, 2**63 - 1]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n long")

    def text(n, units):
        for power in range(len(units), 0, -1):
            if n is not None and n >= 1024**power:
                return f"{n / 1024.0**power:.2f} {units[power - 1]}"
        return n if n is None else f"{n} B"

    got = df.orderBy("i").select(codec.format_bytes(F.col("n")), codec.format_bytes(F.col("n"), "GB"), codec.format_bytes(F.col("n"), "KB")).collect()
    assert [tuple(r) for r in got] == [(text(n, ["KB", "MB", "GB", "TB"]), text(n, ["KB", "MB", "GB"]), text(n, ["KB"])) for n in sizes]


def test_coverage(spark):
    rows = [("x", y, 0, 0) for y in (2000, 2001, 2002, 2005)] + [("y", y, 1, 1) for y in (2000, 2002)]
    df = spark.createDataFrame(rows, "ngram string, year int, match_count long, volume_count long")
    assert [r[0] for r in ops.covered(df, 2000, 2002).collect()] == ["x"]
    assert ops.uniform_bounds(4) == [b"\x40", b"\x80", b"\xc0"]
    assert ops.top_k(ops.total_matches(df), 0).count() == 0


def test_weat(spark):
    vectors = {"a1": (1.0, 0.0), "a2": (0.0, 1.0), "p": (1.0, 0.0), "q": (0.6, 0.8), "r": (0.0, 1.0), "s": (0.8, 0.6)}
    models = spark.createDataFrame([(2000, w, list(v)) for w, v in vectors.items()], "year int, word string, vector array<double>")
    sets = spark.createDataFrame([("T1", "p"), ("T1", "q"), ("T2", "r"), ("T2", "s"), ("A1", "a1"), ("A2", "a2")], "set string, word string")
    assert emb.weat(models, sets).first()["effect"] == pytest.approx(0.8 / math.sqrt(2.08 / 3))
    p = emb.weat_p_values(models, sets, 300, seed=1).first()["p"]
    assert 0 <= p <= 1 and p == emb.weat_p_values(models, sets, 300, seed=1).first()["p"]


def test_procrustes_recovers_a_rotation(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    rows = [(y, f"w{i}", (x[i] if y == 2000 else x[i] @ turn).tolist()) for y in (2000, 2001) for i in range(40)]
    models = spark.createDataFrame(rows, "year int, word string, vector array<double>")
    out = {r["word"]: np.array(r["vector"]) for r in emb.aligned(models, 2000).where("year = 2001").collect()}
    assert max(np.abs(out[f"w{i}"] - x[i]).max() for i in range(40)) < 1e-9
    assert all(r["aligned"] for r in emb.alignment_quality(emb.aligned(models, 2000), 2000).collect())
    with pytest.raises(ValueError):
        emb.rotations(models.where("year = 2001").unionByName(models.where("year = 2000").withColumn("word", F.concat(F.lit("z"), "word"))), 2000)


def test_drift_errors(spark):
    n = 100
    s = [0.9 + (0.1 if i % 2 else -0.1) for i in range(n)]
    rows = [(2000, f"w{i}", [1.0]) for i in range(n)] + [(2002, f"w{i}", [s[i]]) for i in range(n)]
    models = spark.createDataFrame(rows, "year int, word string, vector array<double>")
    row = ser.yearly_drift(models).first()
    assert (row["year"], row["drift"], row["error"]) == (2002, pytest.approx(0.1), pytest.approx(0.0195996, abs=1e-6))
    assert ser.yearly_drift(models, error="SE").first()["error"] == pytest.approx(0.01)


def test_smoothing_keeps_a_constant_and_derives_a_line(spark):
    df = spark.createDataFrame([(2000 + i, 3.0, 2.0 * i) for i in range(20)], "year int, value double, line double")
    assert all(abs(r["value"] - 3) < 1e-9 for r in ser.gaussian_smooth(df.select("year", "value"), 2.0).collect())
    assert all(abs(r["derivative"] - 2) < 1e-9 for r in ser.savgol_derivative(df.select("year", F.col("line").alias("value"))).collect())


def test_regressions(spark):
    rng = np.random.default_rng(3)
    g = rng.normal(scale=2, size=12)
    rows = [(float(5 + 3 * x + g[i % 12] + e), float(x), i % 12) for i, (x, e) in enumerate(zip(rng.normal(size=600), rng.normal(size=600)))]
    df = spark.createDataFrame(rows, "y double, x double, g int")
    design, names = reg.design(df, "y", ["x"], [], standardise=False, keep=("g",))
    y, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    b = np.linalg.lstsq(np.column_stack([np.ones(600), x]), y, rcond=None)[0]
    assert np.allclose(reg.ols(design, names).coefficients, b)
    fit = reg.mixed(design, names, "g")
    assert abs(fit.coefficients[1] - 3) < 0.2 and abs(fit.variance - 1) < 0.2 and 1 < fit.group_variance < 12


def test_training_finds_planted_neighbours(spark):
    groups = [[f"{g}{i}" for i in range(5)] for g in "ab"]
    rng = np.random.default_rng(2)
    rows = [(2000, rng.choice(groups[i % 2], 4).tolist(), 1) for i in range(400)]
    corpus = spark.createDataFrame(rows, "year int, tokens array<string>, weight long")
    grid = training.grid(spark, [2000], weight_by=["none"], vector_size=[8], window=[3], min_count=[1], approach=["skip-gram", "CBOW"], epochs=[20])
    for approach in ("skip-gram", "CBOW"):
        v = {r["word"]: np.array(r["vector"]) for r in training.train(corpus, grid.where(F.col("approach") == approach)).collect()}
        assert len(v) == 10
        cos = lambda a, b: v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b])
        own = np.mean([cos("a0", f"a{i}") for i in range(1, 5)])
        other = np.mean([cos("a0", f"b{i}") for i in range(5)])
        assert own > other
    name = grid.select(training.model_name().alias("m")).select("m", training.parse_name(F.col("m")).alias("p")).collect()
    assert all(r["p"]["vector_size"] == 8 and r["p"]["year"] == 2000 for r in name)


def test_training_query_takes_every_year_and_match_counts(spark, tmp_path):
    from chronolex.queries.embeddings import word2vec_train

    parts = [(0, "red blue"), (1, "blue green"), (2, "green red")]
    lines = [(p, n, f"{year}-03-01") for year in (1995, 1998, 2003) for p in range(3) for n in range(150 if p == 0 else 3)]
    spark.createDataFrame(parts, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_partkey long, l_orderkey long, day string").withColumn("l_shipdate", F.to_date("day")).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = word2vec_train(spark, str(tmp_path)).collect()
    assert {(r["year"], r["weight_by"], r["window"], r["approach"]) for r in rows} == {(y, b, w, a) for y in (1995, 1998, 2003) for b in ("none", "freq") for w in (2, 4) for a in ("skip-gram", "CBOW")}
    assert len(rows) == 3 * 8 * 3
    vectors = {(r["weight_by"], r["word"]): r["vector"] for r in rows if (r["year"], r["window"], r["approach"]) == (1998, 2, "CBOW")}
    assert any(vectors["none", w] != vectors["freq", w] for w in ("red", "blue", "green"))  # 150 matches weigh 2, 3 weigh 1


def test_derivative_query_takes_every_day(spark, sf_dir):
    import pandas as pd

    from chronolex.queries.embeddings import savgol_derivative

    events = pd.read_parquet(f"{sf_dir}/events.parquet")
    events = events[events["event_type"] == "purchase"]
    days = events.groupby(events["ts"].dt.day)["value"].mean().round(6)
    y = np.interp(range(1, 32), days.index, days.to_numpy())
    got = {r["year"]: r["derivative"] for r in savgol_derivative(spark, sf_dir).collect()}
    assert sorted(got) == list(range(1, 32))
    for i in range(5, 26):
        assert got[i + 1] == pytest.approx(ser.savgol_weights(11, 3, 5, 1.0) @ y[i - 5 : i + 6], abs=1e-5)
