"""Queries over yearly embeddings, series and regressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolex.functions import tokens
from chronolex.operators import embeddings as emb
from chronolex.operators import ngrams as ops
from chronolex.operators import regression as reg
from chronolex.operators import series as ser
from chronolex.operators import training
from chronolex.queries.base import EH, ES, EY, embeddings_year, event_series, ngram_year, query, sql_cos, sql_dot, table

_PREV = "yr AS (SELECT DISTINCT year FROM ey), pr AS (SELECT year, lag(year) OVER (ORDER BY year) AS other FROM yr)"
_SIM = f"{EY}, {_PREV}, sim AS (SELECT a.year, p.other, avg(s) AS mean, stddev_pop(s) AS std, CAST(count(*) AS BIGINT) AS shared FROM (SELECT a.year, p.other, {sql_dot('a.v', 'b.v')} AS s FROM pr p JOIN ey a ON a.year = p.year JOIN ey b ON b.year = p.other AND a.word = b.word) a JOIN pr p USING (year) GROUP BY 1, 2)"
SETS = [("T1", "w1"), ("T1", "w2"), ("T1", "w3"), ("T2", "w4"), ("T2", "w5"), ("T2", "w6"), ("T2", "missing"), ("A1", "w7"), ("A1", "w8"), ("A2", "w9"), ("A2", "w10")]
_SETS = "sets(s, word) AS (VALUES " + ", ".join(f"('{s}', '{w}')" for s, w in SETS) + ")"


def word_sets(spark) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{s}', '{w}')" for s, w in SETS) + " AS t(set, word)")


@query(f"WITH {EY}, u AS (SELECT year, word, v, sqrt({sql_dot('v', 'v')}) AS n FROM ey) SELECT year, word, round(v[1] / n, 6) AS first, round({sql_dot('v', 'v')} / (n * n), 6) AS length FROM u")
def l2_normalize(spark, sf_dir) -> DataFrame:
    rows = emb.normalised(embeddings_year(spark, sf_dir))
    return rows.select("year", "word", F.round(F.col("vector")[0], 6).alias("first"), F.round(emb.dot(F.col("vector"), F.col("vector")), 6).alias("length"))


@query(f"WITH {EY} SELECT year, max(abs(sqrt({sql_dot('v', 'v')}) - 1)) < 1e-3 AS normalised FROM ey GROUP BY 1")
def is_normalized(spark, sf_dir) -> DataFrame:
    return emb.is_normalised(embeddings_year(spark, sf_dir), 1e-3)


@query(f"WITH {EY} SELECT year, CAST(count(*) AS BIGINT) AS n FROM ey WHERE word IN (SELECT DISTINCT 'w' || p_size FROM part) GROUP BY 1")
def filter_vocab(spark, sf_dir) -> DataFrame:
    words = table(spark, sf_dir, "part").select(F.concat(F.lit("w"), F.col("p_size").cast("string")).alias("word"))
    return emb.restricted(embeddings_year(spark, sf_dir), words).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EY} SELECT word FROM ey GROUP BY 1 HAVING count(DISTINCT year) = (SELECT count(DISTINCT year) FROM ey)")
def shared_vocab(spark, sf_dir) -> DataFrame:
    return emb.shared_by_all(embeddings_year(spark, sf_dir))


@query(f"WITH {EY} SELECT a.year, round({sql_cos('a.v', 'b.v')}, 6) AS cosine FROM ey a JOIN ey b ON a.year = b.year WHERE a.word = 'w1' AND b.word = 'w2'")
def word_cosine(spark, sf_dir) -> DataFrame:
    return emb.word_similarity(embeddings_year(spark, sf_dir), "w1", "w2").select("year", F.round("cosine", 6).alias("cosine"))


@query(f"WITH {_SIM} SELECT year, other, round(mean, 6) AS mean, round(std, 6) AS std, shared FROM sim")
def model_similarity(spark, sf_dir) -> DataFrame:
    models = embeddings_year(spark, sf_dir)
    return emb.model_similarity(models, emb.previous_years(models)).select("year", "other", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "shared")


@query(f"WITH {EY} SELECT a.year, round(avg({sql_cos('a.v', 'b.v')}), 6) AS mean FROM ey a JOIN ey b ON a.year = b.year AND b.word NOT IN ('w1', 'w2', 'w3') WHERE a.word = 'w1' GROUP BY 1")
def mean_relatedness(spark, sf_dir) -> DataFrame:
    return emb.mean_relatedness(embeddings_year(spark, sf_dir), "w1", ("w2", "w3")).select("year", F.round("mean", 6).alias("mean"))


@query()
def procrustes_align(spark, sf_dir) -> DataFrame:
    return emb.aligned(embeddings_year(spark, sf_dir), 1990)


@query(f"""WITH {EY}, u AS (SELECT year, word, list_transform(v, lambda x: x / sqrt({sql_dot('v', 'v')})) AS v FROM ey), k AS (SELECT * FROM u WHERE word IN (SELECT word FROM u WHERE year = 1990)),
n AS (SELECT *, lead(word) OVER (PARTITION BY year ORDER BY word) AS other FROM k) SELECT a.year, a.word, round({sql_dot('a.v', 'b.v')}, 6) + 0.0 AS near FROM n a JOIN k b ON a.year = b.year AND a.other = b.word""")
def procrustes_angles(spark, sf_dir) -> DataFrame:
    """Rotations keep every angle: dot products of neighbours by word within a year, after alignment."""
    from pyspark.sql import Window

    turned = emb.aligned(embeddings_year(spark, sf_dir), 1990)
    pairs = turned.withColumn("next", F.lead("vector").over(Window.partitionBy("year").orderBy("word"))).where("next IS NOT NULL")
    return pairs.select("year", "word", (F.round(emb.dot(F.col("vector"), F.col("next")), 6) + 0.0).alias("near"))


@query()
def alignment_check(spark, sf_dir) -> DataFrame:
    models = embeddings_year(spark, sf_dir)
    return emb.alignment_quality(models, 1990).unionByName(emb.alignment_quality(emb.aligned(models, 1990), 1990))


_Z = 1.959963984540054


@query(f"WITH {_SIM} SELECT year, round(1 - mean, 6) AS drift, round({_Z!r} * std / sqrt(shared), 6) AS error, shared FROM sim WHERE mean <> 0")
def yearly_drift(spark, sf_dir) -> DataFrame:
    return ser.yearly_drift(embeddings_year(spark, sf_dir)).select("year", F.round("drift", 6).alias("drift"), F.round("error", 6).alias("error"), "shared")


@query(f"WITH {_SIM} SELECT year, round(1 - mean, 6) AS drift, round(CASE WHEN shared > 1 THEN (1 - mean) / sqrt(shared) ELSE 0 END, 6) AS error, shared FROM sim WHERE mean <> 0")
def yearly_drift_se(spark, sf_dir) -> DataFrame:
    return ser.yearly_drift(embeddings_year(spark, sf_dir), error="SE").select("year", F.round("drift", 6).alias("drift"), F.round("error", 6).alias("error"), "shared")


@query(f"""WITH {_SIM}, x AS (SELECT CAST(1990 + n_nationkey AS INTEGER) AS year, CAST(n_regionkey * 1.5 + n_nationkey AS DOUBLE) AS x FROM nation WHERE n_nationkey <> 5), j AS (SELECT sim.year, 1 - mean AS drift, x FROM sim JOIN x USING (year) WHERE mean <> 0),
f AS (SELECT regr_slope(drift, x) AS s, regr_intercept(drift, x) AS i FROM j) SELECT year, round(drift - i - s * x, 6) AS adjusted FROM j, f""")
def drift_residual(spark, sf_dir) -> DataFrame:
    x = table(spark, sf_dir, "nation").where("n_nationkey <> 5").select((1990 + F.col("n_nationkey")).cast("int").alias("year"), (F.col("n_regionkey") * 1.5 + F.col("n_nationkey")).alias("x"))
    return ser.residual(ser.yearly_drift(embeddings_year(spark, sf_dir)), x).select("year", F.round("adjusted", 6).alias("adjusted"))


def _interpolated(series: str, last: int) -> str:
    return f"""{series}, spine AS (SELECT CAST(unnest(range(1, {last + 1})) AS INTEGER) AS year), it AS (SELECT s.year, coalesce(e.value, CASE WHEN p.year IS NULL THEN n.value WHEN n.year IS NULL THEN p.value ELSE p.value + (n.value - p.value) * (s.year - p.year) / (n.year - p.year) END) AS value
FROM spine s LEFT JOIN es e ON e.year = s.year LEFT JOIN es p ON p.year = (SELECT max(year) FROM es WHERE year <= s.year) LEFT JOIN es n ON n.year = (SELECT min(year) FROM es WHERE year >= s.year))"""


_INTERP = _interpolated(EH, 744)


@query(f"WITH {_INTERP} SELECT year, round(value, 6) AS value FROM it")
def interp_series(spark, sf_dir) -> DataFrame:
    return ser.interpolated(event_series(spark, sf_dir, hours=True), 1, 744).select("year", F.round("value", 6).alias("value"))


@query(f"WITH {ES}, r AS (SELECT *, (row_number() OVER (ORDER BY year) - 1) // 4 AS chunk FROM es) SELECT CAST(chunk AS BIGINT) AS chunk, round(avg(year), 6) AS year, round(avg(value), 6) AS value FROM r GROUP BY 1")
def chunk_avg(spark, sf_dir) -> DataFrame:
    return ser.chunk_means(event_series(spark, sf_dir), 4).select("chunk", F.round("year", 6).alias("year"), F.round("value", 6).alias("value"))


_K = ", ".join(f"({o - 8}, {w!r})" for o, w in enumerate(ser.gaussian_kernel(2.0).tolist()))


@query(f"""WITH {_INTERP}, r AS (SELECT year, value, row_number() OVER (ORDER BY year) - 1 AS i, count(*) OVER () AS n FROM it), k(o, w) AS (VALUES {_K}),
m AS (SELECT r.year, w, ((i + o) % (2 * n) + 2 * n) % (2 * n) AS j, n FROM r, k), q AS (SELECT year, w, CASE WHEN j >= n THEN 2 * n - 1 - j ELSE j END AS j FROM m)
SELECT q.year, round(sum(q.w * r.value), 6) AS value FROM q JOIN r ON r.i = q.j GROUP BY 1""")
def gaussian_smooth(spark, sf_dir) -> DataFrame:
    return ser.gaussian_smooth(ser.interpolated(event_series(spark, sf_dir, hours=True), 1, 744), 2.0).select("year", F.round("value", 6).alias("value"))


_ALL = _interpolated(ES, 31)
_SG = ", ".join(f"({at}, {o}, {w!r}::DOUBLE)" for at in range(11) for o, w in enumerate(ser.savgol_weights(11, 3, at, 1.0).tolist()))


@query(f"""WITH {_ALL}, r AS (SELECT year, value, row_number() OVER (ORDER BY year) - 1 AS i, count(*) OVER () AS n FROM it), w(place, o, w) AS (VALUES {_SG}),
s AS (SELECT year, i, greatest(0, least(i - 5, n - 11)) AS start FROM r) SELECT CAST(s.year AS DOUBLE) AS year, round(sum(w.w * r.value), 6) AS derivative FROM s JOIN w ON w.place = s.i - s.start JOIN r ON r.i = s.start + w.o GROUP BY 1""")
def savgol_derivative(spark, sf_dir) -> DataFrame:
    out = ser.savgol_derivative(ser.interpolated(event_series(spark, sf_dir), 1, 31))
    return out.select("year", F.round("derivative", 6).alias("derivative"))


@query(f"WITH {EY}, c AS (SELECT a.year, {sql_cos('a.v', 'b.v')} AS value FROM ey a JOIN ey b ON a.year = b.year WHERE a.word = 'w3' AND b.word = 'w4'), r AS (SELECT *, (row_number() OVER (ORDER BY year) - 1) // 3 AS chunk FROM c) SELECT CAST(chunk AS BIGINT) AS chunk, round(avg(year), 6) AS year, round(avg(value), 6) AS value FROM r GROUP BY 1")
def cosine_series(spark, sf_dir) -> DataFrame:
    s = emb.word_similarity(embeddings_year(spark, sf_dir), "w3", "w4").withColumnRenamed("cosine", "value")
    return ser.chunk_means(s, 3).select("chunk", F.round("year", 6).alias("year"), F.round("value", 6).alias("value"))


_ASSOC = f"{EY}, {_SETS}, vec AS (SELECT ey.year, s, word, v FROM ey JOIN sets USING (word)), cs AS (SELECT t.year, t.s, t.word, a.s AS a, {sql_cos('t.v', 'a.v')} AS c FROM vec t JOIN vec a ON t.year = a.year AND t.s IN ('T1', 'T2') AND a.s IN ('A1', 'A2'))"


@query(f"WITH {_ASSOC}, m AS (SELECT year, s, word, avg(c) FILTER (a = 'A1') - avg(c) FILTER (a = 'A2') AS x FROM cs GROUP BY 1, 2, 3) SELECT year, round((avg(x) FILTER (s = 'T1') - avg(x) FILTER (s = 'T2')) / stddev_samp(x), 6) AS effect FROM m GROUP BY 1")
def weat_by_year(spark, sf_dir) -> DataFrame:
    return emb.weat(embeddings_year(spark, sf_dir), word_sets(spark)).select("year", F.round("effect", 6).alias("effect"))


@query(f"WITH {_ASSOC} SELECT year, round((avg(c) FILTER (s = 'T1' AND a = 'A1') - avg(c) FILTER (s = 'T1' AND a = 'A2') - avg(c) FILTER (s = 'T2' AND a = 'A1') + avg(c) FILTER (s = 'T2' AND a = 'A2')) / stddev_samp(c), 6) AS effect FROM cs GROUP BY 1")
def weat_pairwise(spark, sf_dir) -> DataFrame:
    return emb.weat(embeddings_year(spark, sf_dir), word_sets(spark), "pairwise").select("year", F.round("effect", 6).alias("effect"))


@query(f"""WITH {_ASSOC}, m AS (SELECT year, s, word, avg(c) FILTER (a = 'A1') - avg(c) FILTER (a = 'A2') AS x FROM cs GROUP BY 1, 2, 3), e AS (SELECT year, avg(x) FILTER (s = 'T1') - avg(x) FILTER (s = 'T2') AS d, stddev_samp(x) AS std FROM m GROUP BY 1)
SELECT year, round(d / std, 6) AS effect, round({_Z!r} * std, 6) AS band FROM e""")
def weat_intervals(spark, sf_dir) -> DataFrame:
    return emb.weat_series(embeddings_year(spark, sf_dir), word_sets(spark)).select("year", F.round("effect", 6).alias("effect"), F.round("band", 6).alias("band"))


_SPLITS = f"""{_ASSOC}, m AS (SELECT year, s, word, avg(c) FILTER (a = 'A1') - avg(c) FILTER (a = 'A2') AS x FROM cs GROUP BY 1, 2, 3),
t AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY s, word) - 1 AS i, count(*) OVER (PARTITION BY year) AS all_, count(*) FILTER (s = 'T1') OVER (PARTITION BY year) AS n1 FROM m),
b AS (SELECT year, z AS mask, any_value(all_) AS all_, any_value(n1) AS n1, sum(CASE WHEN (z >> i) & 1 = 1 THEN x ELSE 0 END) AS first, sum(x) AS total FROM t, range(64) AS r(z) GROUP BY 1, 2),
k AS (SELECT * FROM b WHERE mask < (1 << all_) AND bit_count(mask) = n1), seen AS (SELECT year, first, total, n1, all_ FROM k WHERE mask = (1 << n1) - 1)"""


@query(f"WITH {_SPLITS} SELECT k.year, round(avg(CASE WHEN abs(2 * k.first - k.total) >= abs(2 * seen.first - seen.total) - 1e-12 THEN 1.0 ELSE 0.0 END), 6) AS p FROM k JOIN seen USING (year) GROUP BY 1")
def weat_exact(spark, sf_dir) -> DataFrame:
    return emb.weat_p_values(embeddings_year(spark, sf_dir), word_sets(spark), None, seed=0).select("year", F.round("p", 6).alias("p"))


@query(f"WITH {_SPLITS} SELECT k.year, round(avg(CASE WHEN k.first / k.n1 - (k.total - k.first) / (k.all_ - k.n1) >= seen.first / seen.n1 - (seen.total - seen.first) / (seen.all_ - seen.n1) - 1e-12 THEN 1.0 ELSE 0.0 END), 6) AS p FROM k JOIN seen USING (year) GROUP BY 1")
def weat_pairwise_exact(spark, sf_dir) -> DataFrame:
    return emb.weat_pairwise_p_values(embeddings_year(spark, sf_dir), word_sets(spark), None, seed=0).select("year", F.round("p", 6).alias("p"))


@query()
def weat_pvalue(spark, sf_dir) -> DataFrame:
    return emb.weat_p_values(embeddings_year(spark, sf_dir), word_sets(spark), 200, seed=5)


def gold_pairs(spark) -> DataFrame:
    return spark.range(30).select(F.concat(F.lit("w"), (F.col("id") + 1).cast("string")).alias("w1"), F.concat(F.lit("w"), (F.col("id") * 7 % 31 + 2).cast("string")).alias("w2"), (F.col("id") * 13 % 11).cast("double").alias("score"))


@query(f"""WITH {EY}, g AS (SELECT 'w' || (i + 1) AS w1, 'w' || (i * 7 % 31 + 2) AS w2, CAST(i * 13 % 11 AS DOUBLE) AS score FROM range(30) AS t(i)),
j AS (SELECT a.year, score, round({sql_cos('a.v', 'b.v')}, 9) AS c FROM g JOIN ey a ON a.word = w1 JOIN ey b ON b.word = w2 AND a.year = b.year),
r AS (SELECT year, rank() OVER (PARTITION BY year ORDER BY c) + (count(*) OVER (PARTITION BY year, c) - 1) / 2.0 AS r1, rank() OVER (PARTITION BY year ORDER BY score) + (count(*) OVER (PARTITION BY year, score) - 1) / 2.0 AS r2 FROM j)
SELECT year, round(corr(r1::DOUBLE, r2::DOUBLE), 6) AS spearman, CAST(count(*) AS BIGINT) AS pairs FROM r GROUP BY 1""")
def eval_similarity(spark, sf_dir) -> DataFrame:
    return emb.spearman(embeddings_year(spark, sf_dir), gold_pairs(spark)).select("year", F.round("spearman", 6).alias("spearman"), "pairs")


@query(f"""WITH {EY}, u AS (SELECT year, word, list_transform(v, lambda x: x / sqrt({sql_dot('v', 'v')})) AS v FROM ey), q AS (SELECT 'w' || i AS a, 'w' || (i + 1) AS b, 'w' || (i + 2) AS c, 'w' || (i + 3) AS d FROM range(1, 20) AS t(i)),
k AS (SELECT a.year, q.*, list_transform(list_zip(a.v, b.v, c.v), lambda z: z[2] - z[1] + z[3]) AS target FROM q JOIN u a ON a.word = q.a JOIN u b ON b.word = q.b AND b.year = a.year JOIN u c ON c.word = q.c AND c.year = a.year JOIN u d ON d.word = q.d AND d.year = a.year),
s AS (SELECT k.year, k.a, k.d, u.word, row_number() OVER (PARTITION BY k.year, k.a ORDER BY round({sql_dot('k.target', 'u.v')}, 9) DESC, u.word DESC) AS rn FROM k JOIN u ON u.year = k.year AND u.word NOT IN (k.a, k.b, k.c))
SELECT year, avg(CASE WHEN word = d THEN 1.0::DOUBLE ELSE 0.0 END) AS accuracy, CAST(count(*) AS BIGINT) AS questions FROM s WHERE rn = 1 GROUP BY 1""")
def eval_analogy(spark, sf_dir) -> DataFrame:
    rows = ", ".join(f"('s', 'w{i}', 'w{i + 1}', 'w{i + 2}', 'w{i + 3}')" for i in range(1, 20))
    return emb.analogy_accuracy(embeddings_year(spark, sf_dir), spark.sql(f"SELECT * FROM VALUES {rows} AS t(section, a, b, c, d)"))


# --- training, models, regression ------------------------------------------------------------------------------------

_GRID = {"weight_by": ["none", "freq"], "vector_size": [8], "window": [2, 4], "min_count": [1], "approach": ["skip-gram", "CBOW"], "epochs": [3]}
_GRID_SQL = "g AS (SELECT CAST(y AS INTEGER) AS year, wb AS weight_by, 8 AS vector_size, w AS \"window\", 1 AS min_count, a AS approach, 3 AS epochs FROM range(1995, 1998) AS t(y), (VALUES ('none'), ('freq')) AS b(wb), (VALUES (2), (4)) AS c(w), (VALUES ('skip-gram'), ('CBOW')) AS d(a))"
_NAME_SQL = "'w2v_y' || year || '_wb' || weight_by || '_vs008_w' || lpad(CAST(\"window\" AS VARCHAR), 3, '0') || '_mc001_sg' || CASE approach WHEN 'skip-gram' THEN 1 ELSE 0 END || '_e003.kv'"


def settings_grid(spark) -> DataFrame:
    return training.grid(spark, [1995, 1996, 1997], **_GRID)


@query(f"WITH {_GRID_SQL} SELECT *, {_NAME_SQL} AS model FROM g")
def train_grid(spark, sf_dir) -> DataFrame:
    return settings_grid(spark).withColumn("model", training.model_name())


@query(f"WITH {_GRID_SQL} SELECT * FROM g WHERE NOT (year = 1996 AND \"window\" = 2)")
def resume_models(spark, sf_dir) -> DataFrame:
    return training.untrained(settings_grid(spark), settings_grid(spark).where((F.col("year") == 1996) & (F.col("window") == 2))).select(*settings_grid(spark).columns)


@query(f"WITH {_GRID_SQL} SELECT {_NAME_SQL} AS model, year, \"window\" FROM g")
def parse_model_name(spark, sf_dir) -> DataFrame:
    return train_grid(spark, sf_dir).select("model", training.parse_name(F.col("model")).alias("p")).select("model", "p.year", "p.window")


@query(f"WITH {_GRID_SQL} SELECT {_NAME_SQL} AS model, g.*, true AS strict, false AS short_strict FROM g")
def parse_model_fields(spark, sf_dir) -> DataFrame:
    """All fields, and which of the two forms takes a name whose fields are short."""
    rows = train_grid(spark, sf_dir).select("model", training.parse_name(F.col("model")).alias("p"), training.parse_name(F.col("model"), strict=True).isNotNull().alias("strict"))
    short = training.parse_name(F.regexp_replace("model", r"_(vs|w|mc|e)0+(\d)", "_$1$2"), strict=True).isNotNull()
    return rows.select("model", "p.*", "strict", short.alias("short_strict"))


@query(f"WITH {_GRID_SQL} SELECT year, max({_NAME_SQL}) AS model FROM g GROUP BY 1")
def latest_model(spark, sf_dir) -> DataFrame:
    return training.latest(train_grid(spark, sf_dir))


@query("SELECT o_orderpriority AS approach, o_orderstatus AS weight_by, round(avg(o_totalprice), 4) AS mean, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2")
def metric_by_params(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("approach"), F.col("o_orderstatus").alias("weight_by"), "o_totalprice")
    return training.by_settings(rows, ["approach", "weight_by"], "o_totalprice").withColumn("mean", F.round("mean", 4))


@query()
def word2vec_train(spark, sf_dir) -> DataFrame:
    rows = ngram_year(spark, sf_dir)
    grid = settings_grid(spark).drop("year").distinct().crossJoin(rows.select("year").distinct())  # every year of the table
    weights = {"none": F.lit(1), "freq": tokens.log_weight(F.col("match_count"))}
    corpora = [ops.sentences(rows, w).withColumn("weight_by", F.lit(by)) for by, w in weights.items()]
    return training.train(corpora[0].unionByName(corpora[1]), grid)


def _regression_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("y"), F.col("c_custkey").cast("double").alias("x"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("g"))


@query("""WITH d AS (SELECT c_acctbal AS y, CAST(c_custkey AS DOUBLE) AS x, c_mktsegment AS s FROM customer), m AS (SELECT avg(x) AS a, stddev_pop(x) AS b, min(s) AS base FROM d),
t AS (SELECT y, (x - a) / b AS z, s, base FROM d, m) SELECT s AS segment, CAST(count(*) AS BIGINT) AS n, round(sum(z), 4) AS sum_x, round(sum(CASE WHEN s <> base THEN z ELSE 0 END), 4) AS sum_products FROM t GROUP BY 1""")
def design_matrix(spark, sf_dir) -> DataFrame:
    rows, names = reg.design(_regression_rows(spark, sf_dir), "y", ["x"], ["segment"], [("x", "segment")], keep=("segment",))
    products = sum((F.col(f"`{n}`") for n in names if ":" in n), F.lit(0.0))
    return rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 4).alias("sum_x"), F.round(F.sum(products), 4).alias("sum_products"))


def _summary(spark, fit) -> DataFrame:
    return spark.createDataFrame(fit.summary(), "term string, coefficient double, error double, z double, p double, lower double, upper double, stars string")


@query("SELECT 'intercept' AS term, round(regr_intercept(c_acctbal, CAST(c_custkey AS DOUBLE)), 4) AS coefficient FROM customer UNION ALL SELECT 'x', round(regr_slope(c_acctbal, CAST(c_custkey AS DOUBLE)), 4) FROM customer")
def ols_simple(spark, sf_dir) -> DataFrame:
    rows, names = reg.design(reg.prepared(_regression_rows(spark, sf_dir), "y", ["x"]), "y", ["x"], [], standardise=False)
    return _summary(spark, reg.ols(rows, names)).select("term", F.round("coefficient", 4).alias("coefficient"))


@query()
def mixed_model(spark, sf_dir) -> DataFrame:
    rows, names = reg.design(_regression_rows(spark, sf_dir), "y", ["x"], ["segment"], [("x", "segment")], keep=("g",))
    return _summary(spark, reg.mixed(rows, names, "g"))


@query("""WITH d AS (SELECT c_acctbal AS y, CAST(c_custkey AS DOUBLE) AS x FROM customer), m AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx FROM d),
r AS (SELECT sum((y - a - b * x) * (y - a - b * x)) / (any_value(n) - 2) AS s2 FROM d, m) SELECT 'intercept' AS term, round(sqrt(s2 * (1.0 / n + mx * mx / sxx)), 3) AS error FROM r, m UNION ALL SELECT 'x', round(sqrt(s2 / sxx), 3) FROM r, m""")
def ols_errors(spark, sf_dir) -> DataFrame:
    rows, names = reg.design(reg.prepared(_regression_rows(spark, sf_dir), "y", ["x"]), "y", ["x"], [], standardise=False)
    return _summary(spark, reg.fitted(rows, names, None)[1]).select("term", F.round("error", 3).alias("error"))
