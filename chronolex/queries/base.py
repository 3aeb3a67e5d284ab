"""The driver's tables as n-grams, embeddings and series, in Spark and in SQL; and the registry."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.functions.tokens import POS_TAGS
from chronolex.plans.stages import run_stage
from chronolex.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

YEARS = (1995, 2001)
STOP = ("red", "the", "of", "und", "les")


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with SQL of the same result."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ngram_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as bigrams by year of shipping."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("p_name").alias("ngram"), F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("match_count"), F.count_distinct("l_orderkey").alias("volume_count")
    )


def year_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ngram_year as a table partitioned by year in the shared folder, written once a session; scans of it read the years they ask for."""
    name = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    return run_stage(spark, lambda: ngram_year(spark, sf_dir), f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-year-store-{name}", partition_by="year")


NY = """ny AS (SELECT p_name AS ngram, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS match_count,
  CAST(count(DISTINCT l_orderkey) AS BIGINT) AS volume_count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def dealt(rows: DataFrame) -> DataFrame:
    """Rows over all cores, where a small table's files would give work to a few of them only."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows._jdf.queryExecution().toRdd().getNumPartitions() < cores else rows


def doc_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged bigrams of documents: ngram, year, doc_id. Pairs of words are exploded, so no row carries its document."""
    tags = F.array(*[F.lit(t) for t in POS_TAGS])
    words = dealt(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.expr(r"regexp_extract_all(text, '[^ \\t\\n\\r]+', 0)").alias("w"))
    zipped = F.arrays_zip(F.slice("w", F.lit(1), F.size("w") - 1).alias("a"), F.slice("w", F.lit(2), F.size("w") - 1).alias("b"))
    pairs = words.where(F.size("w") > 1).select("doc_id", F.posexplode(zipped).alias("p", "pair")).select("doc_id", (F.col("p") + 1).alias("i"), "pair.*")
    second = F.when(F.col("i") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("_"), tags[(F.col("i") + 5) % 12]))
    text = F.concat("a", F.lit("_"), tags[F.col("i") % 12], F.lit(" "), "b", second)
    return pairs.select(text.alias("ngram"), (1990 + F.col("doc_id") % 20).cast("int").alias("year"), "doc_id")


_TAGS = "[" + ", ".join(f"'{t}'" for t in POS_TAGS) + "]"
DN = rf"""dn AS (SELECT w[i] || '_' || ({_TAGS})[CAST(i % 12 + 1 AS BIGINT)] || ' ' || w[i + 1] ||
    CASE WHEN i % 3 = 0 THEN '' ELSE '_' || ({_TAGS})[CAST((i + 5) % 12 + 1 AS BIGINT)] END AS ngram, CAST(1990 + doc_id % 20 AS INTEGER) AS year, doc_id
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^ \t\n\r]+') AS w FROM documents)))"""

_TAG = "(NOUN|PROPN|VERB|ADJ|ADV|PRON|DET|ADP|NUM|CONJ|X|[.])"


def sql_tokens(column: str, lower: bool = True) -> str:
    bare = rf"regexp_replace(t, '^(.+)_{_TAG}$', '\1')"
    low = f"translate({bare}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')" if lower else bare
    return f"list_transform(list_filter(string_split({column}, ' '), lambda t: t <> ''), lambda t: {low})"


def sql_accepted(token: str = "t", stop: tuple[str, ...] = STOP, alpha: bool = True, least: int = 3) -> str:
    parts = [rf"regexp_full_match({token}, '\p{{L}}+')"] if alpha else []
    parts += [f"strlen({token}) >= {least}"] if least else []
    parts += [f"{token} NOT IN ({', '.join(repr(s) for s in stop)})"] if stop else []
    return " AND ".join(parts) or "true"


def sql_normalised(tokens: str, ok: str) -> str:
    return f"CASE WHEN len(list_filter({tokens}, lambda t: {ok})) > 0 THEN array_to_string(list_transform({tokens}, lambda t: CASE WHEN {ok} THEN t ELSE '<UNK>' END), ' ') END"


def embeddings_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """year, word, vector: labels as years, places within a label as words."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    return table(spark, sf_dir, "embeddings").select((1990 + F.col("label")).cast("int").alias("year"), F.concat(F.lit("w"), place.cast("string")).alias("word"), F.col("embedding").alias("vector"))


EY = """ey AS (SELECT CAST(1990 + label AS INTEGER) AS year, 'w' || CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) AS VARCHAR) AS word,
  CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""


def sql_dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]))"


def sql_cos(a: str, b: str) -> str:
    return f"({sql_dot(a, b)} / (sqrt({sql_dot(a, a)}) * sqrt({sql_dot(b, b)})))"


def event_series(spark: SparkSession, sf_dir: str, hours: bool = False) -> DataFrame:
    """Mean value of the purchases, with days of the month as years; with hours, the hours of the month, of which some have none."""
    rows = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    at = F.dayofmonth("ts") if not hours else (F.dayofmonth("ts") - 1) * 24 + F.hour("ts") + 1
    return rows.groupBy(at.cast("int").alias("year")).agg(F.round(F.avg("value"), 6).alias("value"))


ES = "es AS (SELECT CAST(day(ts) AS INTEGER) AS year, round(avg(value), 6) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1)"
EH = "es AS (SELECT CAST((day(ts) - 1) * 24 + hour(ts) + 1 AS INTEGER) AS year, round(avg(value), 6) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1)"
