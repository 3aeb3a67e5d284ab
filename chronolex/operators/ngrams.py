"""Merging, reshaping, scanning and ranking year-stamped n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolex.session import settled


def merge_sum(rows: DataFrame, key: str = "ngram") -> DataFrame:
    """Sums the counts of rows that have the same n-gram and year."""
    return rows.groupBy(key, "year").agg(F.sum("match_count").alias("match_count"), F.sum("volume_count").alias("volume_count"))


def pivot_long(wide: DataFrame) -> DataFrame:
    """One row per n-gram and year, from arrays of year records."""
    return wide.select("ngram", F.inline("freqs")).select("ngram", "year", "match_count", "volume_count")


def pack_wide(long: DataFrame) -> DataFrame:
    """Arrays of year records by n-gram, in order of years. An n-gram has at most one record a year, so an array is bounded."""
    return merge_sum(long).groupBy("ngram").agg(F.array_sort(F.collect_list(F.struct("year", "match_count", "volume_count"))).alias("freqs"))


def total_matches(long: DataFrame) -> DataFrame:
    return long.groupBy("ngram").agg(F.sum("match_count").alias("total"))


def year_scan(long: DataFrame, first: int, last: int | None = None, keep: Column | None = None) -> DataFrame:
    """Rows of one year, or of a range with both ends; on a table partitioned by year only these are read."""
    last = first if last is None else last
    if not 0 <= first <= last <= 9999:
        raise ValueError("years must be 0 to 9999, in order")
    rows = long.where(F.col("year").between(first, last))
    return rows if keep is None else rows.where(keep)


def prefix_scan(df: DataFrame, prefix: str, key: str = "ngram") -> DataFrame:
    return df.where(F.col(key).startswith(prefix)).orderBy(key)


def range_scan(df: DataFrame, lower: str = "", upper: str | None = None, key: str = "ngram") -> DataFrame:
    """Keys from lower up to, but without, upper."""
    rows = df.where(F.col(key) >= lower)
    return (rows if upper is None else rows.where(F.col(key) < upper)).orderBy(key)


def point_lookup(long: DataFrame, year: int, ngram: str) -> DataFrame:
    return long.where((F.col("year") == year) & (F.col("ngram") == ngram)).select("match_count", "volume_count")


def covered(long: DataFrame, first: int, last: int) -> DataFrame:
    """N-grams with a row, counts of zero too, in every year of the range."""
    rows = long.where(F.col("year").between(first, last))
    return rows.groupBy("ngram").agg(F.count_distinct("year").alias("years")).where(F.col("years") == last - first + 1).select("ngram")


def spelled(tokens: DataFrame, dictionary: DataFrame | None, column: str = "ngram", language: str | None = None) -> DataFrame:
    """Alphabetic tokens that the dictionary (`word`) has. Without one all tokens pass; with a language, the dictionary's `lang` rows
    count, and a language that it lacks is an error.
    """
    if dictionary is None:
        return tokens
    if language is not None:
        dictionary = dictionary.where(F.col("lang") == language)
        if dictionary.limit(1).isEmpty():
            raise ValueError(f"no dictionary of language {language!r}")
    return tokens.where(F.col(column).rlike(r"^\p{L}+$")).join(dictionary.select(F.col("word").alias(column)), column, "left_semi")


def vocabulary_index(tokens: DataFrame, column: str = "ngram") -> DataFrame:
    """Distinct tokens in order, with ranges of them in a partition each: what a sorted index of them holds."""
    return tokens.select(F.col(column).alias("token")).distinct().repartitionByRange("token").sortWithinPartitions("token")


def members(tokens: DataFrame, index: DataFrame, column: str = "ngram") -> DataFrame:
    """Tokens that the index has."""
    return tokens.join(index.select(F.col("token").alias(column)), column, "left_semi")


def ranked(totals: DataFrame, column: str = "ngram") -> DataFrame:
    """All tokens by falling total, ties by token, with their rank. The rank is global: a range sort, then counts before each partition."""
    rows = settled(totals.orderBy(F.desc("total"), F.asc(column)).select(F.spark_partition_id().alias("part"), "*"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))  # a row a partition
    within = Window.partitionBy("part").orderBy(F.desc("total"), F.asc(column))
    return rows.join(F.broadcast(starts), "part").select((F.col("start") + F.row_number().over(within)).cast("long").alias("rank"), column, "total")


def top_k(totals: DataFrame, k: int, column: str = "ngram") -> DataFrame:
    """The k largest totals, ties by token; none for k <= 0."""
    return totals.orderBy(F.desc("total"), F.asc(column)).limit(max(k, 0))


def vocabulary(long: DataFrame, top: int | None = None, years: tuple[int, int] | None = None, dictionary: DataFrame | None = None) -> DataFrame:
    """token totals after the coverage and spelling filters, ranked by top_k if top is given."""
    totals = total_matches(long)
    if dictionary is not None:
        totals = spelled(totals, dictionary)
    if years is not None:
        totals = totals.join(covered(long, *years), "ngram", "left_semi")
    return totals if top is None else top_k(totals, top)


def head(df: DataFrame, n: int, key: str = "ngram") -> DataFrame:
    return df.orderBy(key).limit(n)


def tail(df: DataFrame, n: int, key: str = "ngram") -> DataFrame:
    return df.orderBy(F.desc(key)).limit(n).orderBy(key)


def peek(df: DataFrame, start: str, n: int, key: str = "ngram") -> DataFrame:
    return df.where(F.col(key) >= start).orderBy(key).limit(n)


def peek_prefix(df: DataFrame, prefix: str, n: int, key: str = "ngram") -> DataFrame:
    return df.where(F.col(key).startswith(prefix)).orderBy(key).limit(n)


def every_nth(df: DataFrame, step: int, n: int, key: str = "ngram") -> DataFrame:
    """Rows 0, step, 2 step and so on in key order, n at most: only the first step * n rows are ordered."""
    first = df.orderBy(key).limit(step * n)
    return first.withColumn("rn", F.row_number().over(Window.orderBy(key))).where((F.col("rn") - 1) % step == 0).drop("rn")


def size_histogram(df: DataFrame, size: Column, width: int) -> DataFrame:
    return df.select((F.floor(size / width) * width).cast("long").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def reservoir(df: DataFrame, k: int, seed: int, key: str = "ngram") -> DataFrame:
    """A uniform sample of k rows: the k smallest seeded digests; each task keeps k at most."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")).cast("binary")), key).limit(k)


def density_bounds(sample: DataFrame, parts: int, key: str = "ngram") -> DataFrame:
    """Keys that cut a sorted sample into parts of equal size: those at place part * len / parts.

    Places come from a range sort and the counts before each of its partitions, so no task sees all keys.
    """
    rows = settled(sample.select(F.col(key).alias("key")).orderBy("key").select(F.spark_partition_id().alias("at"), "key"))
    before = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("at").count()
    starts = counts.select("at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"), F.sum("count").over(Window.partitionBy(F.lit(0))).alias("n"))  # a row a partition
    placed = rows.join(F.broadcast(starts), "at").select("key", "n", (F.col("start") + F.row_number().over(Window.partitionBy("at").orderBy("key")) - 1).alias("place"))
    places = sample.sparkSession.range(1, parts).withColumnRenamed("id", "part")
    return placed.join(F.broadcast(places), F.col("place") == F.floor(F.col("part") * F.col("n") / parts)).select("part", "key")


def bounds(sample: DataFrame, parts: int, key: str = "ngram", least: int = 4) -> DataFrame:
    """Boundaries of work units: by density from `least` parts on if the sample has as many keys, else evenly over the byte space."""
    if parts >= least and sample.limit(parts).count() == parts:
        return density_bounds(sample, parts, key).select("part", F.col("key").cast("binary").alias("key"))
    rows = [(i, k) for i, k in enumerate(uniform_bounds(parts), 1)]
    return sample.sparkSession.createDataFrame(rows, "part long, key binary")


def unit_name(start: bytes | None, end: bytes | None) -> str:
    """A name for a range of keys: hexadecimal heads of both ends, open ones empty, and six digits of their digest."""
    import hashlib

    a, b = start or b"", end or b""
    return f"{a[:4].hex()}-{b[:4].hex()}-{hashlib.sha256(a + b'|' + b).hexdigest()[:6]}"


def midpoint(start: bytes | None, end: bytes | None) -> bytes | None:
    """A key halfway between two, open ends being the ends of the byte space; null if there is none between them."""
    width = max(len(start or b""), len(end or b"")) + 1
    low = int.from_bytes((start or b"").ljust(width, b"\0"), "big")
    high = 256**width if end is None else int.from_bytes(end.ljust(width, b"\0"), "big")
    middle = (low + high) // 2
    return middle.to_bytes(width, "big").rstrip(b"\0") if low < middle < high else None


def is_empty(df: DataFrame, lower: str = "", upper: str | None = None, key: str = "ngram") -> bool:
    """Whether a range of keys holds no row; reads no more than one."""
    rows = df.where(F.col(key) >= lower)
    return (rows if upper is None else rows.where(F.col(key) < upper)).limit(1).isEmpty()


def lookup_key(long: DataFrame, text: str) -> DataFrame:
    """Counts of a readable key: `[year] ngram` is one row, `[year]` a year's rows, and a bare n-gram its rows of year 0."""
    import re

    m = re.match(r"\[(\d+)\]\s*(.*)", text)
    year, ngram = (int(m[1]), m[2]) if m else (0, text)
    return year_scan(long, year) if m and not ngram else point_lookup(long, year, ngram)


def uniform_bounds(parts: int) -> list[bytes]:
    """Keys that cut the byte space evenly, of one byte up to 256 parts and of two beyond."""
    width = 1 if parts <= 256 else 2
    return [(i * 256**width // parts).to_bytes(width, "big") for i in range(1, parts)]


def corpus_stats(rows: DataFrame) -> DataFrame:
    """unique n-grams, total matches and documents by year; missing numbers are 0."""
    return rows.groupBy("year").agg(
        F.count(F.lit(1)).alias("unique_ngrams"), F.sum(F.coalesce("freq", F.lit(0))).alias("total_freq"), F.sum(F.coalesce("doc", F.lit(0))).alias("total_docs")
    )


def sentences(rows: DataFrame, weight: Column, ngram: str = "ngram") -> DataFrame:
    """Token sequences of n-grams with the number of times each counts in training; the weight stays a number, not copies."""
    tokens = F.filter(F.split(F.regexp_replace(F.col(ngram), r"(?U)[\s\x1c-\x1f]+", " "), " "), lambda t: t != "")
    return rows.select(tokens.alias("tokens"), weight.cast("long").alias("weight"), *[c for c in ("year",) if c in rows.columns])


def repeated(weighted: DataFrame) -> DataFrame:
    """Each sentence as often as it counts, for sinks that need copies."""
    return weighted.select(*[c for c in weighted.columns if c != "weight"], F.explode(F.sequence(F.lit(1).cast("long"), "weight")).alias("copy")).drop("copy")


def word_counts(weighted: DataFrame, min_count: int = 1) -> DataFrame:
    """Words with their weighted number, min_count at least."""
    words = weighted.select(F.explode("tokens").alias("word"), "weight").groupBy("word").agg(F.sum("weight").alias("n"))
    return words.where(F.col("n") >= min_count)
