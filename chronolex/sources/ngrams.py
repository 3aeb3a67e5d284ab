"""Reading n-gram releases: where their files are, which are still to read, and what a line holds."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.functions.tokens import ngram_type

# The public places and file names of the three releases.
OBJECTS = "https://storage.googleapis.com/books/"
BUCKET = "https://storage.googleapis.com/books/ngrams/books"
LISTING = "https://books.storage.googleapis.com/?prefix=ngrams/books/"
INDEX = f"{BUCKET}/datasetsv3.html"
RELEASES = {"20200217": "v3", "20120701": "v2", "20090715": "v1"}


def location(n: int, release: str, corpus: str) -> tuple[str, str]:
    """(listing address, pattern of file names) of a release's n-gram files."""
    if n not in range(1, 6):
        raise ValueError("n must be 1 to 5")
    if not re.fullmatch(r"\d{8}", release) or not re.fullmatch(r"[A-Za-z0-9-]+", corpus):
        raise ValueError(f"bad release or corpus: {release!r}, {corpus!r}")
    kind = RELEASES.get(release)
    if kind == "v3":
        return f"{LISTING}{release}/{corpus}/{n}-", rf"^{n}-\d{{5}}-of-\d{{5}}\.gz$"
    if kind == "v2":
        return INDEX, rf"^googlebooks-{corpus}-all-{n}gram-{release}-\w+\.gz$"
    if kind == "v1":
        return INDEX, rf"^googlebooks-{corpus}-all-{n}gram-{release}-\d+\.csv\.zip$"
    raise ValueError(f"unknown release {release!r}")


def store_path(stub: str, n: int, release: str, corpus: str) -> str:
    return str(Path(stub) / release / corpus / f"{n}gram_files" / f"{n}grams.db")


def listed_files(listings: DataFrame, pattern: str, page_address: str | None = None) -> DataFrame:
    """url and filename, once each by file name, from saved listing pages (`page`): XML keys or HTML links.

    With the address of the listing, keys become addresses of the bucket's objects and links are resolved against it.
    """
    keys, links = F.regexp_extract_all("page", F.lit(r"<Key>([^<]+)</Key>"), 1), F.regexp_extract_all("page", F.lit(r'<a [^>]*href="([^"]+)"'), 1)
    if page_address is not None:
        folder, host = page_address.rsplit("/", 1)[0], "/".join(page_address.split("/")[:3])
        full = lambda u: F.when(u.rlike("^[a-z]+://"), u).when(u.startswith("/"), F.concat(F.lit(host), u)).otherwise(F.concat(F.lit(f"{folder}/"), u))
        keys = F.transform(keys, lambda k: F.concat(F.lit(OBJECTS), k))
        links = F.transform(F.filter(links, lambda u: ~u.rlike(r"^(#|\?|mailto:|javascript:)")), full)
    urls = listings.select(F.explode(F.concat(keys, links)).alias("url")).distinct()
    return urls.withColumn("filename", F.element_at(F.split("url", "/"), -1)).where(F.col("filename").rlike(pattern)).orderBy("filename", "url")


def with_retries(get: Callable[[str], object], address: str, attempts: int = 3, delay: float = 1.0, backoff: float = 2.0, sleep=time.sleep):
    """get(address); an OSError, which network errors are, is tried again after a growing delay, other errors fail at once."""
    for attempt in range(1, attempts + 1):
        try:
            return get(address)
        except OSError as e:
            if attempt == attempts:
                raise RuntimeError(f"gave up on {address} after {attempts} attempts") from e
            sleep(delay)
            delay *= backoff


def listing_pages(get: Callable[[str], str], address: str, **retries) -> Iterator[str]:
    """The pages of a listing: each truncated one names the marker from which the next goes on, else its last key does.

    `get` fetches an address as text: the connector of the site, a cache, or saved pages in tests.
    """
    marker = None
    while True:
        page = with_retries(get, address if marker is None else f"{address}{'&' if '?' in address else '?'}marker={quote(marker, safe='')}", **retries)
        yield page
        named, keys = re.search(r"<NextMarker>([^<]+)</NextMarker>", page), re.findall(r"<Key>([^<]+)</Key>", page)
        if "<IsTruncated>true</IsTruncated>" not in page or not (named or keys):
            return
        marker = named[1] if named else keys[-1]


def list_release(spark: SparkSession, get: Callable[[str], str], n: int, release: str, corpus: str, **retries) -> DataFrame:
    """url and filename of a release's n-gram files, from all pages of its listing."""
    address, pattern = location(n, release, corpus)
    pages = spark.createDataFrame([(p,) for p in listing_pages(get, address, **retries)], "page string")  # a few pages of a thousand names
    return listed_files(pages, pattern, address)


def download(files: DataFrame, get: Callable[[str], bytes], save: Callable[[str, bytes], None], **retries) -> DataFrame:
    """url, bytes and error (null if it went well) of each file, fetched by the tasks through `get` and handed to `save` with its name.

    A file that fails is reported, not raised, so the others go on.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for url, name in zip(pdf["url"], pdf["filename"], strict=True):
                try:
                    data = with_retries(get, url, **retries)
                    save(name, data)
                    rows.append((url, len(data), None))
                except Exception as e:  # noqa: BLE001  the report names it
                    rows.append((url, 0, f"{type(e).__name__}: {e}"))
            yield type(pdf)(rows, columns=["url", "bytes", "error"])

    return files.select("url", "filename").mapInPandas(run, "url string, bytes long, error string")


def next_marker(page: Column) -> Column:
    """Where the next listing page begins, null on the last: its marker, else its last key."""
    marker = F.regexp_extract(page, r"<NextMarker>([^<]+)</NextMarker>", 1)
    keys = F.regexp_extract_all(page, F.lit(r"<Key>([^<]+)</Key>"), 1)
    return F.when(page.contains("<IsTruncated>true</IsTruncated>"), F.when(marker != "", marker).otherwise(F.try_element_at(keys, F.lit(-1))))


def subset(files: DataFrame, bounds: tuple[int, int] | None) -> DataFrame:
    """Files from one place in the order of names to another, both included."""
    if bounds is None:
        return files
    first, last = bounds
    if first < 0 or last < first or last >= files.count():
        raise ValueError(f"bounds {bounds} are outside the listing")
    rows = files.select(F.array_sort(F.collect_list(F.struct("filename", "url"))).alias("f"))  # a listing has a few thousand files at most
    return rows.select(F.inline(F.slice("f", first + 1, last - first + 1))).select("url", "filename")


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger (`file`) does not name."""
    return files.join(ledger.select(F.col("file").alias("filename")), "filename", "left_anti")


def shuffled(files: DataFrame, seed: int) -> DataFrame:
    return files.orderBy(F.md5(F.concat(F.lit(f"{seed}/"), "filename").cast("binary")), "filename")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files (gzip too) that are valid UTF-8, dealt out anew since a gzip file is one task."""
    lines = spark.read.text(path).where(F.is_valid_utf8("value"))
    return lines.repartition(spark.sparkContext.defaultParallelism)


def python_int(text: Column) -> Column:
    """A number as Python reads it: spaces around, a sign, single underscores between digits; null otherwise."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(r"^[+-]?\d+(_\d+)*$"), F.replace(trimmed, F.lit("_"), F.lit("")).try_cast("long"))


def parse_lines(lines: DataFrame, kind: str = "all") -> DataFrame:
    """ngram and freqs, from `value`: the n-gram, a tab, and tab-separated year,matches,volumes.

    The n-gram's type is tested before the records are parsed. Records that are not three numbers are left out; a line
    without any is dropped, and so is one with a negative number.
    """
    text = F.regexp_replace("value", r"^\s+|\s+$", "")
    parts = F.split(text, "\t")
    heads = lines.where(F.size(parts) > 1).select(F.element_at(parts, 1).alias("ngram"), F.slice(parts, 2, 1 << 30).alias("records"))
    heads = heads.where((F.col("ngram") != "") & ngram_type(F.col("ngram"), kind))
    fields = F.transform("records", lambda r: F.split(r, ","))
    numbers = F.transform(F.filter(fields, lambda f: F.size(f) == 3), lambda f: F.transform(f, python_int))
    good = heads.select("ngram", F.filter(numbers, lambda f: F.forall(f, lambda x: x.isNotNull())).alias("numbers"))
    good = good.where((F.size("numbers") > 0) & F.forall("numbers", lambda f: F.forall(f, lambda x: x >= 0)))
    record = lambda f: F.struct(f[0].cast("int").alias("year"), f[1].alias("match_count"), f[2].alias("volume_count"))
    return good.select("ngram", F.transform("numbers", record).alias("freqs"))


def without_metadata(df: DataFrame, column: str = "ngram") -> DataFrame:
    """Rows whose key is no metadata key."""
    return df.where(~F.col(column).startswith("__"))


def year_corpus(spark: SparkSession, path: str) -> DataFrame:
    """freq, doc and year from JSON lines in files named by year."""
    rows = spark.read.schema("ngram string, freq long, doc long").json(path)
    return rows.withColumn("year", F.regexp_extract(F.input_file_name(), r"(\d{4})\.jsonl?", 1).try_cast("int"))


def whitelist_lines(lines: DataFrame, top_n: int | None = None, min_count: int = 1, separator: str = "\t") -> DataFrame:
    """token and total from (rank, value) lines; the first top_n lines count, malformed ones among them."""
    kept = lines if top_n is None else lines.where(F.col("rank") <= top_n)
    parts = F.split("value", separator)
    rows = kept.where(F.size(parts) >= 2).select("rank", parts[0].alias("token"), python_int(parts[1]).alias("total"))
    return rows.where(F.col("total") >= min_count)


def vocabulary_lines(lines: DataFrame) -> DataFrame:
    """token: the first field of every line that is neither blank nor a comment."""
    text = F.trim(F.col("value"))
    return lines.where((text != "") & ~text.startswith("#")).select(F.regexp_extract(text, r"^([^\t]+?)(?:\t.*)?$", 1).alias("head")).select(F.split("head", r"\s+")[0].alias("token"))
