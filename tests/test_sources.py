import gzip

import pytest
from pyspark.sql import functions as F

from chronolex.plans import stages
from chronolex.sources import ngrams as src
from chronolex.streaming.intake import stream_lines


def test_lines(spark):
    lines = ["hello\t2000,100,50\t2001,150,60", "", "hello", "\t2000,1,1", "x\tbad\t2000,1,1", "x\t2000,1", "x\t2000,a,1", "y\t 2000 ,1,1", "z\t2000,-1,1\t2001,2,2"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r[0]: [tuple(f) for f in r[1]] for r in src.parse_lines(df).collect()}
    assert got == {"hello": [(2000, 100, 50), (2001, 150, 60)], "x": [(2000, 1, 1)], "y": [(2000, 1, 1)]}


def test_location():
    assert src.location(1, "20200217", "eng") == ("https://books.storage.googleapis.com/?prefix=ngrams/books/20200217/eng/1-", r"^1-\d{5}-of-\d{5}\.gz$")
    index = "https://storage.googleapis.com/books/ngrams/books/datasetsv3.html"
    assert src.location(2, "20120701", "eng") == (index, r"^googlebooks-eng-all-2gram-20120701-\w+\.gz$")
    assert src.location(5, "20090715", "eng-us") == (index, r"^googlebooks-eng-us-all-5gram-20090715-\d+\.csv\.zip$")
    for bad in ((6, "20200217", "eng"), (1, "2020", "eng"), (1, "20200217", "e/g"), (1, "20210101", "eng")):
        with pytest.raises(ValueError):
            src.location(*bad)
    assert src.store_path("/data/ngrams/", 1, "20200217", "eng") == "/data/ngrams/20200217/eng/1gram_files/1grams.db"


def test_listing_pages(spark):
    pages = ["<IsTruncated>true</IsTruncated><Key>a/1-2.gz</Key><NextMarker>m</NextMarker>", "<IsTruncated>true</IsTruncated><Key>a/1-1.gz</Key>", '<a href="http://x/1-2.gz">f</a><a href="/y.txt">']
    df = spark.createDataFrame([(p,) for p in pages], "page string")
    assert [r["filename"] for r in src.listed_files(df, r"\.gz$").collect()] == ["1-1.gz", "1-2.gz", "1-2.gz"]
    assert [r[0] for r in df.select(src.next_marker(F.col("page"))).collect()] == ["m", "a/1-1.gz", None]


def test_subset(spark):
    files = spark.createDataFrame([(f"u{i}", f"f{i}") for i in range(5)], "url string, filename string")
    assert [r["filename"] for r in src.subset(files, (1, 2)).collect()] == ["f1", "f2"]
    assert src.subset(files, None).count() == 5
    with pytest.raises(ValueError):
        src.subset(files, (3, 5))


def test_whitelist_first_lines_then_rules(spark):
    lines = spark.createDataFrame(list(enumerate(["the\t10", "bad", "of\t2", "a\tx"], 1)), "rank int, value string")
    get = lambda **k: {r["token"] for r in src.whitelist_lines(lines, **k).collect()}
    assert get(top_n=2) == {"the"}
    assert get() == {"the", "of"}
    assert get(min_count=3) == {"the"}


def test_ingest_ledger(spark, tmp_path):
    paths = []
    for i, text in enumerate(["a\t2000,1,1\n", "no records here\n"]):
        paths.append(str(tmp_path / f"{i}.gz"))
        with gzip.open(paths[-1], "wt") as f:
            f.write(text)
    files = spark.createDataFrame([(p, p.rsplit("/", 1)[1]) for p in paths], "url string, filename string")
    read = lambda names: src.parse_lines(src.read_lines(spark, names))
    args = (spark, files, read, str(tmp_path / "table"), str(tmp_path / "ledger"))
    assert stages.ingest(*args) == 2
    assert stages.ingest(*args) == 0
    assert stages.taken_in(spark, *args[3:]).count() == 1
    assert [r["file"] for r in stages.taken_files(spark, args[4]).collect()] == ["0.gz", "1.gz"]


def test_an_intake_that_breaks_off_is_taken_again(spark, tmp_path):
    table, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    files = lambda *names: spark.createDataFrame([(n, n) for n in names], "url string, filename string")
    read = lambda names: spark.createDataFrame([(n,) for n in names], "ngram string")
    assert stages.ingest(spark, files("a"), read, table, ledger) == 1
    read(["b"]).write.parquet(f"{table}/intake=2")  # rows without their ledger entry
    assert [r[0] for r in stages.taken_in(spark, table, ledger).collect()] == ["a"]
    assert stages.ingest(spark, files("a", "b", "c"), read, table, ledger) == 2
    assert sorted(r[0] for r in stages.taken_in(spark, table, ledger).collect()) == ["a", "b", "c"]


def test_lister_follows_markers_and_tries_again(spark):
    address = src.location(1, "20200217", "eng")[0]
    pages = {
        address: "<IsTruncated>true</IsTruncated><Key>ngrams/books/20200217/eng/1-00001-of-00002.gz</Key>",
        f"{address}&marker=ngrams%2Fbooks%2F20200217%2Feng%2F1-00001-of-00002.gz": "<Key>ngrams/books/20200217/eng/1-00000-of-00002.gz</Key><Key>x/readme</Key>",
    }
    tried, slept = [], []

    def get(a):
        tried.append(a)
        if len(tried) in (1, 2, 4):
            raise ConnectionError("later")
        return pages[a]

    files = src.list_release(spark, get, 1, "20200217", "eng", sleep=slept.append).collect()
    assert [r["filename"] for r in files] == ["1-00000-of-00002.gz", "1-00001-of-00002.gz"] and slept == [1.0, 2.0, 1.0]
    assert files[0]["url"] == "https://storage.googleapis.com/books/ngrams/books/20200217/eng/1-00000-of-00002.gz"
    with pytest.raises(RuntimeError, match="3 attempts"):
        src.with_retries(lambda a: (_ for _ in ()).throw(OSError("no")), "x", sleep=lambda s: None)
    with pytest.raises(ValueError):
        src.with_retries(lambda a: int("x"), "x")
    page = spark.createDataFrame([('<a href="/b/1-2.gz"><a href="1-1.gz"><a href="#top"><a href="https://y/1-3.gz">',)], "page string")
    assert [r["url"] for r in src.listed_files(page, r"\.gz$", "https://h/a/i.html").collect()] == ["https://h/a/1-1.gz", "https://h/b/1-2.gz", "https://y/1-3.gz"]


def test_download_reports_failures(spark, tmp_path):
    folder = str(tmp_path)

    def get(url):
        if url == "bad":
            raise TimeoutError("slow")
        return url.encode() * 3

    def save(name, data):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)

    files = spark.createDataFrame([("u1", "a"), ("bad", "b")], "url string, filename string")
    rows = {r["url"]: r for r in src.download(files, get, save, attempts=2, delay=0.0).collect()}
    assert rows["u1"]["bytes"] == 6 and rows["u1"]["error"] is None and "2 attempts" in rows["bad"]["error"]
    assert (tmp_path / "a").read_bytes() == b"u1u1u1"


def test_gzip_lines_become_a_year_store(spark, tmp_path):
    with gzip.open(tmp_path / "1.gz", "wb") as f:
        f.write(b"a_NOUN\t2000,1,1\t2001,2,2\n\xff\t2000,1,1\nb\t2001,5,1\n")
    from chronolex.operators import ngrams as ops

    long = ops.pivot_long(src.parse_lines(src.read_lines(spark, str(tmp_path / "1.gz"))))
    store = stages.run_stage(spark, lambda: long, str(tmp_path / "store"), partition_by="year")
    plan = ops.year_scan(store, 2001)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and ops.year_scan(store, 2001).count() == 2
    assert ops.lookup_key(store, "[2001] b").first()["match_count"] == 5 and ops.lookup_key(store, "[2000]").count() == 1
    assert ops.is_empty(store, "c") and not ops.is_empty(store, "a", "b")


def test_queries_scan_the_year_store(spark, sf_dir):
    import __spark_entry__ as entry

    for name in ("year_scan", "year_range_scan", "point_lookup"):
        assert "PartitionFilters: [isnotnull(year" in entry.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()


def test_open_modes_shards_and_archives(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        stages.open_table(spark, path)
    assert stages.open_table(spark, path, "rw") is None
    rows = spark.createDataFrame([("a", 2000, 1, 1)], "ngram string, year int, match_count long, volume_count long")
    rows.write.parquet(path)
    rows.write.parquet(path + "2")
    assert stages.open_table(spark, path).count() == 1
    assert stages.joined_shards(spark, [path, path + "2"]).first()["match_count"] == 2
    (tmp_path / "t2" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="not written whole"):
        stages.joined_shards(spark, [path, path + "2"])
    stages.archive(spark, path, str(tmp_path / "kept"))
    assert any(".zstd." in p.name for p in (tmp_path / "kept").iterdir())
    assert stages.restore(spark, str(tmp_path / "kept"), str(tmp_path / "back")).collect() == rows.collect()
    assert stages.archive_path("/cold", "/hot/2020/eng/1", "/hot/") == "/cold/2020/eng/1"
    stages.compact(rows.unionByName(rows), str(tmp_path / "small"))
    assert spark.read.parquet(str(tmp_path / "small")).count() == 2
    assert stages.open_table(spark, path, "w") is None and not stages.exists(spark, path)
    for bad in (lambda: stages.open_table(spark, path, "x"), lambda: stages.archive_path("/cold", "/elsewhere/x", "/hot")):
        with pytest.raises(ValueError):
            bad()


def test_plans_survive_reprocess_only(spark, tmp_path):
    plan = str(tmp_path / "plans" / "u4.json")
    build = lambda: spark.createDataFrame([("a",)], "ngram string")
    stages.save_plan(plan, {"parts": 4, "bounds": ["40"]})
    assert stages.load_plan(plan) == {"parts": 4, "bounds": ["40"]} and stages.plans(str(tmp_path / "plans")) == ["u4"]
    stages.run_stage(spark, build, str(tmp_path / "s"), "reprocess", plan=plan)
    assert stages.load_plan(plan)
    stages.run_stage(spark, build, str(tmp_path / "s"), "restart", plan=plan)
    assert stages.load_plan(plan) is None and stages.clear_plans(str(tmp_path / "plans")) == 0


def test_year_files_and_sentences(spark, tmp_path):
    for year, lines in ((1990, '{"ngram": "a b", "freq": 3, "doc": 2}\n{"ngram": "c"}\n'), (1991, '{"freq": 5}\n')):
        with gzip.open(tmp_path / f"{year}.jsonl.gz", "wt") as f:
            f.write(lines)
    from chronolex.operators import ngrams as ops

    stats = {r["year"]: tuple(r)[1:] for r in ops.corpus_stats(src.year_corpus(spark, str(tmp_path / "*.gz"))).collect()}
    assert stats == {1990: (2, 3, 2), 1991: (1, 5, 0)}
    made = []
    for _ in range(2):  # what is there already is read, not made again
        kept = stages.run_stage(spark, lambda: made.append(1) or ops.corpus_stats(src.year_corpus(spark, str(tmp_path / "*.gz"))), str(tmp_path / "stats"))
    assert len(made) == 1 and kept.count() == 2
    tokens = spark.createDataFrame([(["a", "b"], 2)], "tokens array<string>, weight long")
    stages.write_sentences(ops.repeated(tokens), str(tmp_path / "s"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "s")).collect()] == ["a b", "a b"]


def test_invalid_utf8_lines_are_left_out(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"a\t2000,1,1\n\xff\xfe\t2000,1,1\n")
    assert [r["ngram"] for r in src.parse_lines(src.read_lines(spark, str(tmp_path / "x.txt"))).collect()] == ["a"]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / "in" / f"{i}.txt").write_text(f"a{i}\t2000,1,1\t2001,2,2\n")
        stream_lines(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "t")).count() == 2 * (i + 1)


def test_stage_modes(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("a", 2000), ("b", 2001)], "ngram string, year int")

    for mode in ("resume", "resume", "restart"):
        out = stages.run_stage(spark, build, str(tmp_path / "s"), mode, partition_by="year")
    assert len(calls) == 2 and out.where("year = 2000").count() == 1
    assert "PartitionFilters: [isnotnull(year" in out.where("year = 2000")._jdf.queryExecution().toString()
    with pytest.raises(RuntimeError):
        stages.reconcile(build(), out.where("year = 2000"), "ngram")
    with pytest.raises(ValueError):
        stages.run_stage(spark, build, str(tmp_path / "s"), "other")


def test_write_whitelist(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "ngram string, total long")
    assert stages.write_whitelist(df, str(tmp_path / "w.txt")) == 3
    assert (tmp_path / "w.txt").read_text() == "c\t9\na\t2\nb\t2\n"
