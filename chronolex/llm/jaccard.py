"""N-gram Jaccard join as a metric-space join, exact.

A document is the set of its word shingles; 1 - Jaccard is a metric on sets, and so is the size of the symmetric difference.
Texts that share nothing are all at distance 1, so whole documents alone as pivots would put every document into every window. The join
therefore has two kinds of pivots:

1. Single shingles, the smallest points of the space. A set x is at distance 1 - 1/|x| from each of its shingles and at distance
   1 from all others; ties are broken by a global order, frequent shingles last. Within the threshold's radius a partner misses few enough of
   x's shingles that the first shingle they share is among the first |x| - ceil(t|x|) + 1 of both: the window over whose regions
   x is replicated. A region of at most REGION sets compares their sizes and the places of the shared pivot. A larger region is
   dissolved: its pivot moves to the end of the order, and sets that it concerns meet again at their next pivots.
2. Documents, for regions whose pivot has moved: clouds of near copies, and texts made of passages that many share. Every region
   draws PIVOTS of its members. All members find their distances from these in the space of cell counts, a metric that
   bounds the symmetric difference from below. Each member is tested against the NEAREST pivots by whole sets. What that leaves
   outside a region's main component lies in the Voronoi cell of its nearest pivot and, by the triangle inequality, can only have partners in
   cells whose pivot is at most twice the radius farther away: it is replicated to these. Cells with much left are
   joined the same way, by pivots of their own, LEVELS times at most; then blocks of BLOCK sets meet, pruned by their distances from all pivots.

Every link is verified on the whole sets. Sets are 64-bit fingerprints of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import cut, documents, few, small_batches, sweep
from chronolex.llm.graph import components
from chronolex.llm.shingles import sets

REGION = 64
#: Shingles of a chunk of documents that are counted together, and sets of it that must share one for it to count as frequent.
CHUNK_SHINGLES = 1 << 21
CHUNK_SHARED = 2
#: Rows of regions that are compared at a time.
MEET_ROWS = 1 << 16
CELLS = 64
#: Documents of a region that are its pivots, the nearest of them that a member is tested against, and times that Voronoi cells are dealt.
PIVOTS = 8
NEAREST = 3
LEVELS = 3
#: Share of the comparisons that dealing a region by Voronoi cells may leave at most; else it meets in blocks as it is.
GAIN = 0.6
BLOCK = 1024
#: Parts that the members of a region are dealt into where they meet its pivots.
SALTS = 16
#: Nearest members of other components that a query is tested against in each pass; the last pass tests all that are left.
PASSES = (8, None)
#: Sizes of the bitmaps that are broadcast, in bits, whatever the input.
MOVED_BITS = 1 << 23
NEXT_BITS = 1 << 25
NEEDED_BITS = 1 << 23


def window(n: int, num: int, den: int) -> int:
    """Pivots over whose regions a set of n shingles is replicated, for similarity num / den."""
    return n - -(-num * n // den) + 1 if n else 0


def bitmap(df: DataFrame, value: str, bits: int) -> np.ndarray:
    """Bytes whose bit (value mod bits) is set for every value; built in blocks on the executors."""
    block = min(bits, 1 << 15)

    def build(table: pa.Table) -> pa.Table:
        flags = np.zeros(block, np.uint8)
        flags[table["at"].to_numpy()] = 1
        return pa.table({"block": table["block"][:1], "data": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    place = F.pmod(F.col(value), F.lit(bits))
    places = df.select((place / block).cast("long").alias("block"), (place % block).cast("int").alias("at")).distinct()
    out = np.zeros(bits // block * (block // 8), np.uint8)
    for r in places.groupBy("block").applyInArrow(build, "block long, data binary").collect():  # bits / 8 bytes at most
        out[r[0] * (block // 8) : (r[0] + 1) * (block // 8)] = np.frombuffer(r[1], np.uint8)
    return out


def moved_bits(counts: DataFrame) -> np.ndarray:
    """Bitmap of the pivots whose count is above half of REGION; of the most frequent ones alone where the bitmap would fill up."""
    often = counts.where(F.col("c") > REGION // 2)
    by_power = often.groupBy(F.floor(F.log2("c")).alias("power")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("power")).collect()  # one row a power of two
    room, least = MOVED_BITS // 8, None
    for power, n in by_power:
        room -= n
        if room < 0:
            least = 1 << power + 1
            break
    return bitmap(often if least is None else often.where(F.col("c") >= least), "pivot", MOVED_BITS)


def has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) & np.uint64(len(bits) * 8 - 1)  # the number of bits is a power of two
    return bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1 == 1


def cells(s: np.ndarray) -> bytes:
    """Counts of the shingles in equal parts of their space, up to 255: L1 differences bound the symmetric difference from below.

    A power of two of parts, n / 8 at least and CELLS at least: with fewer, chance differences of long texts stay under the radius.
    """
    k = max(CELLS, 1 << max(0, (len(s) - 1) // 8).bit_length())
    return np.minimum(np.bincount((s.view(np.uint64) >> np.uint64(65 - k.bit_length())).astype(np.int64), minlength=k), 255).astype(np.uint8).tobytes()


def fold(c: np.ndarray, k: int) -> np.ndarray:
    return c.reshape(k, -1).sum(axis=1, dtype=np.int64)


def apart(x: bytes, y: bytes) -> int:
    """Least size of the symmetric difference by the cells of two sets, in the parts of the coarser one."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    k = min(len(a), len(b))
    return int(np.abs(fold(a, k) - fold(b, k)).sum())


def coarse(rows: list[bytes]) -> np.ndarray:
    """Cells of all sets at the same resolution, CELLS parts: L1 distances between them are a metric."""
    return np.stack([fold(np.frombuffer(c, np.uint8), CELLS) for c in rows]) if rows else np.zeros((0, CELLS), np.int64)


def first_pivots(s: np.ndarray, moved: np.ndarray, num: int, den: int) -> np.ndarray:
    """The window of a sorted set in the order: pivots that did not move, by fingerprint, then those that did."""
    k = window(len(s), num, den)
    hit = has(moved, s)
    return np.concatenate([s[~hit], s[hit]])[:k] if hit[: k + 1].any() else s[:k]


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def digest(s: np.ndarray, seed: int) -> tuple[int, int]:
    """(key, check) of a set."""
    h = xxhash.xxh3_128_intdigest(s.tobytes(), seed)
    return signed(h & (1 << 64) - 1), signed(h >> 64)


def survey(df: DataFrame, words: int, seed: int) -> DataFrame:
    """One pass over the texts with two kinds of rows: id, n, key, check and cells of every document, and pivot and c of frequent shingles.

    Cells come with the first document of a key in its task. A shingle is frequent that CHUNK_SHARED different sets of a chunk share; c is their number.
    """
    id_type = df.schema["id"].dataType.simpleString()
    names = ["id", "n", "key", "check", "cells", "pivot", "c"]

    def count(held: list[np.ndarray], ids: pa.DataType) -> pa.RecordBatch:
        values, times = np.unique(np.concatenate(held), return_counts=True)
        ok = times >= CHUNK_SHARED
        none = lambda kind: pa.nulls(int(ok.sum()), kind)
        return pa.RecordBatch.from_arrays([none(ids), none(pa.int32()), none(pa.int64()), none(pa.int64()), none(pa.binary()), pa.array(values[ok]), pa.array(times[ok])], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        held, size, kind = [], 0, None
        for b in batches:
            kind = b.column("id").type
            n, keys, checks, parts = [], [], [], []
            for s in sets(b.column("text").to_pylist(), words):
                key, check = digest(s, seed)
                fresh = key not in known and len(s) > 0
                n.append(len(s))
                keys.append(key)
                checks.append(check)
                parts.append(cells(s) if fresh else None)
                if fresh:
                    known.add(key)
                    held.append(s)
                    size += len(s)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int32()), pa.array(keys, pa.int64()), pa.array(checks, pa.int64()), pa.array(parts, pa.binary()), none, none], names)
            if size >= CHUNK_SHINGLES:
                yield count(held, kind)
                held, size = [], 0
        if held:
            yield count(held, kind)

    return df.mapInArrow(run, f"id {id_type}, n int, key long, check long, cells binary, pivot long, c long")


def region_rows(df: DataFrame, moved, only, words: int, num: int, den: int, seed: int) -> DataFrame:
    """pivot, key, n and place (in the order) for every pivot of a set's window; n is 0 where the pivot has moved.

    With `only`, a bitmap, just the rows of pivots that it has or that have moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for b in batches:
            rows: list[tuple] = []
            for s in sets(b.column("text").to_pylist(), words):
                key = digest(s, seed)[0]
                if not len(s) or key in known:
                    continue
                known.add(key)
                w = first_pivots(s, moved.value, num, den)
                cloud = has(moved.value, w)
                at = np.flatnonzero(cloud | has(only.value, w)) if only is not None else np.arange(len(w))
                rows.append((w[at], np.full(len(at), key), np.where(cloud[at], 0, len(s)).astype(np.int32), at.astype(np.int32)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows, strict=True)], ["pivot", "key", "n", "place"])

    return df.select("text").mapInArrow(run, "pivot long, key long, n int, place int")


def next_pivots(df: DataFrame, before, after, words: int, num: int, den: int) -> DataFrame:
    """pivot: what did not move of the new windows of sets that had a pivot in their window that moved since."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = after.value & ~before.value
        for b in batches:
            rows = []
            for s in sets(b.column("text").to_pylist(), words):
                if len(s) and has(new, first_pivots(s, before.value, num, den)).any():
                    w = first_pivots(s, after.value, num, den)
                    rows.append(w[~has(after.value, w)])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(rows)))], ["pivot"])

    return df.select("text").mapInArrow(run, "pivot long")


PAIR, CLOUD, LARGE = 0, 1, 2


def meetings(rows: DataFrame, num: int, den: int) -> DataFrame:
    """What region_rows gives for regions: (PAIR, a, b) of keys that sizes and places do not rule out, (CLOUD, pivot, key) of moved
    pivots, and (LARGE, pivot, key) of regions with more than REGION sets.

    If x and y are linked and share a pivot first at places i and j, they share no more than 1 + min(|x| - i, |y| - j) - 1 shingles.
    Rows of moved pivots are spread over all tasks; those of others lie sorted, and no more than MEET_ROWS and a region's rest are held.
    """

    def close(p, k, n, at) -> list[np.ndarray]:
        left, right, i = [], [], np.arange(len(p) - 1)
        for d in range(1, REGION):
            i = i[i + d < len(p)]
            i = i[(p[i] == p[i + d]) & (den * n[i] >= num * n[i + d])]  # sizes rise within a region
            if not len(i):
                break
            need = -(-num * (n[i] + n[i + d]) // (num + den))
            ok = i[(n[i] - at[i] >= need) & (n[i + d] - at[i + d] >= need)]
            left.append(np.minimum(k[ok], k[ok + d]))
            right.append(np.maximum(k[ok], k[ok + d]))
        return list(np.unique(np.stack([np.concatenate(left), np.concatenate(right)], axis=1), axis=0).T) if left else [p[:0], p[:0]]

    def batch(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], ["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, large = 0, None  # the pivot of a region that is known to be large and goes on

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, large
            p, k, n, at = (np.concatenate(x) for x in zip(*held, strict=True))
            cloud = n == 0
            if cloud.any():
                yield batch(CLOUD, p[cloud], k[cloud])
                p, k, n, at = (x[~cloud] for x in (p, k, n, at))
            order = np.lexsort((k, n, p))
            p, k, n, at = (x[order] for x in (p, k, n, at))
            fresh = np.r_[True, (p[1:] != p[:-1]) | (k[1:] != k[:-1])][: len(p)]
            p, k, n, at = (x[fresh] for x in (p, k, n, at))
            held, size = [], 0
            if not len(p):
                return
            starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            counts = np.diff(np.r_[starts, len(p)])
            most = (counts > REGION) | (p[starts] == large if large is not None else False)
            open_ = not last and not most[-1]  # the last region may go on
            big = np.repeat(most, counts)
            if big.any():
                yield batch(LARGE, p[big], k[big])
            large = p[-1] if most[-1] else None
            small = ~big
            if open_:
                small[starts[-1] :] = False
                held = [tuple(x[starts[-1] :] for x in (p, k, n, at))]
                size = len(held[0][0])
            yield batch(PAIR, *close(*(x[small] for x in (p, k, n, at))))

        for b in batches:
            held.append((b.column("pivot").to_numpy(), b.column("key").to_numpy(), b.column("n").to_numpy().astype(np.int64), b.column("place").to_numpy().astype(np.int64)))
            size += len(b)
            if size >= MEET_ROWS:
                yield from settle(False)
        if held:
            yield from settle(True)

    to = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("pivot"))
    return rows.repartition(to).sortWithinPartitions("pivot").mapInArrow(run, "kind int, a long, b long").distinct()


def near(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) pairs that the sizes and all cells of their sets do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("na", "nb", "ca", "cb")), strict=True)
            ok = [den * min(m, n) >= num * max(m, n) and (den + num) * apart(x, y) <= (den - num) * (m + n) for m, n, x, y in rows]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    a = nodes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("cells").alias("ca"))
    b = nodes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("cells").alias("cb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, nodes: DataFrame, df: DataFrame, words: int, num: int, den: int, seed: int) -> DataFrame:
    """The (a, b) pairs whose sets have den * common >= num * union; pairs is cut.

    Texts that a bitmap of the ids rules out are not exchanged; the others meet their key by id, and are shingled then.
    """
    spark = df.sparkSession
    pairs = few(pairs)
    keys = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = cut(few(keys.join(nodes.select("key", "rep"), "key").withColumn("place", F.xxhash64("rep"))))
    needed = spark.sparkContext.broadcast(bitmap(wanted, "place", NEEDED_BITS))

    def ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(has(needed.value, np.asarray(b.column("place")))))
            if len(b):
                yield b.select(["id", "text"])

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = sets(b.column("text").to_pylist(), words)
            ok = [digest(s, seed)[0] == k for s, k in zip(found, b.column("key").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("key").filter(pa.array(ok, pa.bool_())), pa.array([s.tobytes() for s, o in zip(found, ok, strict=True) if o], pa.binary())], ["key", "set"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                k = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * k >= num * (len(x) + len(y) - k))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    id_type = df.schema["id"].dataType.simpleString()
    texts = df.withColumn("place", F.xxhash64("id")).mapInArrow(ruled, f"id {id_type}, text string")
    texts = texts.join(wanted.select("rep", "key"), F.col("id") == F.col("rep")).select("key", "text")
    held = texts.mapInArrow(shingled, "key long, set binary").groupBy("key").agg(F.first("set").alias("set"))
    a = held.select(F.col("key").alias("a"), F.col("set").alias("x"))
    b = held.select(F.col("key").alias("b"), F.col("set").alias("y"))
    out = cut(pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))
    needed.destroy()
    return out


def radius(n: Column, num: int, den: int) -> Column:
    """Largest symmetric difference of a set of n shingles and any partner."""
    return F.floor(n * (den - num) / num)


def with_pivots(members: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Adds to members (g, key, n, cells, ...) d, the coarse distances from their region's pivots, and stars, the nearest pivots that
    cells do not rule out. Pivots are PIVOTS members of the region, by hash; a region is spread over SALTS tasks where it meets them.
    """
    masks = np.random.default_rng(5).integers(-(1 << 62), 1 << 62, PIVOTS).tolist()
    drawn = members.groupBy("g").agg(*[F.min(F.col("key").bitwiseXOR(F.lit(m))).alias(f"p{i}") for i, m in enumerate(masks)])
    drawn = drawn.select("g", F.explode(F.array_distinct(F.array(*[F.col(f"p{i}").bitwiseXOR(F.lit(m)) for i, m in enumerate(masks)]))).alias("key"))
    drawn = drawn.join(nodes.select("key", "n", "cells"), "key").groupBy("g").agg(F.array_sort(F.collect_list(F.struct("key", "n", "cells"))).alias("pivots"))  # PIVOTS at most
    drawn = drawn.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    names = [c for c in members.columns if c not in ("d", "stars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, stars = [], []
            own = coarse(b.column("cells").to_pylist())
            for i, (key, n, fine, pivots) in enumerate(zip(*(b.column(c).to_pylist() for c in ("key", "n", "cells", "pivots")), strict=True)):
                d.append(np.abs(own[i] - coarse([p["cells"] for p in pivots])).sum(axis=1).tolist())
                ranked = sorted(((apart(fine, p["cells"]) / (n + p["n"]), p["key"]) for p in pivots if p["key"] != key and den * min(n, p["n"]) >= num * max(n, p["n"])))
                stars.append([k for x, k in ranked[:NEAREST] if (den + num) * x <= den - num + 1e-9])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(d, pa.list_(pa.int64())), pa.array(stars, pa.list_(pa.int64()))], [*names, "d", "stars"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema if f.name in names)
    met = members.select(*names).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(drawn, ["g", "salt"])
    return met.mapInArrow(run, f"{schema}, d array<long>, stars array<long>")


def regions_of(rows: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """Members of the regions of moved pivots with their distances, from (pivot, key) rows.

    Regions with the same smallest key are one, and then those with the same smallest region of any of their members, as near copies share many pivots.
    """
    heads = rows.groupBy("pivot").agg(F.min("key").alias("g"))
    members = few(cut(rows.join(heads, "pivot").select("g", "key").distinct()))
    least = members.groupBy("key").agg(F.min("g").alias("least"))
    joined = members.join(least, "key").groupBy("g").agg(F.min("least").alias("least"))
    members = few(cut(members.join(joined, "g").select(F.col("least").alias("g"), "key").distinct()))
    return cut(with_pivots(members.join(nodes.select("key", "n", "cells"), "key").select("g", "key", "n", "cells"), nodes, num, den))


def across(members: DataFrame, roots: DataFrame, nodes: DataFrame, num: int, den: int, limit: int | None) -> DataFrame:
    """(a, b) pairs of a region's members in different components that windows, sizes and all cells do not rule out, and a row of
    nulls where `limit` left some out.

    Members outside the main component of their region are queries; each gives its `limit` nearest partners by cells, or all.
    """
    members = members.drop("stars").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    sizes = members.groupBy("g", "root").agg(F.count(F.lit(1)).alias("c"))
    main = sizes.groupBy("g").agg(F.max(F.struct("c", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("g", "main")
    main = main.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = members.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(main, ["g", "salt"]).drop("salt")
    rows = few(cut(rows.withColumn("asks", F.col("root") != F.col("main")).drop("main")))
    natives, queries = rows.drop("asks"), rows.where("asks").drop("asks")
    for level in range(LEVELS):
        # what dealing a region by its pivots would leave to compare, against all its queries and members
        home, inside = F.array_position("d", F.array_min("d")), lambda i: F.coalesce(F.get("d", F.lit(i)) <= F.array_min("d") + 2 * radius(F.col("n"), num, den), F.lit(False))
        cells_ = range(PIVOTS)
        owned = natives.groupBy("g").agg(F.count(F.lit(1)).alias("all"), *[F.count_if(home == i + 1).alias(f"n{i}") for i in cells_])
        wanted = queries.groupBy("g").agg(F.count(F.lit(1)).alias("asked"), *[F.count_if(inside(i)).alias(f"q{i}") for i in cells_])
        dealt = sum((F.col(f"n{i}").cast("double") * F.col(f"q{i}") for i in cells_), F.lit(0.0))
        gain = (F.col("all") > BLOCK) & (F.col("asked") > BLOCK) & (dealt < GAIN * F.col("all") * F.col("asked"))
        large = cut(owned.join(wanted, "g").where(gain).select("g"))
        if large.isEmpty():
            break
        large = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("deal", F.lit(True))
        marked = lambda t: t.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(large, ["g", "salt"], "left").drop("salt")
        natives, queries = marked(natives), marked(queries)
        renamed = F.when(F.col("deal"), F.xxhash64("g", "j", F.lit(level))).otherwise(F.col("g"))
        windows = F.when(F.col("deal"), F.array_compact(F.array(*[F.when(inside(i), i + 1) for i in cells_]))).otherwise(F.array(F.lit(0)))
        natives = natives.withColumn("j", home.cast("int")).withColumn("g", renamed).drop("j")
        queries = queries.withColumn("j", F.explode(windows)).withColumn("g", renamed).drop("j")
        natives, queries = few(cut(natives)), few(cut(queries))
        # the cells draw pivots of their own
        again = natives.where("deal").unionByName(queries.where("deal")).drop("deal").dropDuplicates(["g", "key"])
        drawn = cut(with_pivots(again, nodes, num, den)).select("g", "key", F.col("d").alias("own"))
        natives, queries = (t.join(drawn, ["g", "key"], "left").withColumn("d", F.coalesce("own", "d")).drop("own", "deal") for t in (natives, queries))
    counts = cut(natives.groupBy("g").agg(F.count(F.lit(1)).alias("all")).join(queries.groupBy("g").agg(F.count(F.lit(1)).alias("asked")), "g"))
    # blocks of queries meet blocks of members, as many as either has
    counts = counts.select("g", F.ceil(F.col("all") / BLOCK).cast("int").alias("ms"), F.ceil(F.col("asked") / BLOCK).cast("int").alias("qs"))
    counts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    natives, queries = (t.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(counts, ["g", "salt"]).drop("salt") for t in (natives, queries))
    part = lambda name, of: F.pmod(F.xxhash64("key", F.lit(name)), F.col(of)).cast("int")
    span = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    queries = queries.withColumn("q", part("q", "qs")).withColumn("m", span("ms")).withColumn("asks", F.lit(True))
    natives = natives.withColumn("m", part("m", "ms")).withColumn("q", span("qs")).withColumn("asks", F.lit(False))
    met = queries.unionByName(natives).select("g", "q", "m", "asks", "key", "root", "n", "cells", "d").repartition("g", "q", "m")

    def block(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False).astype(bool)
        key, root = table["key"].to_numpy(), table["root"].to_numpy()
        n = table["n"].to_numpy().astype(np.int64)
        fine = table["cells"].to_pylist()
        c, d = coarse(fine), np.array(table["d"].to_pylist(), np.int64)
        here = np.flatnonzero(~asks)
        a, b = [], []
        for i in np.flatnonzero(asks):
            j = here[(root[here] != root[i]) & (den * np.minimum(n[here], n[i]) >= num * np.maximum(n[here], n[i]))]
            most = (den - num) * (n[j] + n[i])  # (den + num) times the largest symmetric difference
            j = j[(den + num) * np.abs(d[j] - d[i]).max(axis=1, initial=0) <= most]  # triangle inequality, by every pivot
            j = j[(den + num) * np.abs(c[j] - c[i]).sum(axis=1) <= (den - num) * (n[j] + n[i])]
            ranked = sorted((x, key[k]) for x, k in ((apart(fine[i], fine[k]) / (n[i] + n[k]), k) for k in j) if (den + num) * x <= den - num + 1e-9)
            for _, other in ranked[:limit]:
                a.append(min(key[i], other))
                b.append(max(key[i], other))
            if limit is not None and len(ranked) > limit:
                a.append(None)
                b.append(None)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.groupBy("g", "q", "m").applyInArrow(block, "a long, b long").distinct()


def jaccard_links(df: DataFrame, words: int, num: int, den: int, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, nodes, components) of a table of id and text.

    documents: id, n, key; nodes: key, rep (smallest id), n; components: (node, root) of the keys of sets that are linked. A link
    within a component that others hold together may be left untested.
    """
    spark = df.sparkSession
    small_batches(spark)
    share = spark.sparkContext.broadcast
    found = cut(survey(df, words, seed))
    base = found.where("key IS NOT NULL").select("id", "n", "key", "check", "cells")
    nodes = base.where("n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.max("cells").alias("cells"), (F.min("check") != F.max("check")).alias("clash"))
    nodes = cut(nodes)
    if not nodes.where("clash").isEmpty():  # two sets with one key: take other keys
        return jaccard_links(df, words, num, den, seed + 1)
    moved = share(moved_bits(cut(found.where("key IS NULL").groupBy("pivot").agg(F.sum("c").alias("c")).where(F.col("c") > 2))))
    met = cut(meetings(region_rows(df, moved, None, words, num, den, seed), num, den))
    pairs, clouds = met.where(F.col("kind") == PAIR), met.where(F.col("kind") == CLOUD)
    large = moved_bits(met.where(F.col("kind") == LARGE).groupBy(F.col("a").alias("pivot")).agg(F.count(F.lit(1)).alias("c")))
    if large.any():  # dissolved: sets that met there meet all others again at the pivots that are now in their windows
        after = share(moved.value | large)
        only = share(bitmap(next_pivots(df, moved, after, words, num, den), "pivot", NEXT_BITS))
        again = cut(meetings(region_rows(df, after, only, words, num, den, seed), num, den))
        pairs, clouds = pairs.unionByName(again.where(F.col("kind") == PAIR)).distinct(), again.where(F.col("kind") != PAIR)
        only.destroy()
        after.destroy()
    moved.destroy()
    members = regions_of(clouds.select(F.col("a").alias("pivot"), F.col("b").alias("key")), nodes, num, den)
    stars = members.select("key", F.explode("stars").alias("p")).select(F.least("key", "p").alias("a"), F.greatest("key", "p").alias("b"))
    asked = cut(few(near(few(pairs.select("a", "b")), nodes, num, den).unionByName(stars).distinct()))
    sweep(spark)
    links = verify(asked, nodes, df, words, num, den, seed)
    roots = components(links)
    if not members.isEmpty():
        for limit in PASSES:
            sweep(spark)
            found = cut(few(across(members, roots, nodes, num, den, limit)))
            asked = found.where("a IS NOT NULL")
            if asked.isEmpty():
                break
            fresh = verify(asked, nodes, df, words, num, den, seed)
            if not fresh.isEmpty():
                # links of components stand for all links so far
                links = cut(few(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(fresh)))
                roots = components(links)
            if found.where("a IS NULL").isEmpty():
                break
    return base.select("id", "n", "key"), nodes.select("key", "rep", "n"), roots


def jaccard_components(df: DataFrame, words: int, num: int, den: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id (smallest id reachable by links of similarity num / den or more) of every row.

    Null and wordless texts have no shingles and are linked with nothing. Rows with a null id take no part: their
    component is null. Repeated rows share a component; an empty table gives an empty result. Other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    base, nodes, roots = jaccard_links(rows.where(F.col("id").isNotNull()), words, num, den)
    named = nodes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("key", "component_id")
    out = base.join(named, "key", "left").select("id", F.col("n").cast("long").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component_id")), "id").alias("component_id"))
    lost = rows.where(F.col("id").isNull()).select("id", F.lit(None).cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    return out.unionByName(lost).withColumnRenamed("id", id_col)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), words=4, num=85, den=100)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies (five words, similarity 0.8 or more) the smallest id stays.

    A repeated row with that id stays once; a row with a null id stays.
    """
    found = jaccard_components(docs, words=5, num=80, den=100)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("own_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("own_gone"), "left_anti")
