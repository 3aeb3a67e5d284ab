"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most CAPACITY tokens. Full pieces are sequences of their own; the others go to islands of
about ISLAND pieces by hash. On each island a small population of packings evolves: crossover injects
whole well-filled bins of one parent into the other, removes the bins that hold a piece twice, lets displaced pieces
take the place of smaller ones where a bin gets fuller, and best-fits what is left. After each round most full bins of an island
are settled. The others migrate with ELITE times as many of the full bins, those of the most pieces: they go whole to the islands of the
next round, dealt by hash of the bin, and there form an individual of the first generation, so a good bin of one island is injected into
the packings of another. The last round settles all.
"""

from __future__ import annotations

import base64
import json
import random
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import cut, documents, small_batches

CAPACITY = 1024
END = 2
ISLAND = 4096
POPULATION = 6
GENERATIONS = 16
#: Bins that a displaced piece tries to enter in place of smaller pieces.
TRIES = 24
#: Full bins that migrate with each bin that is not full.
ELITE = 4
#: Free places up to which a bin is settled, by round; the round after these settles all.
SPARES = (0, 2, 8)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of byte_bpe_50k.json with the same ids, that of a special token's string in a text too.

    The ranks stand in the file of the same name for the other library, which is several times as fast.
    """
    import public_tokenizers

    with open(path, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cut_points(length: int, capacity: int) -> list[int]:
    """Starts of a document's pieces: all but the first have `capacity` tokens."""
    first = length % capacity or capacity
    return [0, *range(first, length, capacity)]


PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece of every document: id, piece, start, length, ids_crc32, digest. Null text is empty: the end token alone."""
    small_batches(df.sparkSession)
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            source, cols = [], [[], [], [], []]
            for i, t in enumerate(b.column("text").to_pylist()):
                ids = np.append(enc.encode_to_numpy(t or "", allowed_special="all").astype("<u4"), np.uint32(END))
                starts = cut_points(len(ids), capacity)
                for k, (a, z) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    source.append(i)
                    for c, v in zip(cols, (k, a, z - a, zlib.crc32(ids[a:z].tobytes())), strict=True):
                        c.append(v)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(source, pa.int32())), *map(pa.array, cols, types)], ["id", "piece", "start", "length", "ids_crc32"])

    cols = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, f"id {cols.schema['id'].dataType.simpleString()}, {PIECES}")


class Bins:
    """Bins by free places, so that the tightest one that takes a piece is found at once."""

    def __init__(self, capacity: int, bins: Iterable[tuple[int, list[int]]] = ()):
        self.capacity, self.open, self.mask, self.items = capacity, [[] for _ in range(capacity + 1)], 0, []
        for free, items in bins:
            self._put(free, items)

    def _put(self, free: int, items: list[int]) -> None:
        self.open[free].append(items)
        self.mask |= 1 << free

    def best_fit(self, item: int, size: int) -> None:
        fits = self.mask >> size
        if not fits:
            self._put(self.capacity - size, [item])
            return
        free = size + (fits & -fits).bit_length() - 1
        items = self.open[free].pop()
        if not self.open[free]:
            self.mask ^= 1 << free
        items.append(item)
        self._put(free - size, items)

    def all(self) -> list[tuple[int, list[int]]]:
        return [(free, items) for free, group in enumerate(self.open) for items in group]


def fitness(bins: list[tuple[int, list[int]]], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the more uneven filling."""
    return -len(bins), sum(((capacity - free) / capacity) ** 2 for free, _ in bins)


def replaced(bins: list[tuple[int, list[int]]], displaced: list[int], sizes: list[int], rng: random.Random, tries: int = TRIES) -> list[int]:
    """Lets displaced pieces, largest first, take the place of one or two smaller pieces where a bin gets fuller by that; returns
    the pieces that are displaced in the end. Changes bins in place.
    """
    left = []
    room = [k for k, (free, items) in enumerate(bins) if free and len(items) <= 24]
    for i in sorted(displaced, key=lambda i: (-sizes[i], i)):
        gone = None
        for k in rng.sample(room, min(tries, len(room))):
            free, items = bins[k]
            least = sizes[i] - free  # what has to leave at least, and less than the piece itself
            ones = [(sizes[x], (x,)) for x in items]
            twos = [(sizes[x] + sizes[y], (x, y)) for n, x in enumerate(items) for y in items[:n]]
            fit = [(w, xs) for w, xs in (*ones, *twos) if least <= w < sizes[i]]
            if fit:
                w, gone = min(fit)
                bins[k] = (free + w - sizes[i], [x for x in items if x not in gone] + [i])
                break
        left += gone or (i,)
    return left


def crossover(a: list[tuple[int, list[int]]], b: list[tuple[int, list[int]]], sizes: list[int], capacity: int, rng: random.Random) -> list[tuple[int, list[int]]]:
    """b's well-filled bins go whole into a; a's bins that share a piece with them go, and what they lose finds other places."""
    ranked = sorted(b, key=lambda x: x[0])
    injected = ranked[: max(1, rng.randint(len(ranked) // 4, max(len(ranked) // 4, 3 * len(ranked) // 4)))]
    inside = {i for _, items in injected for i in items}
    kept, displaced = [], []
    for free, items in a:
        if inside.isdisjoint(items):
            kept.append((free, list(items)))
        else:
            displaced += [i for i in items if i not in inside]
    # mutation: the emptiest of the bins that stayed is dissolved too
    if kept:
        displaced += kept.pop(max(range(len(kept)), key=lambda k: kept[k][0]))[1]
    displaced = replaced(kept, displaced, sizes, rng)
    out = Bins(capacity, [*((free, list(items)) for free, items in injected), *kept])
    for i in sorted(displaced, key=lambda i: (-sizes[i], i)):
        out.best_fit(i, sizes[i])
    return out.all()


def evolve(sizes: list[int], capacity: int = CAPACITY, population: int = POPULATION, generations: int = GENERATIONS, seed: int = 1, migrants: list[list[int]] | None = None) -> list[tuple[int, list[int]]]:
    """(free places, items) of each bin of the best packing found; ends when it reaches the lower bound.

    migrants, bins that hold all pieces, are an individual of the first generation.
    """
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    people = [[(capacity - sum(sizes[i] for i in items), items) for items in migrants]] if migrants else []
    for p in range(population - len(people)):
        bins = Bins(capacity)
        # the first is best fit by falling size; the others start from orders that are shuffled a little
        for i in order if not p else sorted(order, key=lambda i: -sizes[i] * rng.uniform(1 - 0.1 * p, 1)):
            bins.best_fit(i, sizes[i])
        people.append(bins.all())
        if len(people[-1]) <= least:
            return people[-1]
    for _ in range(generations):
        people.sort(key=lambda x: fitness(x, capacity), reverse=True)
        if len(people[0]) <= least:
            break
        half = people[: max(2, population // 2)]
        people = [*half, *(crossover(*rng.sample(half, 2), sizes, capacity, rng) for _ in range(population - len(half)))]
    return max(people, key=lambda x: fitness(x, capacity))


PLACED = "sequence_id long, offset long, free int"


def pack(rows: DataFrame, capacity: int = CAPACITY, island: int = ISLAND, spares: tuple[int, ...] = SPARES) -> DataFrame:
    """Adds sequence_id and offset to rows of pieces; rows has id, piece, start, length and ids_crc32.

    rows is cut first, so all rounds see the same pieces. Islands form by hash of a row number of the cut table, so repeated rows spread,
    and later by hash of the bin; each holds about `island` pieces whatever the input, and ranges of islands go to tasks.
    An empty table gives an empty result. Sequence ids are numbers without order.
    """
    rounds = len(spares) + 1
    rows = cut(rows.withColumn("number", F.monotonically_increasing_id()))
    schema = rows.schema
    full = rows.where(F.col("length") >= capacity).withColumn("sequence_id", F.col("number")).withColumn("offset", F.lit(0).cast("long"))
    left = rows.where(F.col("length") < capacity).withColumn("bin", F.col("number"))
    done = []
    keep = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)

    def settle(table: pa.Table) -> pa.Table:
        round_ = table["round"][0].as_py()
        table = table.sort_by("number")
        sizes, numbers = table["length"].to_pylist(), table["number"].to_pylist()
        last = round_ == rounds - 1
        order, sequence, offset, free = [], [], [], []
        came: dict[int, list[int]] = {}
        for i, name in enumerate(table["bin"].to_pylist()):
            came.setdefault(name, []).append(i)
        bins = evolve(sizes, capacity, seed=table["island"][0].as_py() * 31 + round_, migrants=list(came.values()) if round_ else None)
        stays = [last or f <= spares[round_] for f, _ in bins]
        # elite bins of many pieces migrate with those that are not full: their small pieces fit in many places
        elite = sorted((k for k, s in enumerate(stays) if s), key=lambda k: (-len(bins[k][1]), k))
        for k in elite[: 0 if last else ELITE * (len(bins) - len(elite))]:
            stays[k] = False
        for (f, items), s in zip(bins, stays, strict=True):
            at, name = 0, numbers[items[0]]  # the number of a bin's first piece names it
            for i in items:
                order.append(i)
                sequence.append(name)
                offset.append(at)
                free.append(0 if s else max(f, 1))
                at += sizes[i]
        out = table.drop_columns(["island", "round", "bin"]).take(pa.array(order, pa.int64()))
        for name, values, kind in (("sequence_id", sequence, pa.int64()), ("offset", offset, pa.int64()), ("free", free, pa.int32())):
            out = out.append_column(name, pa.array(values, kind))
        return out

    for r in range(rounds):
        count = left.count()
        if not count:
            break
        islands = -(-count // island)
        if islands == 1:
            r = rounds - 1
        dealt = left.withColumn("island", F.pmod(F.xxhash64("bin", F.lit(r)), F.lit(islands)).cast("int")).withColumn("round", F.lit(r))
        placed = cut(dealt.repartitionByRange("island").groupBy("island").applyInArrow(settle, f"{keep}, {PLACED}"))
        done.append(placed.where("free = 0").drop("free"))
        if r == rounds - 1:
            break
        left = placed.where("free > 0").select(*schema.names, F.col("sequence_id").alias("bin"))
    for d in done:
        full = full.unionByName(d)
    return full.drop("number")


def packed(df: DataFrame) -> DataFrame:
    found = pack(pieces(df))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the training sequences, one row per piece of a document."""
    return packed(docs)
