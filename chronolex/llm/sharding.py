"""Consistent-hash ring with virtual nodes and bounded loads, with DataFrame operations only.

The ring has CELLS equal cells; each virtual node owns the cell it hashes to and a document's identifier hashes
to a cell. From its cell a document walks clockwise to the first virtual node whose shard still has room, so
a shard never exceeds its bound and overflow moves no further than it must. All documents of one cell share
the same walk, so the walks of all documents follow from the number of rows in each cell: CELLS numbers,
whatever the input's size. From these the driver derives, for each cell, ranges of ranks and the shard and
first slot of each range; a rank within the cell then gives each row its place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolex.llm.common import cut, documents

SHARDS = 8
VIRTUAL_NODES = 64
#: Cells of the ring: fixed, so that what the driver sees does not grow with the input.
CELLS = 8192
#: Rows of a cell that is ranked in parts, where that is twice the mean too, and parts of a cell at most.
CROWD = 1 << 17
PARTS = 4096


def ring(shards: int, virtual_nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of each virtual node, clockwise."""
    nodes = {}
    for shard in range(shards):
        for v in range(virtual_nodes):
            nodes.setdefault(zlib.crc32(f"shard-{shard}/node-{v}".encode()) * cells >> 32, shard)
    return sorted(nodes.items())


def plan(counts: dict[int, int], shards: int, virtual_nodes: int, cells: int, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, end rank, shard, first slot) for every cell with rows.

    With slack 0 the bounds add up to the rows, so counts are at most one apart; with slack s a shard takes at
    most ceil((1 + s) * rows / shards).
    """
    total = sum(counts.values())
    if slack:
        room = [int(-(-total * (1 + slack) // shards))] * shards
    else:
        room = [total // shards + (s < total % shards) for s in range(shards)]
    nodes = ring(shards, virtual_nodes, cells)
    starts = [c for c, _ in nodes]
    walks = {}
    left = {}
    for cell in counts:
        at = bisect_right(starts, cell - 1) % len(nodes)
        if at not in walks:  # each shard once, in the order in which the walk meets it
            seen = dict.fromkeys(nodes[(at + i) % len(nodes)][1] for i in range(len(nodes)))
            walks[at] = [*seen, *(s for s in range(shards) if s not in seen)]
        left[cell] = (walks[at], 0, counts[cell])
    slots = [0] * shards
    out = []
    for hop in range(shards):  # rows that a full shard sends on meet the next node together
        for cell in sorted(left):
            walk, rank, n = left[cell]
            shard = walk[hop]
            if taken := min(n, room[shard]):
                out.append((cell, rank, rank + taken, shard, slots[shard]))
                room[shard] -= taken
                slots[shard] += taken
                left[cell] = (walk, rank + taken, n - taken)
        left = {c: x for c, x in left.items() if x[2]}
    return out


def bounded_ring(df: DataFrame, id_col: str = "doc_id", shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS, slack: float = 0.0, crowd: int = CROWD) -> DataFrame:
    """Adds shard and slot to every row of df's id and `digest` columns, which order rows within a cell.

    Needs id_col and `digest`, a long that tells rows with the same id apart; rows alike in both are interchangeable. Null ids share one
    cell, whose rows spill over clockwise like any others. Columns of df may have any names; those named shard or slot are replaced. A cell
    with more than `crowd` rows, and twice the mean, is ranked in parts that follow each other. An empty table gives an empty result.
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own_row")
    own, digest = F.col(f"`{id_col}`"), F.col("digest")
    cell = F.shiftrightunsigned(F.xxhash64(F.lit("ring"), own, F.when(own.isNull(), digest)), 64 - (cells.bit_length() - 1)).cast("int")
    rows = df.select(row, cell.alias("cell"), F.xxhash64(own).alias("first"), own.alias("second"), digest.alias("third"), F.monotonically_increasing_id().alias("tie"))
    counted = {r[0]: r[1] for r in rows.groupBy("cell").count().collect()}  # at most `cells` numbers
    pieces = plan(counted, shards, virtual_nodes, cells, slack) or [(0, 0, 0, 0, 0)]
    values = ", ".join(map(str, pieces))
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(cell, first_rank, end_rank, shard, first_slot)")
    table = table.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("first_rank", "end_rank", "shard", "first_slot"))).alias("pieces"))
    most = max(crowd, 2 * sum(counted.values()) // cells)
    parts = {c: min(PARTS, -(-n // most)) for c, n in counted.items() if n > most}  # fewer than cells / 2 of them
    if parts:
        rows = cut(rows)  # the parts of rows alike follow from their places in this table
        split = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, parts.items())) + " AS t(cell, parts)")
        rows = rows.join(F.broadcast(split), "cell", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("tie"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
        sizes = rows.where(F.col("cell").isin(*parts)).groupBy("cell", "part").count()  # PARTS for a crowded cell at most
        before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("cell", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
        rows = rows.join(F.broadcast(starts), ["cell", "part"], "left")
    else:
        rows = rows.withColumn("part", F.lit(0)).withColumn("start", F.lit(0).cast("long"))
    place = F.row_number().over(Window.partitionBy("cell", "part").orderBy("first", "second", "third")) - 1
    ranked = rows.withColumn("rank", F.coalesce("start", F.lit(0)) + place)
    placed = ranked.join(F.broadcast(table), "cell").withColumn(  # at most cells rows
        "piece", F.filter("pieces", lambda p: (p["first_rank"] <= F.col("rank")) & (F.col("rank") < p["end_rank"]))[0]
    )
    return placed.select("own_row.*", F.col("piece.shard").alias("shard"), (F.col("piece.first_slot") + F.col("rank") - F.col("piece.first_rank")).cast("long").alias("slot"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `rows`: bounds of rows / shards, so counts are at most one apart."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"),
    )
    placed = bounded_ring(rows.withColumn("digest", F.xxhash64("size", "text_crc32")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
