"""Transcript parsing: a hidden Markov model recovers the roles of a conversation's blocks, then turns are rendered.

A block is what one speaker says at a stretch: a turn whose role is unknown, or in a raw transcript the lines from a speaker
marker or a blank line to the next. Its observations are the class of its speaker marker and features of its lines. Emissions
and transitions are counted from labelled conversations; Viterbi finds the most likely roles.

The best score from one role before a stretch of blocks to another after it is a small max-plus matrix, and such matrices
multiply in any grouping. So a conversation longer than SEGMENT turns is cut into segments; their matrices alone
meet in one place, and every segment is then decoded on its own between the roles at its ends.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import cut, held_out, small_batches

ROLES = ("system", "user", "assistant")
SEGMENT = 4096
#: Documented bound of the training sample, in conversations; a conversation counts with its first TRAIN_TURNS turns by number.
TRAIN_CONVERSATIONS = 4000
TRAIN_TURNS = 64

MARKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "prompt", "me", "you"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model", "response"),
}
MARKER_OF = {name: role for role, names in MARKERS.items() for name in names}
# Runs of blanks and marks are possessive: a line that has no marker is given up after one look at each of its characters.
MARKER = re.compile(r"^\s*+(?:(?:<\|im_start\|>|[#>*\[<(|])++\s*+)?+([A-Za-z]{1,12})\s*+(?:[\])>*|]*+\s*+:[\])>*|]*+|[\])>|]++)\s*+", re.ASCII)
FEATURES = (4, 10, 6, 2, 2, 4)  # number of values of each observation


def marker(line: str) -> tuple[str, str]:
    """(role or empty, rest of the line without the marker)."""
    m = MARKER.match(line)
    role = MARKER_OF.get(m[1].lower(), "") if m else ""
    return (role, line[m.end() :]) if role else ("", line)


def blocks(transcript: str) -> list[tuple[str, str]]:
    """(marker's role or empty, text) of each block of a raw transcript; a blank line or a marker begins one."""
    out: list[tuple[str, list[str]]] = []
    fresh = True
    for line in transcript.splitlines():
        role, rest = marker(line)
        if not line.strip():
            fresh = True
        elif role or fresh:
            out.append((role, [rest]))
            fresh = False
        else:
            out[-1][1].append(line)
    return [(r, "\n".join(x).strip()) for r, x in out if r or "".join(x).strip()]


def observe(role: str, text: str, first: bool) -> tuple[int, ...]:
    lines = text.count("\n") + 1 if text else 0
    words = text.count(" ") + lines
    return (
        ("", *ROLES).index(role),
        min(9, int(2 * math.log10(words + 1) + 0.5)),
        min(5, lines),
        int("?" in text),
        int(first),
        min(3, words // max(1, lines) // 8),
    )


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def scores(self, seen: list[tuple[int, ...]]) -> np.ndarray:
        table = np.array(seen, int).reshape(-1, len(FEATURES))
        return sum(e[:, table[:, k]] for k, e in enumerate(self.emit)).T

    def matrix(self, emissions: np.ndarray) -> np.ndarray:
        """Best score from each role before the blocks to each role of the last one."""
        m = self.step + emissions[0]
        for e in emissions[1:]:
            m = (m[:, :, None] + self.step[None]).max(axis=1) + e
        return m

    def viterbi(self, emissions: np.ndarray, before: int | None = None, last: int | None = None) -> list[int]:
        """The most likely roles; after role `before` and with role `last` at the end where they are given. Ties go to the first role."""
        if not len(emissions):
            return []
        best = (self.start if before is None else self.step[before]) + emissions[0]
        back = []
        for e in emissions[1:]:
            all_ = best[:, None] + self.step
            back.append(all_.argmax(axis=0))
            best = all_.max(axis=0) + e
        path = [int(best.argmax()) if last is None else last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def train(conversations: list[list[tuple[str, str]]], smooth: float = 0.5) -> Model:
    """Counts (role, text) turns; without turns every role is as likely."""
    return counted([[(role, observe(*marker(text), i == 0)) for i, (role, text) in enumerate(turns)] for turns in conversations], smooth)


def counted(conversations: list[list[tuple[str, tuple[int, ...]]]], smooth: float = 0.5) -> Model:
    """Counts (role, observations) turns. Emissions of markers keep a prior, since turns mostly lack them."""
    n = len(ROLES)
    start, step = np.full(n, smooth), np.full((n, n), smooth)
    emit = [np.full((n, k), smooth) for k in FEATURES]
    for r in range(n):  # a marker names its role nearly always
        emit[0][r, 1:] = 0.02
        emit[0][r, 1 + r] = 2.0
    for turns in conversations:
        before = None
        for i, (role, values) in enumerate(turns):
            if role not in ROLES:
                before = None
                continue
            r = ROLES.index(role)
            if i == 0:
                start[r] += 1
            elif before is not None:
                step[before, r] += 1
            for k, v in enumerate(values):
                emit[k][r, v] += 1
            before = r
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Model(log(start), log(step), [log(e) for e in emit])


def fit(turns: DataFrame, rows: int = TRAIN_CONVERSATIONS) -> Model:
    """Fits on about `rows` conversations outside the held-out fold, chosen by hash; tasks observe whole texts, the driver sees observations."""
    small_batches(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [list(observe(*marker(t), False)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), b.column("role"), pa.array(seen, pa.list_(pa.int32()))], ["conv_id", "turn", "role", "seen"])

    usable = turns.where(F.col("conv_id").isNotNull() & F.col("role").isin(*ROLES) & ~held_out(F.col("conv_id")) & (F.col("turn") < TRAIN_TURNS))
    n = usable.select(F.approx_count_distinct("conv_id")).first()[0]
    place = F.pmod(F.xxhash64("conv_id", F.lit("chat sample")), F.lit(1 << 30)) / float(1 << 30)
    picked = usable.where(place < min(1.0, rows / max(n, 1))).select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    observed = picked.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, turn long, role string, seen array<int>")
    by: dict = {}
    for r in observed.orderBy("conv_id", "turn", "role", "seen").limit(2 * rows * TRAIN_TURNS).collect():
        of = by.setdefault(r[0], [])
        of.append((r[2], (*r[3][:4], int(not of), r[3][5])))
    return counted(list(by.values()))


def render(role: str, text: str) -> str:
    """The canonical form of a turn; strings of the form's own marks in a text are broken up."""
    text = re.sub(r"<\|(im_start|im_end)\|>", r"<| \1 |>", text)
    return f"<|im_start|>{role}\n{text.strip()}<|im_end|>\n"


#: Places of a segment's crowded turn numbers and of what lies between them, and parts of one, in the bits of a segment's number.
PLACE_BITS, PART_BITS = 14, 24


def apart(rows: DataFrame, crowded: DataFrame, segment: int) -> DataFrame:
    """Numbers segments anew, so that a crowded turn number's rows are segments of their own, by parts of their texts' hash.

    A segment has no more than `segment` crowded numbers; what lies before, between and after them are segments too. Order is kept.
    """
    first = lambda t: F.coalesce(t, F.lit(-(1 << 62)))  # noqa: E731  null turns come first
    of = crowded.groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(F.struct(first(F.col("turn")).alias("t"), F.ceil(F.col("count") / segment).alias("parts")))).alias("crowd"))
    key = F.struct("conv_id", "seg")
    met = rows.withColumn("key", key).join(of.select(key.alias("key"), "crowd"), "key", "left").drop("key")
    before = F.size(F.filter("crowd", lambda c: c["t"] < first(F.col("turn"))))
    own = F.filter("crowd", lambda c: c["t"] == first(F.col("turn")))
    place = F.when(F.col("crowd").isNull(), 0).otherwise(2 * before + F.size(own))
    part = F.when(F.size(own) > 0, F.pmod(F.xxhash64("text"), F.lit(1 << PART_BITS)) * own[0]["parts"] / (1 << PART_BITS)).otherwise(F.lit(0.0))
    number = F.shiftleft(F.shiftleft("seg", PLACE_BITS) + place, PART_BITS) + F.floor(F.coalesce(part, F.lit(0.0)))
    return met.withColumn("seg", number.cast("long")).drop("crowd")


def parse(turns: DataFrame, model: Model, segment: int = SEGMENT) -> DataFrame:
    """One row per turn of (conv_id, turn, text): role_pred, opens (another role than the turn before) and rendered.

    Roles are not read. Null text is an empty block; null turns come first; turns with equal numbers are ordered by
    text, and where more than `segment` have the same number, by parts of the texts' hash first, so that they are as many segments; rows with
    null conv_id are one conversation. An empty table gives an empty result.
    """
    small_batches(turns.sparkSession)
    id_type = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("seg", F.floor(F.coalesce("turn", F.lit(0)) / segment))
    crowded = cut(rows.groupBy("conv_id", "seg", "turn").count().where(F.col("count") > segment))
    if not crowded.isEmpty():
        rows = apart(rows, crowded, segment)
    head = rows.groupBy("conv_id").agg(F.min("seg").alias("first_seg"), F.max("seg").alias("last_seg"))
    rows = rows.withColumn("key", F.struct("conv_id")).join(head.select(F.struct("conv_id").alias("key"), "first_seg", "last_seg"), "key").drop("key")

    def observed(table: pa.Table) -> tuple[pa.Table, list[tuple[str, str]], np.ndarray]:
        table = table.sort_by([("turn", "ascending"), ("text", "ascending")])
        nulls = np.flatnonzero(table["turn"].is_null().to_numpy())
        if len(nulls):
            table = table.take(pa.array(np.r_[nulls, np.setdiff1d(np.arange(len(table)), nulls)]))
        begins = table["seg"][0].as_py() == table["first_seg"][0].as_py()
        marked = [marker(t) for t in table["text"].to_pylist()]
        return table, marked, model.scores([observe(m, t, begins and i == 0) for i, (m, t) in enumerate(marked)])

    def summary(table: pa.Table) -> pa.Table:
        _, _, e = observed(table)
        first = table["seg"][0].as_py() == table["first_seg"][0].as_py()
        m = model.matrix(e)
        if first:  # before the first segment there is no role: every row has the scores from the start
            only = Model(model.start, np.tile(model.start, (len(ROLES), 1)), model.emit).matrix(e[:1])
            m = only
            for x in e[1:]:
                m = (m[:, :, None] + model.step[None]).max(axis=1) + x
        return pa.table({"conv_id": table["conv_id"][:1], "seg": table["seg"][:1], "m": pa.array([m.ravel().tolist()], pa.list_(pa.float64()))})

    def bounds(table: pa.Table) -> pa.Table:
        """The role at the end of each segment, by Viterbi over the segments' matrices."""
        table = table.sort_by("seg")
        best, back = None, []
        for m in table["m"].to_pylist():
            m = np.array(m).reshape(len(ROLES), len(ROLES))
            if best is None:
                best = m[0]
            else:
                all_ = best[:, None] + m
                back.append(all_.argmax(axis=0))
                best = all_.max(axis=0)
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        path = path[::-1]
        return pa.table({"conv_id": table["conv_id"], "seg": table["seg"], "before": pa.array([None, *path[:-1]], pa.int32()), "last": pa.array(path, pa.int32())})

    def decode(table: pa.Table) -> pa.Table:
        table, marked, e = observed(table)
        before, last = table["before"][0].as_py(), table["last"][0].as_py()
        path = model.viterbi(e, before, last)
        opens = [r != p for r, p in zip(path, [before, *path[:-1]], strict=True)]
        rendered = [render(ROLES[r], t) for r, (_, t) in zip(path, marked, strict=True)]
        return pa.table({"conv_id": table["conv_id"], "turn": table["turn"], "role_pred": pa.array([ROLES[r] for r in path], pa.string()), "opens": pa.array(opens, pa.bool_()), "rendered": pa.array(rendered, pa.string())})

    schema = f"conv_id {id_type}, turn long, role_pred string, opens boolean, rendered string"
    keys = f"conv_id {id_type}, seg long"
    short = rows.where("first_seg = last_seg").withColumns({"before": F.lit(None).cast("int"), "last": F.lit(None).cast("int")})
    long_ = rows.where("first_seg < last_seg")
    ends = long_.groupBy("conv_id", "seg").applyInArrow(summary, f"{keys}, m array<double>").groupBy("conv_id").applyInArrow(bounds, f"{keys}, before int, last int")
    ends = ends.select(F.struct("conv_id").alias("key"), "seg", "before", "last")
    long_ = long_.withColumn("key", F.struct("conv_id")).join(ends, ["key", "seg"]).drop("key")
    return short.unionByName(long_).groupBy("conv_id", "seg").applyInArrow(decode, schema)


def parse_transcripts(df: DataFrame, model: Model, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Raw transcripts, one a row: cuts each into blocks and parses them as a conversation; conv_id is the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, turns, texts = [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                for k, (role, text) in enumerate(blocks(t or "")):
                    ids.append(i)
                    turns.append(k)
                    texts.append(f"{role}: {text}" if role else text)
            yield pa.RecordBatch.from_arrays([b.column("conv_id").take(pa.array(ids, pa.int32())), pa.array(turns, pa.int64()), pa.array(texts, pa.string())], ["conv_id", "turn", "text"])

    cols = df.select(F.col(id_col).alias("conv_id"), F.col(text_col).alias("text"))
    return parse(cols.mapInArrow(run, f"conv_id {cols.schema['conv_id'].dataType.simpleString()}, turn long, text string"), model)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return parse(turns, fit(turns)).withColumn("held_out", held_out(F.col("conv_id")))
