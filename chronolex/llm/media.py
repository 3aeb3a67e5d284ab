"""Media columns: MPEG transport streams.

`mux` stores bytes as 8-bit samples in one elementary stream: access units of UNIT samples, each a PES packet with a
presentation time stamp, cut into 188-byte transport packets behind a program association and a program map table.
`demux` reads any such stream: it parses the tables, checks continuity counters, reassembles the elementary packets and
gives their time stamps with the random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import documents, small_batches

# Fixed values of ISO/IEC 13818-1 and of the stored form.
PACKET = 188
SYNC = 0x47
PAT_PID = 0
PMT_PID = 0x1000
DATA_PID = 0x0100
STREAM_TYPE = 0x06  # private data in PES packets
STREAM_ID = 0xBD  # private stream 1
CLOCK = 90_000  # ticks a second
RATE = 8000  # samples a second
UNIT = 8000  # samples of an access unit: one second
#: Access units between repeated tables; each of these units is a random-access point.
TABLES_EVERY = 8
ALIGN = 64


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


CRC_TABLE = _crc_table()


def crc_mpeg(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for b in data:
        crc = (crc << 8 & 0xFFFFFFFF) ^ CRC_TABLE[crc >> 24 ^ b]
    return crc


def section(table: int, ident: int, body: bytes) -> bytes:
    """A transport packet's payload with one section: pointer, header, body and checksum."""
    head = bytes([table]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\x00\x00"
    data = head + body
    return (b"\x00" + data + crc_mpeg(data).to_bytes(4, "big")).ljust(PACKET - 4, b"\xff")


PAT = section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
PMT = section(2, 1, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([STREAM_TYPE]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00")


def stamp(pts: int) -> bytes:
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, 0x01 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 0x01 | pts << 1 & 0xFE])


def read_stamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | (b[2] >> 1) << 15 | b[3] << 7 | b[4] >> 1


def mux(payload: bytes) -> bytes:
    """A transport stream that holds the payload; an empty one gives the tables alone."""
    out = []
    counter = tables = 0
    for k, at in enumerate(range(0, len(payload), UNIT) or [0]):
        point = k % TABLES_EVERY == 0
        if point:
            for pid, body in ((PAT_PID, PAT), (PMT_PID, PMT)):
                out.append(bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10 | tables & 15]) + body)
            tables += 1
        body = payload[at : at + UNIT]
        if not body:
            break
        pts = (at * CLOCK // RATE) & (1 << 33) - 1
        data = b"\x00\x00\x01" + bytes([STREAM_ID]) + (8 + len(body)).to_bytes(2, "big") + b"\x84\x80\x05" + stamp(pts) + body
        # the first packet's adaptation field has the clock reference and the random-access flag
        clock = bytes([0x50 if point else 0x10]) + (pts << 15 | 0x7E00).to_bytes(6, "big")
        first = data[: 184 - 8]
        rest = data[len(first) :]
        clock += b"\xff" * (184 - 8 - len(first))
        out.append(bytes([SYNC, 0x40 | DATA_PID >> 8, DATA_PID & 0xFF, 0x30 | counter & 15, len(clock)]) + clock + first)
        counter += 1
        whole = len(rest) // 184
        if whole:
            packets = np.empty((whole, PACKET), np.uint8)
            packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 0xFF
            packets[:, 3] = 0x10 | (np.arange(counter, counter + whole) & 15)
            packets[:, 4:] = np.frombuffer(rest, np.uint8, whole * 184).reshape(whole, 184)
            out.append(packets.tobytes())
            counter += whole
        if tail := rest[whole * 184 :]:
            fill = 183 - len(tail)
            field_ = bytes([fill]) + (b"\x00" + b"\xff" * (fill - 1) if fill else b"")
            out.append(bytes([SYNC, DATA_PID >> 8, DATA_PID & 0xFF, 0x30 | counter & 15]) + field_ + tail)
            counter += 1
    return b"".join(out)


@dataclass
class Stream:
    pid: int = -1
    stream_type: int = -1
    packets: int = 0
    lost_sync: int = 0  #: 188-byte cells without the sync byte
    bad_tables: int = 0  #: table sections whose checksum is wrong, before the first sound one
    discontinuities: int = 0  #: steps of the continuity counter that are neither 1 nor a repeated packet
    truncated: int = 0  #: elementary packets with fewer bytes than they state
    points: list[tuple[int, int, int, bool]] = field(default_factory=list)  #: (stamp, packet number, bytes, random access)
    payload: bytes = b""


def _sections(rows: np.ndarray) -> Iterator[bytes]:
    """The sections of a PID's packets in order, several in a packet and those that span packets too; a section breaks off where a
    packet that should carry it on is missing by its counter.
    """
    held, counter, before = b"", -1, b""

    def whole(last: bool) -> Iterator[bytes]:
        nonlocal held
        while len(held) >= 3 and held[0] != 0xFF:  # 0xff fills the rest of a packet
            size = 3 + (int.from_bytes(held[1:3], "big") & 0x0FFF)
            if len(held) < size:
                break
            yield held[:size]
            held = held[size:]
        if last or held[:1] == b"\xff":
            held = b""

    for row in rows:
        b = row.tobytes()
        at = 4 + (1 + b[4] if b[3] & 0x20 else 0)
        if not b[3] & 0x10 or at >= PACKET:
            continue
        if b == before and not b[1] & 0x40:  # a repeated packet inside a section
            continue
        if (b[3] & 15) != (counter + 1) % 16:
            held = b""
        counter, before = b[3] & 15, b
        if not b[1] & 0x40:
            if held:
                held += b[at:]
                yield from whole(False)
            continue
        start = at + 1 + b[at]
        if held:
            held += b[at + 1 : start]
            yield from whole(True)
        held = b[start:]
        yield from whole(False)


def demux(media: bytes) -> Stream:
    """Reads the first program's first elementary stream. Trailing bytes that are no whole packet are ignored."""
    s = Stream(packets=len(media) // PACKET)
    cells = np.frombuffer(media, np.uint8, s.packets * PACKET).reshape(-1, PACKET)
    number = np.flatnonzero(cells[:, 0] == SYNC)
    s.lost_sync = s.packets - len(number)
    if s.lost_sync:
        cells = cells[number]
    pid = (cells[:, 1].astype(np.int32) & 0x1F) << 8 | cells[:, 2]
    program = -1
    for want in ("program", "stream"):
        for sec in _sections(cells[pid == (PAT_PID if want == "program" else program)]):
            if crc_mpeg(sec):
                s.bad_tables += 1
            elif want == "program" and sec[0] == 0 and len(sec) >= 16:
                program = int.from_bytes(sec[10:12], "big") & 0x1FFF
                break
            elif want == "stream" and sec[0] == 2:
                at = 12 + (int.from_bytes(sec[10:12], "big") & 0x0FFF)
                if at + 5 <= len(sec) - 4:
                    s.stream_type, s.pid = sec[at], int.from_bytes(sec[at + 1 : at + 3], "big") & 0x1FFF
                    break
        if want == "program" and program < 0:
            return s
    own = np.flatnonzero((pid == s.pid) & (cells[:, 3] & 0x10 > 0))
    if s.pid < 0 or not len(own):
        return s
    rows = cells[own]
    adapted = rows[:, 3] & 0x20 > 0
    flags = np.where(adapted & (rows[:, 4] > 0), rows[:, 5], 0)
    step = np.diff(rows[:, 3].astype(np.int16) & 15) % 16
    repeated = np.r_[False, (step == 0) & (rows[1:] == rows[:-1]).all(axis=1)] if (step == 0).any() else np.zeros(len(rows), bool)
    s.discontinuities = int(((step != 1) & ~repeated[1:] & (flags[1:] & 0x80 == 0)).sum())
    rows, adapted, flags, number = (x[~repeated] for x in (rows, adapted, flags, number[own]))
    start = np.minimum(np.where(adapted, 5 + rows[:, 4].astype(np.int32), 4), PACKET)
    data = rows[np.arange(PACKET) >= start[:, None]].tobytes()
    ends = np.cumsum(PACKET - start)
    heads = np.flatnonzero(rows[:, 1] & 0x40)
    bounds = [*(ends[heads] - (PACKET - start[heads])).tolist(), len(data)]
    out = []
    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if data[a : a + 3] != b"\x00\x00\x01" or b - a < 9:
            s.truncated += 1
            continue
        size, body = int.from_bytes(data[a + 4 : a + 6], "big"), a + 9 + data[a + 8]
        pts = read_stamp(data[a + 9 : a + 14]) if data[a + 7] & 0x80 and body <= b else -1
        end = a + 6 + size if size else b
        s.truncated += end > b
        out.append(data[body : min(end, b)])
        s.points.append((pts, int(number[heads[k]]), len(out[-1]), bool(flags[heads[k]] & 0x40)))
    s.payload = b"".join(out)
    return s


def feature(s: Stream) -> str:
    raps = [p for p in s.points if p[3]]
    stamps = f"{s.points[0][0]}-{s.points[-1][0]}" if s.points else "-"
    return f"pid={s.pid};type={s.stream_type};packets={s.packets};units={len(s.points)};pts={stamps};random_access={','.join(str(p[1]) for p in raps)};discontinuities={s.discontinuities};truncated={s.truncated}"


def padded(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, payload): zeros up to a positive multiple of ALIGN; null is empty."""
    raw = (text or "").encode("utf-8", "replace")
    return len(raw), raw.ljust(max(ALIGN, -(-len(raw) // ALIGN) * ALIGN), b"\x00")


def store(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and `media`, the transport stream of each text's payload. Null text is empty; equal texts give equal media.

    Null ids and repeated rows give a row each, an empty table gives an empty result, and other columns are not read.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [padded(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([n for n, _ in pairs], pa.int64()), pa.array([mux(p) for _, p in pairs], pa.binary())], ["id", "n_bytes", "media"])

    cols = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, f"id {cols.schema['id'].dataType.simpleString()}, n_bytes long, media binary").withColumnRenamed("id", id_col)


#: What `read` returns for each stream, beside the columns it keeps.
READ = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, discontinuities long, points array<struct<pts: long, packet: long, bytes: long, random_access: boolean>>"


def read(df: DataFrame, media_col: str = "media") -> DataFrame:
    """Reads the streams of a media column back: digests of the payload, features, and time stamps with random-access points.

    Null media reads as an empty stream; damaged streams give what their whole packets hold, with the damage counted. Other columns are
    kept, but for those that have the name of a result; repeated rows give a row each, an empty table gives an empty result.
    """
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c not in (media_col, *READ_NAMES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for m in b.column("own_media").to_pylist():
                m = m or b""
                s = demux(m)
                values = (len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-ALIGN:]), len(m), hashlib.sha256(m).hexdigest(), feature(s), s.discontinuities,
                          [{"pts": p, "packet": n, "bytes": z, "random_access": r} for p, n, z, r in s.points])
                for c, v in zip(cols, values, strict=True):
                    c.append(v)
            point = pa.list_(pa.struct([("pts", pa.int64()), ("packet", pa.int64()), ("bytes", pa.int64()), ("random_access", pa.bool_())]))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), point]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *map(pa.array, cols, types)], [*kept, *READ_NAMES])

    keep = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in kept)
    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(media_col).alias("own_media")).mapInArrow(run, f"{keep}, {READ}" if keep else READ)


READ_NAMES = [x.split()[0] for x in READ.split(", points")[0].split(", ")] + ["points"]


def access_points(df: DataFrame) -> DataFrame:
    """One row for each time stamp of `read`'s result: where a player can start, and when."""
    return df.select(*[c for c in df.columns if c != "points"], F.inline("points"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read(store(documents(spark, sf_dir)))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "discontinuities")
