"""Secret scans with multipart credential linking.

Strong patterns are reported wherever they match. Weak candidates, which alone say little, are access identifiers
(user names, client and key identifiers), secrets (long mixed tokens, private values of settings) and endpoints (addresses
with a scheme, hosts with a port, IPv4 addresses). Within a scope, a block of text between blank lines, secrets are joined
with identifiers and endpoints whose intervals lie within REACH characters, before or after; only candidates with a
complementary part are reported. Two sweeps over the sorted intervals find each part's nearest complement on either side.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolex.llm.common import documents, small_batches

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this finds the runs of `[0-9a-f]+` that are long enough
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Characters between a weak secret and its complementary part at most.
REACH = 400
WEAK_ID = re.compile(r"""(?<![A-Za-z0-9])(?i:user(?:name)?|login|client_?id|account_?id|access_?key_?id|key_?id)["']?[ ]*[:=][ ]*["']?([A-Za-z0-9@._-]{3,})""", re.ASCII)
WEAK_SECRET = re.compile(r"""(?<![A-Za-z0-9+/_=.-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}""", re.ASCII)
PRIVATE = re.compile(r"""(?<![A-Za-z0-9])(?i:pwd|pass(?:phrase)?|private_?key|credentials?)["']?[ ]*[:=][ ]*["']?([^\s"'<>(){}\[\],;]{6,})""", re.ASCII)
# Schemes and hosts begin where a run of their characters does and give nothing back, so a long run is read once.
ENDPOINT = re.compile(r"""(?<![A-Za-z0-9_+])[a-z][a-z0-9+]*+://[A-Za-z0-9._~:/@-]{4,}|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d+)?\b|(?<![A-Za-z0-9_.-])[a-z0-9-]++(?:\.[a-z0-9-]++)++:\d{2,5}\b""", re.ASCII)
BLANK = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) by the base patterns, in code points, end exclusive; by start, then kind as listed."""
    out: list[Span] = []
    low = text.encode("utf-8", "replace").lower()
    if any(w in low for w in WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if DIGITS.search(text):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    else:  # a run without a digit, in words of a to f alone
        out += [("hex", m.start(), m.end()) for m in LETTERS_HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


DIGITS = re.compile(r"[0-9]")
LETTERS_HEX = re.compile(r"[a-f]{24,}")


def apart(spans: list[tuple[int, int]], others: list[tuple[int, int]], at_start: bool = False) -> list[tuple[int, int]]:
    """Spans, sorted, that are not part of another candidate; at_start: that do not begin within one."""
    out, k = [], 0
    others = sorted(others)
    for a, b in spans:
        while k < len(others) and others[k][1] <= a:
            k += 1
        if k == len(others) or others[k][0] >= (a + 1 if at_start else b):
            out.append((a, b))
    return out


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates with a complementary part in their scope: kinds key_id, weak_secret and endpoint.

    Secrets complement identifiers and endpoints: a part is reported if its nearest complement on either side lies within
    REACH. Strong spans count as parts too: an assignment or hexadecimal run is a secret, an access key an identifier. Linear
    in the parts once they are sorted.
    """
    ids = [("key_id", m.start(1), m.end(1)) for m in WEAK_ID.finditer(text)] if ":" in text or "=" in text else []
    ids += [s for s in base if s[0] == "access"]
    ends = [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)] if DIGITS.search(text) or "://" in text else []
    if not ids and not ends:
        return []
    taken = [(s[1], s[2]) for s in base]
    strong = [s for s in base if s[0] != "access"]
    others = [*taken, *((a, b) for _, a, b in [*ids, *ends])]
    private = apart([m.span(1) for m in PRIVATE.finditer(text)], others, at_start=True) if ":" in text or "=" in text else []
    runs = apart([m.span() for m in WEAK_SECRET.finditer(text)], [*others, *private])
    weak = [("weak_secret", a, b) for a, b in [*private, *runs]]
    if not weak and not strong:
        return []
    edges = [m.end() for m in BLANK.finditer(text)]
    sides = [*((True, s) for s in [*weak, *strong]), *((False, s) for s in [*ids, *ends])]
    parts = [(bisect_right(edges, s[1]), side, s) for side, s in sorted(sides, key=lambda p: (p[1][1], p[1][2]))]
    found: set[Span] = set()
    at, reached = -1, {}
    for scope, side, span in parts:  # the complement before that ends last
        if scope != at:
            at, reached = scope, {}
        if (not side) in reached and span[1] - reached[not side] <= REACH:
            found.add(span)
        reached[side] = max(span[2], reached.get(side, 0))
    at, reached = -1, {}
    for scope, side, span in reversed(parts):  # the complement after that starts first
        if scope != at:
            at, reached = scope, {}
        if (not side) in reached and reached[not side] - span[2] <= REACH:
            found.add(span)
        reached[side] = span[1]
    return sorted((s for s in found if s[0] not in KINDS), key=lambda s: (s[1], s[0]))


SCHEMA = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"


def join_spans(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of base spans, their digest, and all spans with those that linking adds.

    Null text is empty and has no spans; null ids and repeated rows give a row each, an empty table gives an empty result, and
    other columns are not read. All patterns read a text once, so very long texts take time in proportion. A scope lies
    within one text, so linking needs no exchange of rows.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {k: i for i, k in enumerate([*KINDS, "endpoint", "key_id", "weak_secret"])}
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t in b.column("text").to_pylist():
                t = t or ""
                base = base_spans(t)
                more = linked_spans(t, base)
                every = sorted([*base, *more], key=lambda s: (s[1], order[s[0]]))
                values = (*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(every), len(more))
                for c, v in zip(cols, values, strict=True):
                    c.append(v)
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("id"), *map(pa.array, cols, types)], ["id", *(x.split()[0] for x in SCHEMA.split(", "))])

    cols = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return cols.mapInArrow(run, f"id {cols.schema['id'].dataType.simpleString()}, {SCHEMA}").withColumnRenamed("id", id_col)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
