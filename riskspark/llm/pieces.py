"""SentencePiece encoding and decoding by weighted finite-state transduction.

Three transducers are composed with each input: the normaliser (spaces become
the space mark, one is put in front), the pieces (an arc reads a piece's
characters and writes its id), and byte fallback (an arc reads a character
that no piece has and writes the ids of its bytes). The encoding is the
cheapest path in the tropical semiring. For a unigram vocabulary an arc costs
the piece's negative score. For a merge vocabulary, two pieces may follow each
other only if merging their joint text gives just these two; such a pair costs
0, any other is forbidden, and one path is left. A path cannot cross a border
that no piece crosses, so inputs are composed border by border and the results
of frequent segments are kept.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import give_back, small_batches

MARK = "▁"
# Segments and pairs kept by a worker, as they come: the frequent ones come early.
_KEPT = 300_000
_FAR = float("inf")
_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class Vocabulary:
    """What the transducers are compiled from."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]  # 1 normal, 2 unknown, 3 control, 4 user defined, 5 unused, 6 byte
    merges: bool
    prefix: bool
    squeeze: bool
    escape: bool
    unknown: int


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message in the model file's wire format."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def load(spark: SparkSession, path: str) -> Vocabulary:
    """Read a model file through Spark, so any store will do; its size is that of a vocabulary."""
    content = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    pieces, scores, kinds, merges, unknown = [], [], [], False, 0
    normal = {3: 1, 4: 1, 5: 1}
    for number, value in _fields(content):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
            kinds.append(int(piece.get(3, 1)))
        elif number == 2:
            merges = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            spec = dict(_fields(value))
            if spec.get(2):
                raise ValueError("the model has a character map; only identity normalisation is compiled")
            normal |= {k: int(spec[k]) for k in normal if k in spec}
    for i, kind in enumerate(kinds):
        if kind == 2:
            unknown = i
    return Vocabulary(tuple(pieces), tuple(scores), tuple(kinds), merges, bool(normal[3]), bool(normal[4]), bool(normal[5]), unknown)


class Transducer:
    """The composed machine and the results of the segments met so far."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.ids = {p: i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k in (1, 4)}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(v.pieces, v.kinds)) if k == 6}
        self.longest = max(map(len, self.ids), default=1)
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        # Arcs as a tree by characters; a piece that merging never makes has none.
        self.tree: dict = {}
        for piece, number in self.ids.items():
            if not v.merges or self._merged(piece) == [piece]:
                node = self.tree
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = number
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        lone = {c for c in (*self.ids, "\n", "\t", "\r") if len(c) == 1 and c not in joined and c != MARK}
        chars = "".join(re.escape(c) for c in sorted(lone))
        # Borders: before a run of marks, unless a piece crosses it, and around characters of no longer piece.
        self.crossed = any(MARK in p.lstrip(MARK) for p in self.ids)
        alone = f"[{chars}]|" if chars else ""
        rest = f"[^{chars}]+" if chars else "(?s:.)+"
        self.segment = re.compile(alone + (rest if self.crossed else f"{MARK}*[^{MARK}{chars}]+|{MARK}+"))

    def normalise(self, text: str) -> str:
        if self.v.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        if self.v.prefix and not (self.v.squeeze and text.startswith(MARK)):
            text = " " + text
        return text.replace(" ", MARK) if self.v.escape else text

    def _merged(self, text: str) -> list[str]:
        """Merge neighbours, the best joint piece first and the left one of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.v.scores[found] > best):
                    best, at = self.v.scores[found], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, left: int, right: int) -> bool:
        pieces = self.v.pieces
        found = self._merged(pieces[left] + pieces[right]) == [pieces[left], pieces[right]]
        if len(self.pairs) < _KEPT:
            self.pairs[left * len(pieces) + right] = found
        return found

    def _arcs(self, segment: str, start: int) -> list[tuple[int, int]]:
        """(end, piece) of the pieces that begin at a border, short to long."""
        node, found = self.tree, []
        for c in segment[start : start + self.longest]:
            node = node.get(c)
            if node is None:
                break
            start += 1
            piece = node.get("")
            if piece is not None:
                found.append((start, piece))
        return found

    def _only_path(self, segment: str) -> list[tuple[int, int, int]]:
        """The one path of cost 0 as (start, end, piece), looked for along long arcs first.

        At most one path of cost 0 leads to a border, so a border from which the
        end was not reached is never tried again.
        """
        n, many, pairs = len(segment), len(self.v.pieces), self.pairs
        path: list[tuple[int, int, int]] = []
        open_arcs = [self._arcs(segment, 0)]
        dead: set[int] = set()
        start, before = 0, -1
        while start < n:
            arcs = open_arcs[-1]
            while arcs:
                end, piece = arcs.pop()
                if end in dead:
                    continue
                if before >= 0:
                    fits = pairs.get(before * many + piece)
                    if not (self._may_follow(before, piece) if fits is None else fits):
                        continue
                break
            else:
                if segment[start] not in self.ids:
                    end, piece = start + 1, -1  # no piece has this character
                else:
                    dead.add(start)
                    open_arcs.pop()
                    start = path.pop()[0]
                    before = path[-1][2] if path else -1
                    continue
            path.append((start, end, piece))
            start, before = end, piece
            open_arcs.append(self._arcs(segment, start))
        return path

    def _cheapest_path(self, segment: str) -> list[tuple[int, int, int]]:
        """Cheapest path over scored pieces; a character that no piece has costs more than any piece."""
        n = len(segment)
        cost, back = [0.0] + [_FAR] * n, [(0, -1)] * (n + 1)
        for start in range(n):
            for end, piece in self._arcs(segment, start):
                price = cost[start] - self.v.scores[piece]
                if price < cost[end]:
                    cost[end], back[end] = price, (start, piece)
            if segment[start] not in self.ids and cost[start] + 1e3 < cost[start + 1]:
                cost[start + 1], back[start + 1] = cost[start] + 1e3, (start, -1)
        path = []
        while n:
            start, piece = back[n]
            path.append((start, n, piece))
            n = start
        return path[::-1]

    def _ids(self, segment: str) -> bytes:
        out: list[int] = []
        for start, end, piece in (self._only_path if self.v.merges else self._cheapest_path)(segment):
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in segment[start:end].encode("utf-8", "surrogatepass"))
            else:
                out.append(self.v.unknown)
        return array("i", out).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of what stands between two runs of marks, with the run before it."""
        found = b"".join(self._ids(x) for x in self.segment.findall(word))
        if len(word) <= 32 and len(self.known) < _KEPT:
            self.known[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as 32-bit numbers."""
        text = self.normalise(text)
        known = self.known.get
        if self.crossed:
            return b"".join(self._ids(x) for x in self.segment.findall(text))
        return b"".join([known(w) or self._word(w) for w in _RUNS.findall(text)])

    def decoder(self) -> np.ndarray:
        """What each id writes."""
        out = np.empty(len(self.v.pieces), dtype=object)
        for i, (p, k) in enumerate(zip(self.v.pieces, self.v.kinds)):
            out[i] = bytes([int(p[3:5], 16)]) if k == 6 else b"" if k == 3 else b" \xe2\x81\x87 " if k == 2 else p.encode()
        return out


def machine_of(parts: tuple) -> Transducer:
    """The worker's machine for a vocabulary, kept from task to task."""
    kept = sys.__dict__.setdefault("_sentence_piece_machines", {})
    key = hash(parts)
    if key not in kept:
        kept.clear()
        kept[key] = Transducer(Vocabulary(*parts))
    return kept[key]


def decode_ids(ids: np.ndarray, table: np.ndarray, prefix: bool) -> str:
    """The text of ids: bytes joined, marks back to spaces, without the space put in front."""
    text = b"".join(table[ids]).decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if prefix and text.startswith(" ") else text


def encode(docs: DataFrame, vocabulary: Vocabulary, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` and ``exact`` of every row.

    ``ids`` is NULL for a NULL text and empty for an empty one. ``exact`` tells
    whether decoding the ids gives the text back, up to the normaliser's marks;
    it is NULL with the ids. Texts of any length are encoded whole; repeated
    rows alike; other columns are ignored; an empty table gives an empty one.
    """
    parts = tuple(getattr(vocabulary, f.name) for f in fields(vocabulary))
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(parts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(held.value)
        table = machine.decoder()
        for batch in batches:
            at = 0
            texts = batch.column(1)
            while at < batch.num_rows:  # answers in bounded blocks
                flat, ends, exact, size, first = [], [0], [], 0, at
                while at < batch.num_rows and (at == first or size < 1 << 22):
                    value = texts[at].as_py()
                    ids = b"" if value is None else machine.encode(value)
                    flat.append(ids)
                    size += len(ids)
                    ends.append(size // 4)
                    wanted = None if value is None else machine.normalise(value).replace(MARK, " ")[bool(value) and machine.v.prefix :]
                    exact.append(None if value is None else decode_ids(np.frombuffer(ids, "<i4"), table, machine.v.prefix) == wanted)
                    at += 1
                numbers = pa.array(np.frombuffer(b"".join(flat), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), numbers, mask=pa.array([e is None for e in exact]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), lists, pa.array(exact, pa.bool_())], ["doc_id", "ids", "exact"])
                del numbers, lists, flat
        give_back()

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(each, "doc_id long, ids array<int>, exact boolean")


def decode(rows: DataFrame, vocabulary: Vocabulary, *, ids: str = "ids", name: str = "text") -> DataFrame:
    """All rows and columns of ``rows`` and ``name``, the text of the ids; NULL for NULL.

    An id outside the vocabulary, or a NULL one, is an error of the caller's
    and decodes to nothing.
    """
    parts = tuple(getattr(vocabulary, f.name) for f in fields(vocabulary))
    held = rows.sparkSession.sparkContext.broadcast(parts)

    @F.arrow_udf("string")
    def text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = machine_of(held.value)
        table = machine.decoder()
        for column in columns:
            out = []
            for value in column:
                if not value.is_valid:
                    out.append(None)
                    continue
                known = [i for i in value.as_py() if i is not None and 0 <= i < len(table)]
                out.append(decode_ids(np.array(known, dtype=np.int64), table, machine.v.prefix))
            yield pa.array(out, pa.string())

    return rows.withColumn(name, text(F.col(ids).cast("array<int>")))
