"""Token ids packed into rows of one length: best-fit decreasing with a segment tree over capacities."""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .pieces import CACHED_LENGTH, CACHED_PIECES, cut

SEQ_LEN = 2048
BLOCK_TOKENS = 4 << 20

_encoders: dict[str, tuple[PieceIds, int]] = {}


class Capacities:
    """Open rows by free places, under a segment tree that finds the smallest sufficient capacity.

    Leaf ``c`` holds the rows with ``c`` places left; an inner node counts the rows below it.
    """

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, capacity: int, n: int) -> None:
        node = capacity + self.width
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The row with the least capacity of at least ``size``, and that capacity; it is removed."""
        node = size + self.width
        if not self.count[node]:
            while True:  # up to the first right neighbour that has rows, then down its left edge
                if node == 1:
                    return None
                if node % 2 == 0 and self.count[node + 1]:
                    node += 1
                    break
                node >>= 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.width
        row = self.rows[capacity].pop()
        self._add(capacity, -1)
        return row, capacity


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of positions in ``sizes`` (none above ``length``) whose sizes sum to at most ``length``."""
    rows: list[list[int]] = []
    open_rows = Capacities(length)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        found = open_rows.take(size)
        if found is None:
            found = (len(rows), length)
            rows.append([])
        rows[found[0]].append(i)
        open_rows.put(found[0], found[1] - size)
    return rows


class PieceIds(dict):
    """The ids of pieces as little-endian bytes, worked out when first asked for and kept while they fit."""

    def __init__(self, encode: Callable[[str], list[int]], kind: np.dtype):
        self.encode = encode
        self.code = kind.char  # arrays and dtypes share these letters

    def __missing__(self, piece: str) -> bytes:
        ids = array(self.code, self.encode(piece))
        if sys.byteorder == "big":
            ids.byteswap()
        found = ids.tobytes()
        if len(piece) <= CACHED_LENGTH:
            self[piece] = found
        return found

    def of(self, text: str) -> bytes:
        if len(self) > CACHED_PIECES:
            self.clear()
        return b"".join(map(self.__getitem__, cut(text)))


def _encoder(path: str, pattern: str) -> tuple[PieceIds, int]:
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        free = max(ranks.values()) + 1
        _encoders[path] = PieceIds(encoding.encode_ordinary, id_type(free)), free
    return _encoders[path]


def id_type(pad: int) -> np.dtype:
    return np.dtype("<u2") if pad < 1 << 16 else np.dtype("<u4")


def pack_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    length: int = SEQ_LEN,
    block_tokens: int = BLOCK_TOKENS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per packed sequence; the rows of one ``(part, block)`` form an id matrix.

    ``ids`` is ``length`` little-endian ids (two bytes each if the vocabulary allows, else four),
    filled up with the first free id; ``n_tokens`` of them are text. ``cu_seqlens`` are cumulative
    segment lengths from 0, ``position_resets`` the places where positions start at 0 again, and
    ``position_ids`` the positions (two bytes each up to a length of 65,536, else four; 0 in the
    filling). Segment i holds tokens ``seg_start[i]`` onwards of document ``seg_doc[i]``.

    A document longer than ``length`` is split into consecutive segments, so nothing is lost; an
    empty or null text is a segment of length 0. Every task packs what it reads in blocks of about
    ``block_tokens`` tokens (a longer document makes a larger block), so there is no shuffle and
    memory is bounded; a block leaves at most some of its own rows part filled. Repeated rows are
    packed as often as they occur, null keys are kept, other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def packed(part: int, block: int, keys: list, ids: list[np.ndarray], pad: int) -> dict[str, list]:
        owner, start, segments = [], [], []
        for k, whole in zip(keys, ids, strict=True):
            for at in range(0, max(1, len(whole)), length):
                owner.append(k)
                start.append(at)
                segments.append(whole[at : at + length])
        sizes = np.array([len(s) for s in segments])
        rows = best_fit_decreasing(sizes, length)
        places = np.arange(length, dtype="<u2" if length <= 1 << 16 else "<u4")
        out: dict[str, list] = {name: [] for name in NAMES}
        for number, row in enumerate(rows):
            filled = np.full(length, pad, ids[0].dtype)
            positions = np.zeros(length, places.dtype)
            ends = [0]
            for i in row:
                n = ends[-1] + len(segments[i])
                filled[ends[-1] : n] = segments[i]
                positions[ends[-1] : n] = places[: n - ends[-1]]
                ends.append(n)
            values = (
                part,
                block,
                number,
                filled.tobytes(),
                ends[-1],
                ends,
                sorted(set(ends[:-1])),
                positions.tobytes(),
                [owner[i] for i in row],
                [start[i] for i in row],
            )
            for name, value in zip(NAMES, values, strict=True):
                out[name].append(value)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, pad = _encoder(path, pattern)
        dtype = id_type(pad)
        part, block = TaskContext.get().partitionId(), 0
        keys: list = []
        ids: list[np.ndarray] = []
        held = 0
        schema = None

        def emit() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(rows["part"]), 512):
                yield pa.RecordBatch.from_pydict({n: v[at : at + 512] for n, v in rows.items()}, schema=schema)

        for batch in batches:
            key_type = batch.schema.field(0).type
            schema = pa.schema(
                [
                    ("part", pa.int32()),
                    ("block", pa.int32()),
                    ("row", pa.int32()),
                    ("ids", pa.binary()),
                    ("n_tokens", pa.int32()),
                    ("cu_seqlens", pa.list_(pa.int32())),
                    ("position_resets", pa.list_(pa.int32())),
                    ("position_ids", pa.binary()),
                    ("seg_doc", pa.list_(key_type)),
                    ("seg_start", pa.list_(pa.int64())),
                ]
            )
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(k)
                ids.append(np.frombuffer(cache.of(t or ""), dtype))
                held += len(ids[-1])
                if held >= block_tokens:
                    rows = packed(part, block, keys, ids, pad)
                    yield from emit()
                    keys, ids, held, block = [], [], 0, block + 1
        if keys:
            rows = packed(part, block, keys, ids, pad)
            yield from emit()

    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    return rows.mapInArrow(
        run,
        "part int, block int, row int, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
        f"position_ids binary, seg_doc array<{kind}>, seg_start array<bigint>",
    )


NAMES = (
    "part",
    "block",
    "row",
    "ids",
    "n_tokens",
    "cu_seqlens",
    "position_resets",
    "position_ids",
    "seg_doc",
    "seg_start",
)
