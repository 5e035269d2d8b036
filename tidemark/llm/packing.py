"""Packing token sequences: non-negative least squares over combinations of piece lengths."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import encoder
from tidemark.session import staged

WINDOW = 2048
# Lengths that take part in combinations are multiples of this; the rest of a document, fewer
# ids than that, is a piece of its own, which fills what combinations leave.
GRAIN = 32
DEPTH = 3

Pattern = tuple[tuple[int, int], ...]  # (length, how often), longest first


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    window: int = WINDOW,
    grain: int = GRAIN,
    depth: int = DEPTH,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, a row per piece.

    Each row's text (null: empty) is encoded whole and ``end_id`` added; repeated rows are
    packed as often as they occur, and a null id stays null.  An empty text is its ``end_id``
    alone; other columns are ignored; an empty table gives no pieces.  A document is cut into whole windows, one piece that is a
    multiple of ``grain``, and a rest.  Combinations of at most ``depth`` pieces that fill a
    window are enumerated, how often each is used is solved against the histogram of lengths by
    non-negative least squares and rounded, and what is left is packed greedily, longest piece
    first.  The driver sees the histogram only (window / grain + grain lengths, whatever the
    input); a piece finds its sequence from its rank among the pieces of its length.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _cut(batches, vocabulary, end_id, window, grain)

    pieces = staged(
        rows.mapInArrow(
            cut,
            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long",
        ),
        "pieces",
    )
    by_part = staged(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = {
        r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    plan = plan_sequences(histogram, window, grain, depth)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranked = pieces.join(bases, ["part", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("rank")
    )
    table = spans_of(plan)
    return ranked.mapInPandas(
        lambda frames: _place(frames, table),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long",
    )


def _cut(batches, vocabulary: str, end_id: int, window: int, grain: int):
    part = TaskContext.get().partitionId()
    encode = encoder(vocabulary).encode
    ending = np.array([end_id], np.uint32)
    seen: Counter[int] = Counter()
    for batch in batches:
        found: list[tuple] = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.concatenate([encode(text or ""), ending]).astype("<u4")
            total, at = len(ids), 0
            whole, rest = divmod(total, window)
            for length in (*[window] * whole, rest - rest % grain, rest % grain):
                if length:
                    crc = zlib.crc32(ids[at : at + length].tobytes())
                    found.append((name, at, length, crc, total, part, seen[length]))
                    seen[length] += 1
                    at += length
        columns = list(zip(*found)) or [()] * 7
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def plan_sequences(
    histogram: dict[int, int], window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH
) -> list[tuple[Pattern, int]]:
    """Patterns and how many sequences have each; together they use every piece once."""
    left = {length: n for length, n in histogram.items() if n}
    plan: list[tuple[Pattern, int]] = []
    if window in left:
        plan.append((((window, 1),), left.pop(window)))
    shapes = combinations_filling(window, grain, depth)
    lengths = [k for k in range(grain, window, grain)]
    matrix = np.zeros((len(lengths), len(shapes)))
    for j, shape in enumerate(shapes):
        for length, n in shape:
            matrix[length // grain - 1, j] = n
    wanted = np.array([left.get(length, 0) for length in lengths], float)
    for j, repeats in enumerate(np.rint(nonnegative_least_squares(matrix, wanted)).astype(np.int64)):
        possible = min(left.get(length, 0) // n for length, n in shapes[j])
        times = int(min(repeats, possible))
        if times:
            plan.append((shapes[j], times))
            _take(left, shapes[j], times)
    while left:
        room, pattern = window, []
        for length in sorted(left, reverse=True):
            if n := min(room // length, left[length]):
                pattern.append((length, n))
                room -= n * length
        shape = tuple(pattern)
        times = min(left[length] // n for length, n in shape)
        plan.append((shape, times))
        _take(left, shape, times)
    return plan


def _take(left: dict[int, int], shape: Pattern, times: int) -> None:
    for length, n in shape:
        left[length] -= n * times
        if not left[length]:
            del left[length]


def combinations_filling(window: int, grain: int, depth: int) -> list[Pattern]:
    """All ways to fill the window exactly with 2 to ``depth`` multiples of ``grain``."""
    units = window // grain
    found = []
    for parts in range(2, depth + 1):
        for some in combinations_with_replacement(range(1, units), parts - 1):
            last = units - sum(some)
            if last >= some[-1]:
                counts = Counter([*some, last])
                found.append(tuple((u * grain, n) for u, n in sorted(counts.items(), reverse=True)))
    return found


def nonnegative_least_squares(matrix: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Minimise ``|matrix x - wanted|`` over ``x >= 0`` by an active set.

    The column that promises most is freed, the free columns are solved exactly, and columns
    that would turn negative are set back to zero on the way there.
    """
    n = matrix.shape[1]
    x, free = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(wanted).max(initial=0.0)))
    for _ in range(3 * n):
        gain = matrix.T @ (wanted - matrix @ x)
        gain[free] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        free[best] = True
        while True:
            solved = np.zeros(n)
            solved[free] = np.linalg.lstsq(matrix[:, free], wanted, rcond=None)[0]
            bad = free & (solved <= 0)
            if not bad.any():
                x = solved
                break
            step = np.min(x[bad] / np.maximum(x[bad] - solved[bad], 1e-300))
            x = x + step * (solved - x)
            free &= x > tolerance * 1e-3
            x[~free] = 0.0
            if not free.any():
                break
    return x


def spans_of(plan: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """For each length rows of (first rank, first sequence, pieces per sequence, first offset)."""
    spans: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter[int] = Counter()
    sequence = 0
    for shape, times in plan:
        offset = 0
        for length, n in shape:
            spans.setdefault(length, []).append((used[length], sequence, n, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    return {length: np.array(rows, np.int64) for length, rows in spans.items()}


def _place(frames: Iterator[pd.DataFrame], table: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rank, length = frame.pop("rank").to_numpy(), frame["length"].to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for value in np.unique(length):
            here = length == value
            spans = table[int(value)]
            row = spans[np.searchsorted(spans[:, 0], rank[here], side="right") - 1]
            inside = rank[here] - row[:, 0]
            sequence[here] = row[:, 1] + inside // row[:, 2]
            offset[here] = row[:, 3] + inside % row[:, 2] * value
        yield frame.assign(sequence_id=sequence, offset=offset)
