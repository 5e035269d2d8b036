"""Runs of periodic words: blocks located in following windows by exact convolution, then extended.

A run is a stretch of words with a smallest period q (words q apart are identical) that repeats
at least ``REPEATS`` times and cannot be made longer.  For every dyadic scale b the text is cut
into blocks of b words.  A run of period b <= q < 2b holds a whole block and the block q words
after it, so it shows as a distance at which the sum of squared differences between a block and
a following window is zero.  Those sums come from a number theoretic transform per block, whose
residues are exact integers; every distance found is checked on the words themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A prime with roots of unity of every order up to 2^16: products of residues and their sums over
# a transform stay far below 2^53, so matrix products of doubles are exact.
PRIME, GENERATOR = 65537, 3
# The smallest block, and the largest that is transformed; scales beyond take blocks of this size
# at larger steps, and as many windows as their distances need.
BLOCK, LARGEST = 8, 4096
# Transforms up to this size are one matrix product, larger ones two.
DIRECT = 128
# Words searched together, values transformed together, and words compared together.
GROUP_WORDS, SLAB, COMPARED = 1 << 17, 1 << 16, 1 << 20
LEAST, REPEATS = 24, 3

Edit = Callable[[int | None, list[bytes]], list[bytes]]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "top struct<start: long, length: long, period: long>, collapsed string"
)


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    least: int = LEAST,
    repeats: int = REPEATS,
    edit: Edit | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, top, collapsed``.

    Words are what stands between ASCII white space, numbered from 0.  ``runs`` holds every run
    of length ``least`` and ``repeats`` periods or more by start, then period; ``top`` the one
    with the greatest length / period (ties: smallest start, then period), null without runs;
    ``collapsed`` the words joined by a space, without those that a run has after its first
    period.  ``edit`` may change a document's words before the search.

    A null or empty text has no words, no runs and an empty ``collapsed``; null and repeated ids
    are rows like others; other columns are ignored; an empty table gives no rows.  Documents are
    searched where they lie, in groups of bounded size; a very long text is a group of its own,
    whose transforms take time in proportion to its length times two logarithms.
    """
    if repeats < 3 or least < 3 * BLOCK:
        raise ValueError(f"runs have at least 3 periods and {3 * BLOCK} words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, held, size = [], [], 0
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                words = (value.as_py() or b"").split()
                name = name.as_py()
                if held and size + len(words) > GROUP_WORDS:
                    yield _described(names, held, least, repeats)
                    names, held, size = [], [], 0
                names.append(name)
                held.append(edit(name, words) if edit else words)
                size += len(words)
            if held:
                yield _described(names, held, least, repeats)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, _SCHEMA)


def _described(names: list, held: list[list[bytes]], least: int, repeats: int) -> pa.RecordBatch:
    found = runs_of(held, least, repeats)
    collapsed = [
        b" ".join(_kept(words, runs)).decode("utf-8", "replace") for words, runs in zip(held, found, strict=True)
    ]
    shown = [[_named(r) for r in runs] for runs in found]
    tops = [max(runs, key=_rank, default=None) for runs in found]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.int64()),
            pa.array([len(words) for words in held], pa.int64()),
            pa.array(shown, pa.list_(_RUN)),
            pa.array([r and _named(r) for r in tops], _RUN),
            pa.array(collapsed, pa.string()),
        ],
        ["doc_id", "n_words", "runs", "top", "collapsed"],
    )


def _named(run: tuple[int, int, int]) -> dict[str, int]:
    return dict(zip(("start", "length", "period"), run, strict=True))


def _rank(run: tuple[int, int, int]) -> tuple:
    start, length, period = run
    return Fraction(length, period), -start, -period


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep).tolist()]


def runs_of(
    texts: list[list[bytes]], least: int = LEAST, repeats: int = REPEATS
) -> list[list[tuple[int, int, int]]]:
    """The runs ``(start, length, period)`` of each text, by start, then period."""
    lengths = np.array([len(words) for words in texts], np.int64)
    number: dict[bytes, int] = {}
    for words in texts:
        number.update(dict.fromkeys(words))
    number = dict(zip(number, range(len(number))))
    # Texts stand between numbers of their own, which nothing equals.
    words = np.empty(int(lengths.sum()) + len(texts) + 1, np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    words[0] = -1
    for k, (text, start) in enumerate(zip(texts, starts.tolist(), strict=True)):
        words[start : start + len(text)] = np.fromiter(map(number.__getitem__, text), np.int64, len(text))
        words[start + len(text)] = -2 - k
    found: list[tuple[int, int, int]] = []
    scale = BLOCK
    while len(lengths) and lengths.max() >= max(least, repeats * scale):
        some = lengths >= max(least, repeats * scale)
        at, distance = _matches(words, starts[some], lengths[some], scale)
        if scale > BLOCK:
            found += _grown(words, at, distance, scale, found, least, repeats)
        else:  # multiples of a period lie in this scale too, so the smaller distances come first
            for d in range(1, 2 * BLOCK):
                found += _grown(words, at[distance == d], distance[distance == d], scale, found, least, repeats)
        scale *= 2
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in found:
        k = int(np.searchsorted(starts, start, "right")) - 1
        runs[k].append((start - int(starts[k]), end - start, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in runs]


def _matches(
    words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, scale: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks and the distances, of this scale, at which the same residues stand."""
    size = min(scale, LARGEST)
    step = scale // size
    # Residues whose squared differences over a block add up to less than the prime.
    top = isqrt((PRIME - 1) // size)
    counts = -(-lengths // size)
    first = np.cumsum(counts) - counts
    total = int(counts.sum())
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ahead = 2 * step + 1
    grid = np.zeros((total + ahead) * size)
    residues = ((words * 0x9E3779B1 & 0xFFFFFFFF) * (top + 1)) >> 32
    grid[np.repeat(first * size, lengths) + inside] = residues[np.repeat(starts, lengths) + inside]
    squares = np.concatenate([[0.0], np.cumsum(grid * grid)])[:-1].reshape(-1, size)
    turn = _transform(size)
    blocks = grid.reshape(-1, size)
    seen = np.empty((len(blocks), 2 * size))
    rows_at_once = max(1, SLAB // (2 * size))
    for r in range(0, len(blocks), rows_at_once):
        seen[r : r + rows_at_once] = turn.forward(blocks[r : r + rows_at_once])
    owner = np.repeat(np.arange(len(lengths)), counts)
    block = np.arange(total) - first[owner]
    # A run of this scale that holds the block goes on for at least two more of the scale.
    asked = (block % step == 0) & (block * size + 2 * scale < lengths[owner])
    places, distances = [], []
    for offset in (0, 1) if scale == BLOCK else range(step, 2 * step):
        rows = np.flatnonzero(asked & ((block + offset + 1) * size <= lengths[owner]))
        for r in range(0, len(rows), rows_at_once):
            some = rows[r : r + rows_at_once]
            window = seen[some + offset] + turn.sign * seen[some + offset + 1]
            products = _modulo(seen[some][:, turn.negative] * window)
            near = squares[some + offset + 1] - squares[some + offset]
            own = squares[some + 1, :1] - squares[some, :1]
            # Zero mismatches: both squares are twice the product, all below the prime.
            zero = 2 * turn.inverse(products) == own + near
            if offset == 0:
                zero[:, 0] = False
            row, lag = np.nonzero(zero)
            distance = offset * size + lag
            text = owner[some[row]]
            place = block[some[row]] * size
            whole = place + distance + size <= lengths[text]
            places.append((starts[text] + place)[whole])
            distances.append(distance[whole])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(places or none), np.concatenate(distances or none)


def _grown(words, at, distance, scale, known, least, repeats) -> list[tuple[int, int, int]]:
    """New runs ``(start, end, period)`` from blocks that recur at a distance."""
    size = min(scale, LARGEST)
    new = ~_explained(at, at + distance, distance, known)
    at, distance = at[new], distance[new]
    equal = np.zeros(len(at), bool)
    rows = max(1, COMPARED // size)
    for r in range(0, len(at), rows):
        some = at[r : r + rows, None] + np.arange(size)
        equal[r : r + rows] = (words[some] == words[some + distance[r : r + rows, None]]).all(axis=1)
    at, distance = at[equal], distance[equal]
    if not len(at):
        return []
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    # Neighbouring blocks at one distance belong to one stretch.
    begins = np.flatnonzero(np.r_[True, (np.diff(distance) != 0) | (np.diff(at) != size)])
    left, right = at[begins], at[np.r_[begins[1:], len(at)] - 1] + size
    distance = distance[begins]
    left = left - _same_words(words, left - 1, distance, -1)
    right = right + _same_words(words, right, distance, 1) + distance
    long = right - left >= np.maximum(least, repeats * distance)
    stretches = np.unique(np.stack([left, right, distance], axis=1)[long], axis=0)
    # A stretch inside a run whose period divides the distance is that run.
    own = ~_explained(stretches[:, 0], stretches[:, 1], stretches[:, 2], known)
    return [tuple(s) for s in stretches[own].tolist()]


def _explained(left, right, distance, known) -> np.ndarray:
    """Whether a known run of a period dividing the distance holds the stretch.

    What repeats at such a distance is periodic by the shorter period, so the stretch is part of
    that run however far it reaches.
    """
    done = np.zeros(len(left), bool)
    if not known or not len(left):
        return done
    order = np.argsort(left, kind="stable")
    sorted_left = left[order]
    for start, end, period in known:
        a, b = np.searchsorted(sorted_left, (start, end))
        if a < b:
            some = order[a:b]
            done[some] |= (right[some] <= end) & (distance[some] % period == 0)
    return done


def _same_words(words: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words in a row, from ``at`` by ``step``, equal those at the distance."""
    count = np.zeros(len(at), np.int64)
    active, width, last = np.arange(len(at)), 16, len(words) - 1
    while len(active):
        width = max(16, min(width, COMPARED // len(active)))
        going = []
        rows = max(1, COMPARED // width)
        for r in range(0, len(active), rows):
            some = active[r : r + rows]
            place = at[some, None] + step * (count[some, None] + np.arange(width))
            same = words[np.clip(place, 0, last)] == words[np.clip(place + distance[some, None], 0, last)]
            whole = same.all(axis=1)
            count[some] += np.where(whole, width, same.argmin(axis=1))
            going.append(some[whole])
        active, width = np.concatenate(going), width * 4
    return count


def _modulo(values: np.ndarray) -> np.ndarray:
    """Residues of exact integers; a multiple of the prime may come out as the prime itself."""
    return values - PRIME * np.floor(values * (1.0 / PRIME))


class Transform:
    """Transforms of blocks of ``size`` words, padded to twice that, in an order of its own."""

    def __init__(self, size: int):
        whole = 2 * size
        root = pow(GENERATOR, (PRIME - 1) // whole, PRIME)
        powers = np.empty(whole)
        value = 1
        for k in range(whole):
            powers[k] = value
            value = value * root % PRIME
        self.size, self.whole = size, whole
        self.rows = 1 if whole <= DIRECT else 1 << (whole.bit_length() - 1) // 2
        self.columns = whole // self.rows
        unit = pow(whole, PRIME - 2, PRIME)
        rows, columns = np.arange(self.rows), np.arange(self.columns)

        def table(a: np.ndarray, b: np.ndarray, times: int, sign: int = 1) -> np.ndarray:
            return powers[sign * times * np.outer(a, b) % whole]

        if self.rows == 1:
            self.into = table(np.arange(size), columns, 1)
            self.back = table(columns, np.arange(size), 1, -1) * unit % PRIME
            frequency = columns
        else:
            half = rows[: self.rows // 2]
            self.first = table(rows, half, self.columns)
            self.twist = table(rows, columns, 1)
            self.second = table(columns, columns, self.rows)
            self.second_back = table(columns, columns, self.rows, -1)
            self.twist_back = table(rows, columns, 1, -1) * unit % PRIME
            self.first_back = table(half, rows, self.columns, -1)
            frequency = (rows[:, None] + self.rows * columns).ravel()
        place = np.argsort(frequency)
        # Where the opposite frequency stands, and the sign that moving by a block gives.
        self.negative = place[-frequency % whole]
        self.sign = np.where(frequency % 2 == 0, 1.0, -1.0)

    def forward(self, blocks: np.ndarray) -> np.ndarray:
        if self.rows == 1:
            return _modulo(blocks @ self.into)
        cut = blocks.reshape(len(blocks), self.rows // 2, self.columns)
        turned = _modulo(_modulo(np.matmul(self.first, cut)) * self.twist)
        return _modulo(turned.reshape(-1, self.columns) @ self.second).reshape(len(blocks), self.whole)

    def inverse(self, values: np.ndarray) -> np.ndarray:
        """The first ``size`` values of the inverse transform, from 0 to below the prime."""
        if self.rows == 1:
            back = _modulo(values @ self.back)
        else:
            inner = _modulo(values.reshape(-1, self.columns) @ self.second_back)
            turned = _modulo(inner.reshape(len(values), self.rows, self.columns) * self.twist_back)
            back = _modulo(np.matmul(self.first_back, turned)).reshape(len(values), self.size)
        return np.where(back == PRIME, 0.0, back)


@lru_cache(maxsize=16)
def _transform(size: int) -> Transform:
    return Transform(size)


def run_digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256``."""
    numbers = ("start", "length", "period")
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in numbers]), F.lit("\n"))
    )
    top = F.col("top")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
