"""Cross-entropy difference of two matched word-bigram models (target and background).

Texts are worked on in chunks of a few megabytes.  A chunk asks for the counts of the words and
word pairs it has, each once; the questions are dealt by hash to buckets, which add them up and
answer every chunk.  So the counts are those of the whole corpus, their tables grow with it, and
no task or driver ever holds more than a chunk or a bucket of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.session import staged

# Bytes of text in a chunk (a longer document is a chunk of its own), and hashed at once.
CHUNK = 8 << 20
PIECE = 1 << 20
# Words whose questions one bucket answers.
BUCKET_WORDS = 2_000_000
# A key is this many bytes of a word's or a pair's hash; its last bit is set for words.
KEY_BYTES = 7
COUNT_BYTES = 6
# Pseudo-counts: of the word distribution in a history, and of the base distribution in the
# word distribution; each word has this chance in the base distribution.
HISTORY_WEIGHT = 4.0
BASE_WEIGHT = 10_000.0
BASE_CHANCE = 2.0**-20
_POWERS = np.cumprod(np.full(256, 0x100000001B3, np.uint64))
_STIR = np.uint64(0x9E3779B97F4A7C15)
_ZSTD = "zstd"


def cross_entropy_difference(
    docs: DataFrame, in_target: Column, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score, in_target`` for every row.

    The background model counts all rows, the target model those where ``in_target`` is true
    (null is false).  Both have the same vocabulary, order and smoothing, and background counts
    are scaled to the target's number of words.  A row is scored with its own counts taken
    out of both models.  Losses are nats per word; ``score`` is target less background, so low
    scores are like the target; without words (or text) losses are null.

    Words stand between ASCII white space, A-Z lower-cased.  Repeated rows are rows of their own,
    null ids stay null, texts are read whole, other columns are ignored, and an empty table gives
    no rows.
    """
    return _differences(_chunked(docs, in_target, text, doc_id))


def _chunked(docs: DataFrame, in_target: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The written chunks; ``in_target`` has a bit for each of a chunk's rows."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(in_target, F.lit(False)).alias("in_target"),
        F.col(text).cast("binary").alias("text"),
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    return staged(
        rows.mapInArrow(
            _chunks,
            f"chunk long, doc_ids array<{kind}>, in_target binary, lengths array<long>, "
            "words binary, vocabulary binary, n_words long, n_target_words long",
        ),
        "chunks",
    )


def _differences(chunks: DataFrame) -> DataFrame:
    kind = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    total = chunks.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("n_target_words"), F.lit(0)).alias("target_words"),
    ).first()
    answers = corpus_counts(chunks, bucket_bits(total["words"]))
    totals = (total["target_words"], total["words"])

    def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        return _score(chunk, answers, totals)

    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            score,
            f"doc_id {kind}, n_words long, target_loss double, background_loss double, "
            "score double, in_target boolean",
        )
    )


def bucket_bits(words: int) -> int:
    """So many bits of a key name its bucket that buckets stay within their size."""
    return min(24, max(6, (words // BUCKET_WORDS).bit_length()))


def corpus_counts(chunks: DataFrame, bits: int) -> DataFrame:
    """For every chunk and bucket, the corpus counts of the chunk's keys in key order.

    A chunk asks for a key once, with its own count, so a frequent word is no hot key.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield from _questions(batch.slice(at, 1), bits)

    asked = chunks.select("chunk", "in_target", "lengths", "words", "vocabulary").mapInArrow(
        ask, "bucket int, chunk long, keys binary, n binary, n_target binary"
    )
    return asked.groupBy("bucket").applyInArrow(
        _answer, "chunk long, bucket int, n binary, n_target binary"
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    names: list[pa.Array] = []
    marks: list[bool] = []
    texts: list[bytes] = []
    weight = 0

    def closed() -> pa.RecordBatch:
        hashes = list(hash_texts(texts))
        lengths = np.array([len(h) for h in hashes], np.int64)
        vocabulary, ids, n = np.unique(
            np.concatenate(hashes), return_inverse=True, return_counts=True
        )
        order = np.argsort(-n, kind="stable")  # small numbers for frequent words pack well
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        ids_of = pa.concat_arrays(names)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 33) + number]),
                pa.ListArray.from_arrays([0, len(ids_of)], ids_of),
                pa.array([np.packbits(marks).tobytes()], pa.binary()),
                pa.array([lengths]),
                pa.array([pa.compress(_planes(rank[ids], 4), _ZSTD, asbytes=True)]),
                pa.array([vocabulary[order].tobytes()], pa.binary()),
                pa.array([int(lengths.sum())]),
                pa.array([int(lengths[np.array(marks, bool)].sum())]),
            ],
            [
                *("chunk", "doc_ids", "in_target", "lengths", "words", "vocabulary"),
                *("n_words", "n_target_words"),
            ],
        )

    for batch in batches:
        ids, chosen = batch.column("doc_id"), batch.column("in_target").to_pylist()
        start = 0
        for at, text in enumerate(batch.column("text")):
            text = text.as_py() or b""
            marks.append(chosen[at])
            texts.append(text)
            weight += len(text) + 64  # so that empty texts fill a chunk as well
            if weight >= CHUNK:
                names.append(ids.slice(start, at + 1 - start))
                start = at + 1
                yield closed()
                number, weight = number + 1, 0
                names, marks, texts = [], [], []
        if start < len(ids):
            names.append(ids.slice(start))
    if texts:
        yield closed()


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of unsigned 64-bit integers, all the first ones first: they compress better."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, :width] = planes.T
    return values.view("<u8").ravel()


def _bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


class _Keys:
    """A chunk's texts as places in the sorted list of its keys."""

    def __init__(self, row: dict):
        self.lengths = np.array(row["lengths"], np.int64)
        size = int(self.lengths.sum())
        ids = _from_planes(pa.decompress(row["words"], size * 4, _ZSTD, asbytes=True), 4)
        words = np.frombuffer(row["vocabulary"], np.uint64)[ids.astype(np.int64)]
        self.owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.in_target = _bits(row["in_target"], len(self.lengths))
        self.mine = self.in_target[self.owner]
        self.follows = np.zeros(size, bool)
        self.follows[1:] = self.owner[1:] == self.owner[:-1]
        pairs = ((np.roll(words, 1) * np.uint64(31) ^ words) * _STIR)[self.follows]
        unused = np.uint64(64 - 8 * KEY_BYTES)
        self.keys, places = np.unique(
            np.concatenate([(words >> unused) | np.uint64(1), (pairs >> unused) & ~np.uint64(1)]),
            return_inverse=True,
        )
        self.word = places[:size]
        self.pair = np.full(size, -1, np.int64)
        self.pair[self.follows] = places[size:]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often all texts, and those of the target, have each key."""
        places = np.concatenate([self.word, self.pair[self.follows]])
        mine = np.concatenate([self.mine, self.mine[self.follows]])
        return tuple(np.bincount(p, minlength=len(self.keys)) for p in (places, places[mine]))

    def own(self, places: np.ndarray) -> np.ndarray:
        """How often the text itself has each of its keys."""
        _, back, n = np.unique(
            (self.owner << 32) | (places + 1), return_inverse=True, return_counts=True
        )
        return n[back]


def _questions(chunk: pa.RecordBatch, bits: int) -> Iterator[pa.RecordBatch]:
    row = chunk.to_pylist()[0]
    known = _Keys(row)
    everything, target = known.counts()
    bucket = (known.keys >> np.uint64(8 * KEY_BYTES - bits)).astype(np.int64)
    numbers, starts = np.unique(bucket, return_index=True)
    spans = [slice(s, e) for s, e in zip(starts, [*starts[1:], len(bucket)])]
    for at in range(0, len(spans), 10_000):
        some = spans[at : at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(numbers[at : at + 10_000].astype(np.int32)),
                pa.array([row["chunk"]] * len(some)),
                pa.array([_planes(known.keys[s], KEY_BYTES) for s in some], pa.binary()),
                pa.array([_planes(everything[s], COUNT_BYTES) for s in some], pa.binary()),
                pa.array([_planes(target[s], COUNT_BYTES) for s in some], pa.binary()),
            ],
            ["bucket", "chunk", "keys", "n", "n_target"],
        )


def _answer(asked: pa.Table) -> pa.Table:
    keys = [_from_planes(k.as_py(), KEY_BYTES) for k in asked["keys"]]
    edges = np.cumsum([len(k) for k in keys])[:-1]
    distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
    answers = []
    for name in ("n", "n_target"):
        n = np.concatenate([_from_planes(c.as_py(), COUNT_BYTES) for c in asked[name]])
        totals = np.bincount(places, n, len(distinct)).astype(np.uint64)
        answers.append([_planes(part, COUNT_BYTES) for part in np.split(totals[places], edges)])
    return pa.table(
        {
            "chunk": asked["chunk"],
            "bucket": asked["bucket"],
            "n": pa.array(answers[0], pa.binary()),
            "n_target": pa.array(answers[1], pa.binary()),
        }
    )


def _score(chunk: pa.Table, answers: pa.Table, totals: tuple[int, int]) -> pa.Table:
    row = chunk.select(["in_target", "lengths", "words", "vocabulary"]).to_pylist()[0]
    known = _Keys(row)
    answers = answers.sort_by("bucket")
    size = known.lengths
    losses = []
    own_word, own_pair = known.own(known.word), known.own(known.pair)
    history, own_history = np.roll(known.word, 1), np.roll(own_word, 1)
    scale = totals[0] / max(totals[1], 1)
    for name, total, share, inside in (
        ("n_target", totals[0], 1.0, known.mine),
        ("n", totals[1], scale, np.ones(len(known.word), bool)),
    ):
        parts = [_from_planes(a.as_py(), COUNT_BYTES) for a in answers[name]]
        table = np.concatenate([*parts, np.zeros(0, np.uint64)]).astype(np.float64)
        left = (total - size[known.owner] * inside) * share
        plain = ((table[known.word] - own_word * inside) * share + BASE_WEIGHT * BASE_CHANCE) / (
            left + BASE_WEIGHT
        )
        both = (table[known.pair] - own_pair * inside) * share
        past = (table[history] - own_history * inside) * share
        chance = np.where(
            known.follows, (both + HISTORY_WEIGHT * plain) / (past + HISTORY_WEIGHT), plain
        )
        losses.append(-np.bincount(known.owner, np.log(chance), len(size)) / np.maximum(size, 1))
    none = size == 0
    return pa.table(
        {
            "doc_id": pa.concat_arrays(chunk["doc_ids"].chunks).flatten(),
            "n_words": pa.array(size),
            "target_loss": pa.array(losses[0], mask=none),
            "background_loss": pa.array(losses[1], mask=none),
            "score": pa.array(losses[0] - losses[1], mask=none),
            "in_target": pa.array(known.in_target, pa.bool_()),
        }
    )


def hash_texts(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text; short texts are hashed together."""
    held: list[bytes] = []
    weight = 0
    for text in texts:
        if held and weight + len(text) > PIECE:
            yield from _hashes_of(held)
            held, weight = [], 0
        if len(text) > PIECE:
            yield np.concatenate([np.zeros(0, np.uint64), *map(_hashes, _pieces(text))])
        else:
            held.append(text)
            weight += len(text)
    yield from _hashes_of(held)


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space; a single endless word stays whole."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[at:end]
        at = end


def _hashes_of(texts: list[bytes]) -> list[np.ndarray]:
    """Word hashes of several short texts, found in one go."""
    if not texts:
        return []
    hashes, starts = _hash_words(b" ".join(texts))
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return np.split(hashes, np.searchsorted(starts, edges[1:-1]))


def _hashes(text: bytes) -> np.ndarray:
    return _hash_words(text)[0]


def _hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the start of every word: a polynomial of its bytes, stirred."""
    data = np.frombuffer(text.lower(), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    begins = np.zeros(len(data), np.int64)
    begins[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(begins)
    terms = np.where(inside, (data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255], np.uint64(0))
    sums = np.add.reduceat(terms, starts)
    sums += (ends - starts).astype(np.uint64)
    sums = (sums ^ (sums >> np.uint64(29))) * _STIR
    return (sums ^ (sums >> np.uint64(32))) * _STIR, starts


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores with the documents labelled good as target; repeated labels: any good one counts.

    The ids of the chunks are looked up, not the rows with their texts, which stay where they are.
    """
    good = staged(
        labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct(),
        "good",
    )
    chunks = _chunked(docs, F.lit(False))
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("at", "row"))
    rows = rows.select("chunk", "at", F.col("row.doc_ids").alias("doc_id"), F.col("row.lengths").alias("length"))
    found = lookup_join(rows, good, ["doc_id"], "left_semi", [])
    marks = staged(found.groupBy("chunk").applyInArrow(_marks, "chunk long, marks binary, marked_words long"), "marks")
    marked = lookup_join(chunks, marks, ["chunk"], "left", [])
    # Bits that are left out at the end are zero.
    named = {"in_target": F.coalesce("marks", "in_target"), "n_target_words": F.coalesce("marked_words", F.lit(0))}
    return _differences(marked.withColumns(named).drop("marks", "marked_words"))


def _marks(found: pa.Table) -> pa.Table:
    """The bits of a chunk's rows that are found, and how many words these have."""
    at = found["at"].to_numpy()
    bits = np.zeros(at.max() + 1, bool)
    bits[at] = True
    return pa.table(
        {
            "chunk": found["chunk"][:1],
            "marks": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "marked_words": pa.array([int(found["length"].to_numpy().sum())]),
        }
    )
