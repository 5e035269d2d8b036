"""Token ids in flat binary files with 64-bit document offsets, read back through memory maps.

A part has three files of little-endian integers: ``N.ids`` (unsigned, 16 bits if the
vocabulary fits, else 32), ``N.offsets`` (unsigned 64-bit, one more than documents) and
``N.docs`` (signed 64-bit ids of the documents; the smallest value stands for null).  Parts
follow one another in ascending order of document ids.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import Attempt, mapped, shared_folder
from tidemark.llm.tokens import encoder
from tidemark.session import staged

NO_ID = -(1 << 63)
WRITE_BYTES = 1 << 20
_PARTS = "part long, docs long, tokens long"


@dataclass(frozen=True)
class TokenFiles:
    """A written corpus: its folder, the kind of its ids, and one row per part."""

    folder: str
    kind: str
    parts: DataFrame


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    text: str = "text",
    doc_id: str = "doc_id",
    folder: str | None = None,
) -> TokenFiles:
    """Encode every whole text (null: empty), add ``end_id``, write in ascending id order.

    Null ids come first; rows with one id are ordered by a hash of the text, and each is a
    document.  Other columns are ignored; an empty table gives no parts.  The documents are
    range-partitioned, and every task streams its range into one part.
    """
    target = folder or shared_folder(docs.sparkSession, "tokens")
    kind = "<u2" if max(encoder(vocabulary).size - 1, end_id) < 1 << 16 else "<u4"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _write_part(batches, target, vocabulary, end_id, kind)

    return TokenFiles(target, kind, staged(dealt.mapInArrow(run, _PARTS), "parts"))


def _write_part(batches, folder: str, vocabulary: str, end_id: int, kind: str):
    part = TaskContext.get().partitionId()
    encode = encoder(vocabulary).encode
    ending = np.array([end_id], kind).tobytes()
    attempt, names, offsets = Attempt(folder), array("q"), array("Q", [0])
    with ExitStack() as stack:
        stream, waiting = None, bytearray()
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_pylist()
            for name, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                stream = stream or stack.enter_context(attempt.create(f"{part}.ids"))
                tokens = encode(text or "").astype(kind)
                waiting += tokens.tobytes() + ending
                if len(waiting) > WRITE_BYTES:
                    stream.write(waiting)
                    waiting = bytearray()
                names.append(name)
                offsets.append(offsets[-1] + len(tokens) + 1)
        if stream:
            stream.write(waiting)
    if names:
        for suffix, values in (("docs", names), ("offsets", offsets)):
            with attempt.create(f"{part}.{suffix}") as stream:
                stream.write(values.tobytes())
        attempt.publish()
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "docs": [len(names)], "tokens": [offsets[-1]]}
        )


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    A part's base is the sum of the parts before it: one number per part is added up on the
    driver, as many as the writing had tasks.  Repeated documents are there as often as they were
    written, null ids are null again, and without parts there are no rows.
    """
    parts = files.parts.orderBy("part").collect()
    bases = accumulate((p["tokens"] for p in parts), initial=0)
    table = spark.createDataFrame(
        [(p["part"], base) for p, base in zip(parts, bases)], "part long, base long"
    )
    folder, kind = files.folder, files.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _read_part(folder, kind, row["part"], row["base"])

    return table.repartition(max(1, len(parts)), "part").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def _read_part(folder: str, kind: str, part: int, base: int, rows: int = 10_000):
    ids = mapped(folder, f"{part}.ids", kind)
    offsets = mapped(folder, f"{part}.offsets", "<u8")
    names = mapped(folder, f"{part}.docs", "<i8")
    if len(offsets) != len(names) + 1 or (len(offsets) and offsets[-1] != len(ids)):
        raise ValueError(f"part {part} does not match its offsets")
    for at in range(0, len(names), rows):
        some = np.array(names[at : at + rows])
        edges = offsets[at : at + rows + 1].astype(np.int64)
        sums = [
            zlib.crc32(ids[s:e].astype("<u4").tobytes()) for s, e in zip(edges[:-1], edges[1:])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, mask=some == NO_ID),
                pa.array(edges[:-1] + base),
                pa.array(np.diff(edges)),
                pa.array(sums, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )
