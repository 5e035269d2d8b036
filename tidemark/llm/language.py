"""Language identification: text, declared markup, address suffix and host evidence fused."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from tidemark.llm.exact import row_key, unused
from tidemark.operators.lookup import lookup_join
from tidemark.session import staged

# Different texts of each language that the model is fitted on.
FIT_TEXTS = 1000
CELLS = 1 << 15
# Letters of evidence that a text counts for at most: neighbouring letters say the same thing
# again, so beyond that a longer text does not outvote everything else by more.
EVIDENCE = 200.0
# Rows' worth of the level above that a prior starts from: suffix, domain, host.
PRIOR_ROWS = 20.0
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logs: np.ndarray  # languages x CELLS: log probability of a letter triple


def fit_languages(
    docs: DataFrame, text: str = "text", lang: str = "lang", texts_per_language: int = FIT_TEXTS
) -> LanguageModel:
    """Letter-triple model per language from at most ``texts_per_language`` labelled texts of each.

    The sample holds the first different texts by a hash of the text, whole; copies count once,
    so that a large group of them does not become the sample.  Rows without a label or text do
    not count; without any other rows (an empty table, say) the model knows no language, and
    whatever it reads is ``und``.  Other columns are ignored.
    """
    labelled = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("h"), F.col(text).cast("binary").alias("text")
    )
    known = staged(labelled.select("lang", "h").distinct(), "labelled")
    sizes = staged(known.groupBy("lang").agg(F.count("*").alias("texts")), "label-sizes")
    # A hash below this share leaves about twice the texts wanted, however many there are.
    share = F.pmod(F.col("h"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    likely = lookup_join(known, sizes, ["lang"], "inner", [F.col("h")]).where(
        share * F.col("texts") < 2 * texts_per_language
    )
    first = Window.partitionBy("lang").orderBy("h")
    chosen = likely.withColumn("n", F.row_number().over(first)).where(F.col("n") <= texts_per_language)
    chosen = staged(chosen.select("lang", "h"), "chosen")
    texts = lookup_join(labelled, chosen, ["lang", "h"], "left_semi", [F.monotonically_increasing_id()])
    once = texts.groupBy("lang", "h").agg(F.first("text").alias("text"))
    counts = once.select("lang", "text").mapInArrow(_count_triples, "lang string, cell int, n long")
    # At most CELLS rows a language: the model itself.
    found = counts.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    seen = np.full((len(names), CELLS), 0.1)
    rows = np.searchsorted(np.array(names, dtype=object), np.array(found.column("lang").to_pylist(), dtype=object))
    seen[rows.astype(np.int64), found.column("cell").to_numpy()] += found.column("n").to_numpy()
    return LanguageModel(tuple(names), np.log(seen / seen.sum(axis=1, keepdims=True)).astype(np.float32))


def _count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            seen = held.setdefault(name, np.zeros(CELLS, np.int64))
            data = text.as_py()
            for at in range(0, len(data), 1 << 18):
                cells, letters = letter_cells(np.frombuffer(data[at : at + (1 << 18)], np.uint8))
                seen += np.bincount(cells[letters], minlength=CELLS)
    for name, seen in held.items():
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(seen[cells])],
            ["lang", "cell", "n"],
        )


def letter_cells(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte the cell of the triple that ends there, and whether it is of a letter.

    Bytes beyond ASCII count as letters, A-Z as a-z, everything else as one blank.
    """
    small = np.where((data >= 65) & (data <= 90), data + 32, data)
    letter = ((small >= 97) & (small <= 122)) | (small >= 128)
    small = np.where(letter, small, 32).astype(np.int64)
    padded = np.concatenate([[32, 32], small])
    triple = (padded[:-2] * 256 + padded[1:-1]) * 256 + padded[2:]
    return ((triple * 0x9E3779B1) >> 12 & (CELLS - 1)).astype(np.int32), letter


def text_evidence(
    rows: DataFrame, model: LanguageModel, text: str, keep: list[str]
) -> DataFrame:
    """``keep`` columns, ``letters``, ``text_log`` and ``alone``, an entry per language and ``und``.

    ``text_log`` is the mean log-likelihood of a letter times the letters that count as evidence,
    ``alone`` the shares that follow from it without any other evidence.
    """
    schema = rows.select(*keep).schema.add("letters", LongType())
    schema = schema.add("text_log", ArrayType(DoubleType())).add("alone", ArrayType(DoubleType()))
    logs = model.logs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.zeros(batch.num_rows, np.int64)
            means = np.full((batch.num_rows, len(logs) + 1), -np.log(CELLS))
            for k, value in enumerate(batch.column(batch.num_columns - 1)):
                letters[k], total = _read_letters(value.as_py() or b"", logs)
                means[k, :-1] = total / max(letters[k], 1)
            weighed = means * np.minimum(letters, EVIDENCE)[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(letters), _lists(weighed), _lists(_shares(weighed))],
                names=[*keep, "letters", "text_log", "alone"],
            )

    return rows.select(*keep, F.col(text).cast("binary").alias("_text")).mapInArrow(run, schema)


def _read_letters(text: bytes, logs: np.ndarray) -> tuple[int, np.ndarray]:
    n, total = 0, np.zeros(len(logs))
    for at in range(0, len(text), 1 << 18):
        cells, letter = letter_cells(np.frombuffer(text[at : at + (1 << 18)], np.uint8))
        total += logs[:, cells[letter]].sum(axis=1, dtype=np.float64)
        n += int(letter.sum())
    return n, total


def _shares(logs: np.ndarray) -> np.ndarray:
    shifted = np.exp(logs - logs.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def _lists(values: np.ndarray) -> pa.Array:
    edges = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values.ravel()))


def _table(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists as rows; null lists become zeros."""
    values = np.zeros((len(column), width))
    values[column.is_valid().to_numpy(zero_copy_only=False)] = (
        column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    )
    return values


def identify_languages(
    rows: DataFrame,
    model: LanguageModel,
    keys: list[str],
    text: Column,
    declared: Column,
    host: Column,
    floor: float = 0.5,
) -> DataFrame:
    """``keys`` and ``language, confidence, text_language, accepted`` for every row.

    Evidence, each part null where it is missing and then without influence:
    the text's letter triples; the declared language, weighed by how often rows that declare it
    read like each language; and a prior for the host, smoothed towards its domain (last two
    labels), that towards its suffix (last label) and that towards all rows.  Those counts are
    sums of what the texts alone say, made by grouped aggregation, and a row is left out of its
    own.  The unknown language takes part with the likelihood of evenly spread triples, so a
    text unlike all languages, or without letters, is ``und`` and not accepted; neither is one
    whose best language stays under ``floor``.
    """
    names = [*model.languages, UNKNOWN]
    host_name = F.lower(host)
    domain = F.substring_index(host_name, ".", -2)
    source = rows.select(
        *keys,
        F.lower(F.substring_index(declared, "-", 1)).alias("_declared"),
        F.substring_index(host_name, ".", -1).alias("_suffix"),
        domain.alias("_domain"),
        host_name.alias("_host"),
        text.alias("_text"),
    )
    parts = ["_declared", "_suffix", "_domain", "_host"]
    scored = staged(text_evidence(source, model, "_text", [*keys, *parts]), "evidence")
    seen = scored.where(F.col("letters") > 0)
    sums = F.array(*[F.sum(F.col("alone")[k]) for k in range(len(names))])
    everything = np.array(seen.agg(sums.alias("n")).first()["n"], dtype=np.float64)
    everything = np.nan_to_num(everything) + 1.0
    joined = scored
    for level in parts:
        counts = staged(
            seen.where(F.col(level).isNotNull()).groupBy(level).agg(sums.alias(f"{level}_n")), "counts"
        )
        joined = lookup_join(joined, counts, [level], "left", [F.xxhash64(*keys)])
    schema = rows.select(*keys).schema.add("language", "string").add("confidence", "double")
    schema = schema.add("text_language", "string").add("accepted", "boolean")
    base = everything / everything.sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _fused(batch, keys, names, base, floor)

    columns = [*keys, "letters", "text_log", "alone", *[f"{level}_n" for level in parts]]
    return joined.select(*columns).mapInArrow(run, schema)


def _fused(
    batch: pa.RecordBatch, keys: list[str], names: list[str], base: np.ndarray, floor: float
) -> pa.RecordBatch:
    width = len(names)
    alone = _table(batch.column("alone"), width)
    seen = batch.column("letters").to_numpy() > 0
    own = alone * seen[:, None]

    def others(level: str) -> np.ndarray:
        return np.maximum(_table(batch.column(f"{level}_n"), width) - own, 0.0)

    prior = np.broadcast_to(base, alone.shape)
    for level in ("_suffix", "_domain", "_host"):
        counts = others(level)
        prior = (counts + PRIOR_ROWS * prior) / (counts.sum(axis=1, keepdims=True) + PRIOR_ROWS)
    # P(declared | language) up to a factor: P(language | declared) / P(language).
    counts = others("_declared")
    declared = (counts + base) / (counts.sum(axis=1, keepdims=True) + 1.0) / base
    fused = _shares(_table(batch.column("text_log"), width) + np.log(prior) + np.log(declared))
    labels = np.array(names, dtype=object)
    best = np.where(seen, labels[fused.argmax(axis=1)], UNKNOWN)
    sure = fused.max(axis=1)
    return pa.RecordBatch.from_arrays(
        [
            *[batch.column(k) for k in keys],
            pa.array(best, pa.string()),
            pa.array(sure),
            pa.array(np.where(seen, labels[alone.argmax(axis=1)], UNKNOWN), pa.string()),
            pa.array((best != UNKNOWN) & (sure >= floor)),
        ],
        [*keys, "language", "confidence", "text_language", "accepted"],
    )


def page_languages(pages: DataFrame, model: LanguageModel) -> DataFrame:
    """``page_id`` and the findings for web pages: text between tags, ``lang`` of the root.

    A null or empty page has no letters, so it is ``und`` and not accepted; a null url has no host;
    null and repeated ids are rows like others; other columns are ignored; no pages, no rows.
    Whole pages are read, however long.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    tag = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return identify_languages(pages, model, ["page_id"], bare, F.nullif(tag, F.lit("")), F.nullif(host, F.lit("")))


def documents_in_known_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents that are accepted; ``lang`` is what they declare, ``source`` the host.

    All columns are returned as they were, also of rows that are there several times: rows with
    one id and text go if one of them is rejected.  Null and empty texts have no letters and go;
    null ids, languages and sources are missing evidence only.  An empty table stays empty.
    """
    name = unused(docs, "key")
    keyed = docs.withColumn(name, row_key(F.col("doc_id"), F.col("text")))
    found = identify_languages(keyed, model, [name], F.col("text"), F.col("lang"), F.col("source"))
    rejected = staged(found.where(~F.col("accepted")).select(name).distinct(), "rejected")
    return lookup_join(keyed, rejected, [name], "left_anti", [F.monotonically_increasing_id()]).drop(name)
