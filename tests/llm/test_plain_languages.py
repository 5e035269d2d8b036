"""Language evidence and the whole pipeline against plain Python on whole tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_operators import plain_survivors
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import language, mixing, queries
from tidemark.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"
CELLS, EVIDENCE, PRIOR, FLOOR = 1 << 15, 200, 20, 0.5


def triples(data):
    """Cells of the letter triples of a text's bytes."""
    small = [b + 32 if 65 <= b <= 90 else b for b in data]
    small = [b if 97 <= b <= 122 or b >= 128 else 32 for b in small]
    last = [32, 32]
    for b in small:
        last = [*last[-2:], b]
        if b != 32:
            yield ((last[0] << 16 | last[1] << 8 | last[2]) * 0x9E3779B1 >> 12) % CELLS


def fitted(docs):
    """By language the log chance of each cell, from its different texts."""
    distinct = defaultdict(set)
    for _, text, lang, *_ in docs:
        if lang is not None and text:
            distinct[lang].add(text)
    model = {}
    for lang, texts in distinct.items():
        assert len(texts) <= language.FIT_TEXTS
        counts = Counter(cell for text in texts for cell in triples(text.encode()))
        total = sum(counts.values()) + 0.1 * CELLS
        model[lang] = defaultdict(lambda t=total: np.log(0.1 / t), {c: np.log((n + 0.1) / total) for c, n in counts.items()})
    return model


def softmax(logs):
    top = max(logs.values())
    shares = {k: np.exp(v - top) for k, v in logs.items()}
    return {k: v / sum(shares.values()) for k, v in shares.items()}


def identified(rows, model):
    """(language, confidence, accepted) of rows (text, declared, host)."""
    names = [*sorted(model), "und"]
    seen = []
    for text, declared, host in rows:
        cells = list(triples((text or "").encode()))
        weight = min(len(cells), EVIDENCE)
        logs = {lang: weight * np.mean([model[lang][c] for c in cells] or [0]) for lang in model}
        logs["und"] = -weight * np.log(CELLS)
        levels = {"declared": declared.split("-")[0].lower() if declared is not None else None}
        labels = host.lower().split(".") if host is not None else None
        for level, count in (("suffix", 1), ("domain", 2), ("host", 10**6)):
            levels[level] = ".".join(labels[-count:]) if labels else None
        seen.append((len(cells) > 0, logs, softmax(logs), levels))
    base = {k: 1.0 + sum(alone[k] for ok, _, alone, _ in seen if ok) for k in names}
    base = {k: v / sum(base.values()) for k, v in base.items()}
    sums = defaultdict(lambda: dict.fromkeys(names, 0.0))
    for ok, _, alone, levels in seen:
        for level, value in levels.items():
            if ok and value is not None:
                for k in names:
                    sums[level, value][k] += alone[k]
    found = []
    for ok, logs, alone, levels in seen:
        def others(level):
            if levels[level] is None:
                return dict.fromkeys(names, 0.0)
            counts = sums[level, levels[level]]
            return {k: max(0.0, counts[k] - (alone[k] if ok else 0)) for k in names}

        prior = base
        for level in ("suffix", "domain", "host"):
            counts = others(level)
            total = sum(counts.values()) + PRIOR
            prior = {k: (counts[k] + PRIOR * prior[k]) / total for k in names}
        counts = others("declared")
        total = sum(counts.values()) + 1
        fused = softmax({k: logs[k] + np.log(prior[k]) + np.log((counts[k] + base[k]) / total / base[k]) for k in names})
        best = max(names, key=lambda k: fused[k]) if ok else "und"
        found.append((best, max(fused.values()), best != "und" and max(fused.values()) >= FLOOR))
    return found


def rows_of(name, order):
    return duckdb.execute(f"SELECT * FROM '{SF}/{name}.parquet' ORDER BY {order}").fetchall()


@pytest.fixture(scope="module")
def model():
    return fitted(rows_of("documents", "doc_id"))


def test_op7(spark, model):
    pages, ids = [], []
    for page_id, url, html in rows_of("pages", "page_id"):
        html = html or ""
        bare = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ", html)
        tag = re.search(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", html)
        host = re.search(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
        pages.append((bare, tag and tag[1], host and host[1]))
        ids.append(page_id)
    expected = dict(zip(ids, identified(pages, model), strict=True))
    got = {r.page_id: r for r in queries.op7_language_id(spark, SF).collect()}
    assert set(got) == set(expected)
    for page_id, (name, sure, accepted) in expected.items():
        r = got[page_id]
        assert abs(r.confidence - sure) < 1e-3, page_id
        # Two languages that are as likely as each other may come in either order.
        assert (r.language, r.accepted) == (name, accepted) or abs(sure - FLOOR) < 1e-3


def test_documents_in_their_languages_are_kept(spark, model):
    docs = rows_of("documents", "doc_id")
    odd = [(10**6 + n, text, "en", "s", 0) for n, text in enumerate(
        ("0123 4567 89", None, "", "zxq zvq xqj wqz vvx kqj zzq " * 40, "жшщ ъыь " * 60))]
    found = identified([(text, lang, source) for _, text, lang, source, _ in docs + odd], model)
    expected = {row[0] for row, (_, _, accepted) in zip(docs + odd, found, strict=True) if accepted}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    fit = language.fit_languages(frame)
    both = frame.unionAll(spark.createDataFrame(odd, frame.schema))
    got = {r.doc_id for r in language.documents_in_known_languages(both, fit).collect()}
    assert got == expected and len(expected & {row[0] for row in docs}) >= 0.98 * len(docs)
    assert not got & {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 3, 10**6 + 4}


def plain_pipeline(model, docs):
    """How often each document is packed."""
    found = identified([(text, lang, source) for _, text, lang, source, _ in docs], model)
    kept = [row for row, (_, _, accepted) in zip(docs, found, strict=True) if accepted]
    kept = list({row[1]: row for row in sorted(kept)}.values())  # the largest id of equal texts
    stay = plain_survivors([(row[0], row[1]) for row in kept])
    kept = [row for row in kept if row[0] in stay]
    sizes = Counter()
    for _, text, _, source, _ in kept:
        sizes[source] += len(text)
    scale = sum(sizes.values()) / sum(n**0.5 for n in sizes.values())
    times = {}
    for doc_id, text, _, source, _ in kept:
        rate = scale * sizes[source] ** 0.5 / sizes[source]
        chance = (int(hashlib.md5(f"17:{doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        times[doc_id] = int((mixing.poisson_cdf(rate) < chance).sum())
    return {row[0]: row[1] for row in kept}, times


def test_pipeline(spark, model, tmp_path):
    docs = rows_of("documents", "doc_id")
    base = [row for row in docs if len(row[1].split()) > 60][:6]
    added = [(5000 + n, row[1], row[2], row[3], None) for n, row in enumerate(base)]  # exact copies
    added += [(6000 + n, row[1] + " and one word more", row[2], row[3], None) for n, row in enumerate(base)]
    added += [(7000, "12 34 56", "en", "s", None), (7001, None, "en", "s", None)]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    frame.unionAll(spark.createDataFrame(added, frame.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    every = docs + added
    texts, times = plain_pipeline(fitted(every), every)
    assert len(texts) <= len(docs) and 7000 not in texts
    library = Tokenizer.from_file(vocabulary())
    expected = Counter()
    for doc_id, count in times.items():
        if count:
            ids = [*library.encode(texts[doc_id], add_special_tokens=False).ids, 1]
            expected[doc_id, len(ids)] = count * len(ids)
    got, starts, sequences = Counter(), Counter(), Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        ids = [*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 1][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        got[r.doc_id, r.doc_tokens] += r.length
        starts[r.doc_id] += r.start == 0
        sequences[r.sequence_id] += r.length
    assert got == expected and max(sequences.values()) <= 2048
    assert {k: v for k, v in starts.items() if v} == {k: v for k, v in times.items() if v}
