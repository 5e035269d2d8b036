"""Operators against brute force on small tables with awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter
from functools import lru_cache
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import chat, exact, language, mixing, packing, scoring, simhash, token_files
from tidemark.llm import tree_search, warc
from tidemark.llm.tokens import encoder, vocabulary

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "digest string, row string, fp string, copies string, chunk string, _u string"
)
COLUMN_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
WORDS = "the quick brown fox jumps over a lazy dog while rain falls on old stone roofs".split()
LONG = " ".join(WORDS[i * 7 % len(WORDS)] for i in range(40_000))
TEXTS = [
    (1, None), (2, ""), (3, "   "), (4, "One two"), (5, "one TWO"), (6, "a b c d e f g h"),
    (7, "a b c d e f g h"), (8, "a b c d e f g h"), (9, LONG), (10, LONG + " end"), (None, "no id"),
    (None, "no id"), (11, "dup row"), (11, "dup row"), (12, "über straße naïve 中文 <|endoftext|>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if n % 2 else None, "s" if n % 3 else None, None, "x", "x", "x", "x", "x", "x")
            for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


@lru_cache
def library():
    return Tokenizer.from_file(vocabulary())


def ids_of(text):
    return library().encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library():
    pieces = ["a", " ", "  ", "\n", "'s", "é", "ß.", "中", "👍", " ", "x,", "12", "İ"]
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(pieces, rng.integers(0, 20))) for _ in range(2000)] + [LONG]
    assert all(encoder(vocabulary()).encode(t).tolist() == ids_of(t) for t in texts)


def test_exact_dedup(docs, none):
    got = exact.exact_dedup(docs).collect()
    assert len(got) == len(TEXTS) and exact.exact_dedup(none).count() == 0
    groups: dict = {}
    for i, t in TEXTS:
        groups.setdefault(t or "", []).append(i)
    for r in got:
        group = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        known = [i for i in group if i is not None]
        assert (r.keep_id, r.group_size) == (max(known) if known else None, len(group))
    assert sum(r.kept for r in got) == len(groups)
    assert exact.kept_documents(docs).count() == len(groups)
    assert exact.kept_documents(docs).columns == docs.columns


def test_frequent_digests_are_found_among_many(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("string").cast("binary").alias("digest")
    )
    assert {bytes(r[0]) for r in exact.frequent_digests(rows, 16).collect()} >= {b"-1"}
    assert exact.frequent_digests(rows, 16).count() <= 16


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, none, monkeypatch):
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(t) for _, t in TEXTS]
    assert sorted(r.fingerprint for r in got) == sorted(f"{p:016x}" for p in prints)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert {r.component_id for r in got if r.doc_id in (6, 7, 8)} == {6}
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.fingerprint(LONG.encode(), 3) == plain_fingerprint(LONG)
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert simhash.fingerprint(LONG[:5000].encode(), 3) == plain_fingerprint(LONG[:5000])
    kept = simhash.first_of_each_group(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (6, 7, 8)").count() == 1


def plain_survivors(rows, least=0.8):
    """Ids of the first of each component of texts whose five-word shingles are alike."""
    sets, root = {}, {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i], root[i] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))}, i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            one, other = sets[a], sets[b]
            if a < b and min(len(one), len(other)) >= least * max(len(one), len(other)):
                if len(one & other) >= least * len(one | other):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i for i in root if find(i) == i}


def test_near_copies_equal_a_comparison_of_all(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rng = np.random.default_rng(6)
    rows = [(r.doc_id, r.text) for r in real]
    for group in range(3):
        base = rng.integers(0, 10_000, 120).astype(str)
        for n in range(90):  # copies of one text with words replaced, of which few differ much
            words = base.copy()
            words[rng.choice(120, rng.integers(0, 7), replace=False)] = f"w{n}"
            rows.append((10**6 + 1000 * group + n, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [r.doc_id for r in simhash.first_of_each_group(frame).select("doc_id").collect()]
    assert len(kept) == len(set(kept)) and set(kept) == plain_survivors(rows)


@pytest.mark.parametrize("slot", [1 << 17, 32])
def test_near_copies_meet_by_their_fingerprints(spark, monkeypatch, slot):
    """Four groups a tenth of whose bits differ from a text of their own, and unlike fingerprints."""
    monkeypatch.setattr(simhash, "SLOT", slot)
    rng, rows = np.random.default_rng(3), []
    for node in range(400):
        if node % 100 in (0, *range(60, 100)):
            base = rng.integers(0, 2, simhash.WIDE)
        bits = base ^ (rng.random(simhash.WIDE) < 0.07 if node % 100 < 60 else 0)
        rows.append((node, np.packbits(bits.astype(np.uint8)).tobytes(), bytes([node % 256, node // 256]), []))
    heads = spark.createDataFrame(rows, "node long, print binary, same binary, less array<binary>")
    meets = simhash._meetings(heads, 0.8)
    roots = {r.node: r.root for r in simhash.connected(meets).collect()}
    assert roots == {n: n // 100 * 100 for n in range(400) if n % 100 < 60}


def test_a_tiny_set_meets_those_with_one_shingle_more(spark):
    texts = ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g x", "z a b c d e f g h"]
    kept = simhash.first_of_each_group(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == plain_survivors(list(enumerate(texts))) == {0, 2}


@pytest.mark.parametrize("changed", [(4, 5), (0, 6)])
def test_candidates_grow_with_a_group_of_near_copies(spark, monkeypatch, changed):
    """Copies of one text, each with some of 100 words replaced."""
    rng, compared, survivors = np.random.default_rng(9), [], []
    verified = simhash._verified

    def counted(pairs, rows):
        compared[-1] += pairs.count()
        return verified(pairs, rows)

    monkeypatch.setattr(simhash, "_verified", counted)
    for size in (100, 400):
        base = rng.integers(0, 10_000, 100).astype(str)
        rows = []
        for n in range(size):
            words = base.copy()
            words[rng.choice(100, rng.integers(*changed), replace=False)] = f"w{n}"
            rows.append((n, " ".join(words)))
        compared.append(0)
        kept = simhash.first_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
        survivors.append(({r.doc_id for r in kept.select("doc_id").collect()}, plain_survivors(rows)))
    assert all(got == wanted for got, wanted in survivors)
    assert compared[1] <= 8 * max(compared[0], 100), compared


@pytest.mark.parametrize("paired", [2, 64])
def test_texts_with_common_differences_are_not_paired_off(spark, monkeypatch, paired):
    """Texts around one passage that share other passages in part; few are alike."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng, compared, verified = np.random.default_rng(12), [], simhash._verified

    def counted(pairs, rows):
        compared.append(pairs.count())
        return verified(pairs, rows)

    monkeypatch.setattr(simhash, "_verified", counted)
    common, passages = rng.integers(0, 10_000, 60).astype(str), rng.integers(0, 10_000, (4, 6, 30)).astype(str)
    rows = []
    for n in range(300):
        words = [*common, *(w for place in passages for w in place[rng.integers(6)])]
        rows.append((n, " ".join(words if n < 280 else rows[n - 280][1].split()[:-3])))
    kept = simhash.first_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in kept.select("doc_id").collect()} == plain_survivors(rows)
    assert sum(compared) <= 4 * len(rows), compared


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(1)
    for size in range(0, 2000, 20):
        one, other = (np.unique(rng.integers(0, 4000, n).astype(np.uint64)) for n in (size, size // 2))
        apart = np.bitwise_count((simhash.sketch(one) ^ simhash.sketch(other)).view(np.uint64)).sum()
        assert apart <= len(np.setxor1d(one, other))


@pytest.mark.parametrize("paired", [1, 64])
def test_crowded_blocks_lose_no_link(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = np.random.default_rng(1)
    prints = {0, (1 << 64) - 1}
    for centre in rng.integers(0, 1 << 62, 12):
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, 4), replace=False)
            prints.add(int(centre) ^ sum(1 << int(b) for b in flips))
    values = sorted(prints)
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(n, signed[v]) for n, v in enumerate(values)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.component_of(frame, 2, 4).collect()}
    wanted = {signed[v]: min(n for n, w in enumerate(values) if find(w) == find(v)) for v in values}
    assert got == wanted


def test_packing(docs, none):
    got = packing.pack_documents(docs, vocabulary(), 1).toPandas()
    assert packing.pack_documents(none, vocabulary(), 1).count() == 0
    texts = {i: t for i, t in TEXTS if i is not None and i != 11}
    for i, text in texts.items():
        pieces, ids = got[got.doc_id == i].sort_values("start"), [*ids_of(text), 1]
        at = 0
        for p in pieces.itertuples():
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, crc(ids[at : at + p.length]), len(ids))
            at += p.length
        assert at == len(ids)
    assert got.length.sum() == sum(len(ids_of(t)) + 1 for _, t in TEXTS)
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 2048
    assert set(got.sequence_id) == set(range(got.sequence_id.max() + 1))


def test_least_squares_fits_and_stays_positive():
    rng = np.random.default_rng(2)
    matrix = rng.integers(0, 3, (12, 40)).astype(float)
    wanted = matrix @ np.maximum(rng.normal(size=40), 0)
    x = packing.nonnegative_least_squares(matrix, wanted)
    assert (x >= 0).all() and np.abs(matrix @ x - wanted).max() < 1e-6


def test_token_files(spark, docs, none):
    got = token_files.read_token_files(spark, token_files.write_token_files(docs, vocabulary(), 0)).collect()
    order = sorted((r.start, r.n_tokens, r.doc_id, r.ids_crc32) for r in got)
    assert [o[2] for o in order] == sorted((i for i, _ in TEXTS), key=lambda i: -1 if i is None else i)
    assert sorted(o[3] for o in order) == sorted(crc([*ids_of(t), 0]) for _, t in TEXTS)
    assert [o[0] for o in order] == [0, *np.cumsum([o[1] for o in order])[:-1]]
    assert token_files.read_token_files(spark, token_files.write_token_files(none, vocabulary(), 0)).count() == 0


def test_warc(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, None), (4, "u", ""), (5, "u", "x" * 100_000),
            (6, "u\r\nv", "é\r\n0\r\n\r\n"), (7, "u", "same"), (7, "u", "same"), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archived_pages(spark, warc.write_archives(pages, F.col("html"))).collect()
    found = sorted(((r.page_id or -1, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=str)
    assert found == sorted([(1, "response", None, 4), (2, "revisit", 1, 4), (3, "response", None, 0), (4, "revisit", 3, 0),
                            (5, "response", None, 100_000), (6, "response", None, 9), (7, "revisit", 1, 4),
                            (7, "revisit", 1, 4), (-1, "revisit", 1, 4)], key=str)
    assert {r.payload_digest for r in got if r.page_id == 6} == {warc.base32_sha1("é\r\n0\r\n\r\n".encode())}
    none = spark.createDataFrame([], pages.schema)
    assert warc.archived_pages(spark, warc.write_archives(none, F.col("html"))).count() == 0
    cut = [{"segment": n, "total": 9, "block": b"x", "record_type": "response"} | dict.fromkeys(
        ("record_id", "refers_to", "page_id", "first_id", "digest")) for n in (1, 3)]
    assert "missing" in warc._logical(cut, True)["error"]
    # The rest of a record is lost: its first segment alone does not pass, chunked or not.
    alone = cut[0] | {"total": None, "block": b"HTTP/1.1 200 OK\r\n\r\nabc"}
    assert warc._logical([alone], True)["error"] and warc._logical([alone], False)["payload"] == b"abc"
    assert warc._logical([alone | {"total": len(alone["block"])}], True)["payload"] == b"abc"


def test_archives_are_read_by_as_many_tasks(spark):
    pages = spark.range(40).selectExpr("id AS page_id", "'u' AS url", "sha2(string(id), 512) AS html")
    archives = warc.write_archives(pages, F.col("html"), segment_bytes=100)
    count = archives.names.count()
    assert count > 4 and warc.read_archives(spark, archives).rdd.getNumPartitions() == count
    got = warc.archived_pages(spark, archives).collect()
    assert sorted(r.page_id for r in got) == list(range(40)) and {r.payload_bytes for r in got} == {128}


def test_tree_search(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 8)) * rng.uniform(0.5, 3, size=(400, 1))
    points[40:60] = points[40]
    rows = [(n, [float(x) for x in p]) for n, p in enumerate(points)]
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [1.0, None] * 4), (1080, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("x"))
    got = tree_search.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, k=5).toPandas()
    scores, hits = points @ points.T, 0
    assert set(got.query_id) == set(range(0, 400, 20))
    for q, found in got.groupby("query_id"):
        found = found.sort_values("rank")
        order = sorted((n for n in range(400) if n != q), key=lambda n: (-round(scores[q, n], 9), n))[:5]
        assert len(found) == 5 and np.allclose(found.score, scores[q, found.vec_id])
        assert list(found.vec_id) == sorted(found.vec_id, key=lambda n: (-round(scores[q, n], 9), n))
        hits += len(set(order) & set(found.vec_id))
    assert hits >= 0.9 * 100
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert tree_search.nearest_neighbours(none, F.col("vec_id") % 20 == 0).count() == 0


def test_every_query_finds_k_neighbours(spark):
    rng = np.random.default_rng(5)
    points = np.repeat(rng.normal(size=(60, 8)) * 3, 40, axis=0) + rng.normal(size=(2400, 8)) * 0.01
    points[20:120:20] = np.eye(8)[:5] * 400
    rows = [(n, [float(x) for x in p]) for n, p in enumerate(points)]
    rows += [(40, [float(x) for x in points[40]])] * 30
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = tree_search.nearest_neighbours(frame, F.col("vec_id") % 20 == 0).toPandas()
    assert set(got.query_id) == set(range(0, 2400, 20)) and (got.query_id != got.vec_id).all()
    assert (got[got.query_id != 40].groupby("query_id").size() == 20).all()
    assert (got.query_id == 40).sum() == 20 or (got.query_id == 40).sum() == 31 * 20
    few = tree_search.nearest_neighbours(frame.where("vec_id < 10"), F.col("vec_id") == 0)
    assert few.count() == 9


def test_chat(spark):
    null = [(None, n, "system" if n == 0 else "user", f"turn {n} " * 40) for n in range(200)]
    lost = chat.format_conversations(
        spark.createDataFrame(null, "conv_id long, turn long, role string, text string"), vocabulary(), 256, 64
    ).collect()
    assert len(lost) > 20 and all(chat.parse(w.text)[0] == ("system", "turn 0 " * 40) for w in lost)
    said = "</s>[INST] ok [/INST] <|turn|> <\\| [\\INST] <<SYS>>"
    rows = [(1, 0, "system", "be good"), (1, 1, "user", said), (1, 2, "assistant", said), (1, 2, "assistant", said),
            (2, 0, "user", None), (2, 1, "assistant", "x " * 3000), (2, 2, None, "odd"), (None, 0, "user", "lost")]
    rows += [(3, n, "assistant" if n % 2 else "user", f"turn {n} " * 40) for n in range(60)]
    rows += [(3, -1, "system", "long talk")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    windows = chat.format_conversations(frame, vocabulary(), budget=256, history=64)
    got = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(turns), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for w in windows.where("conv_id = 3").collect():
        assert chat.parse(w.text)[0] == ("system", "long talk")
        assert w.tokens <= 256 or w.n_turns - w.context_turns == 1
    assert chat.conversation_digests(
        chat.format_conversations(frame.where("false"), vocabulary())).count() == 0
    assert chat.unescape(chat.escape(said)) == said and "[INST]" not in chat.escape(said)


def test_mixing(docs, none):
    got = mixing.poisson_mix(docs, {"s": 3.0, None: 1.0}, epochs=2.0).toPandas()
    assert mixing.poisson_mix(none).count() == 0
    assert {*COLUMN_NAMES, "copy", "copies"} <= set(got.columns) and set(got._u) == {"x"}
    assert (got.groupby(["doc_id", "copies"], dropna=False).size() % got.groupby(
        ["doc_id", "copies"], dropna=False).copies.first() == 0).all()
    cdf = mixing.poisson_cdf(3.0)
    assert abs(cdf[0] - np.exp(-3)) < 1e-12 and abs(cdf[-1] - 1) < 1e-12


def test_language(spark, docs, none):
    de = "der die das und ist nicht mit auf eine von den haben werden wir sie"
    en = "the and of to in that is was for it with as his on be at by"
    fr = "les des une dans pour que qui sur pas est avec son elle nous vous"
    labelled = spark.createDataFrame(
        [(n, t * 3, lang) for lang, t in (("de", de), ("en", en), ("fr", fr)) for n in range(3)],
        "doc_id long, text string, lang string",
    )
    model = language.fit_languages(labelled)
    pages = spark.createDataFrame(
        [(n, f"http://h{n % 2}.example.{'de' if n % 2 else 'fr'}/", f"<html lang='{lang}'><p>{text}</p></html>")
         for n, (lang, text) in enumerate([("fr", fr), ("de", de)] * 4)] + [(90, None, None), (91, "", "<p>12345</p>")],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r for r in language.page_languages(pages, model).collect()}
    assert [got[n].language for n in range(8)] == ["fr", "de"] * 4 and all(got[n].accepted for n in range(8))
    assert not got[90].accepted and got[91].language == "und"
    kept = language.documents_in_known_languages(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id in (1, 2, 3)").count() == 0
    assert kept.where("doc_id in (6, 9)").count() >= 1
    assert language.page_languages(pages.where("false"), model).count() == 0
    for unlabelled in (none, docs.withColumn("lang", F.lit(None).cast("string"))):
        nothing = language.fit_languages(unlabelled)
        assert nothing.languages == () and language.documents_in_known_languages(docs, nothing).count() == 0
        found = language.page_languages(pages, nothing).collect()
        assert {(r.language, r.accepted) for r in found} == {("und", False)}
    copies = [(n, "x y z", "de") for n in range(3000)] + [(n, en * 9 + str(n), "de") for n in range(5)]
    frame = spark.createDataFrame(copies, "doc_id long, text string, lang string")
    few = language.fit_languages(frame, texts_per_language=6)
    letters = sum(c.isalpha() for t in {t for _, t, _ in copies} for c in t)
    chances = np.exp(few.logs[0].astype(float))
    assert abs((chances / chances.min()).sum() - language.CELLS - letters / 0.1) < 1


def test_scoring(spark, docs, none):
    good = [(n, f"alpha beta gamma delta {n % 3}") for n in range(40)]
    bad = [(100 + n, f"omega psi chi phi {n % 3}") for n in range(40)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string")
    got = scoring.cross_entropy_difference(frame, F.col("doc_id") < 20).toPandas().set_index("doc_id")
    # Held out: documents 20 to 39 are like the target but not part of it.
    assert got.loc[20:39, "score"].max() < got.loc[100:, "score"].min()
    odd = scoring.cross_entropy_difference(docs, F.col("lang") == "en").toPandas()
    assert len(odd) == len(TEXTS) and odd.score.isna().sum() == 3
    assert scoring.cross_entropy_difference(none, F.lit(True)).count() == 0
    word, _ = scoring._hash_words(b" One  two\tone ")
    assert len(word) == 3 and word[0] == word[2] != word[1]


def ascii_words(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def test_scores_equal_a_count_of_everything(spark, docs):
    rows = [(r.doc_id, r.lang == "en", ascii_words(r.text)) for r in docs.collect()]
    words, pairs = Counter(), Counter()
    for _, mine, text in rows:
        for side in (False, True) if mine else (False,):
            words.update((side, w) for w in text)
            pairs.update((side, *p) for p in zip(text, text[1:]))
    size = [sum(n for (side, _), n in words.items() if side is s) for s in (False, True)]

    def loss(mine, text, side):
        out = mine or not side
        share = 1.0 if side else size[1] / size[0]
        own, own_pairs = Counter(text), Counter(zip(text, text[1:]))
        total = 0.0
        for at, w in enumerate(text):
            left = (size[side] - len(text) * out) * share
            here = (words[side, w] - own[w] * out) * share
            chance = (here + scoring.BASE_WEIGHT * scoring.BASE_CHANCE) / (left + scoring.BASE_WEIGHT)
            if at:
                past, pair = text[at - 1], (text[at - 1], w)
                both = (pairs[side, *pair] - own_pairs[pair] * out) * share
                before = (words[side, past] - own[past] * out) * share
                chance = (both + scoring.HISTORY_WEIGHT * chance) / (before + scoring.HISTORY_WEIGHT)
            total -= math.log(chance)
        return total / len(text)

    want = sorted(
        (-1 if n is None else n, len(t), *((loss(m, t, True), loss(m, t, False)) if t else (None, None)))
        for n, m, t in rows
    )
    got = scoring.cross_entropy_difference(docs.repartition(5), F.col("lang") == "en")
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_words, r.target_loss, r.background_loss)
        for r in got.collect()
    )
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == (pytest.approx(w[2:], rel=1e-9) if w[1] else (None, None))


def test_chunks_are_bounded_and_hold_every_row(spark):
    texts = [b"some words here"] * 500_000 + [b"x y " * (3 << 20)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(len(texts))), "in_target": [False] * len(texts), "text": texts}
    )
    with mock.patch.object(scoring.TaskContext, "get", lambda: mock.Mock(partitionId=lambda: 1)):
        chunks = [c.to_pylist()[0] for c in scoring._chunks(iter([batch]))]
    assert len(chunks) > 3 and len({c["chunk"] for c in chunks}) == len(chunks)
    assert [n for c in chunks for n in c["doc_ids"]] == list(range(len(texts)))
    assert sum(c["n_words"] for c in chunks) == 500_000 * 3 + 2 * (3 << 20)
