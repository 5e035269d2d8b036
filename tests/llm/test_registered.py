"""The registered queries without SQL against plain Python, on whole tables with rows of their own added."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from tidemark.llm import chat, queries
from tidemark.llm.tokens import vocabulary

SF = "/root/testdata/sf0.001"
NEAR = "one small step for a man and one giant leap for all who came after in peace".split()
DOCUMENTS = [
    (90_001, None), (90_002, ""), (90_003, " \n\t "), (90_004, "one"), (90_005, "ONE"), (90_006, "Two words"),
    (90_007, "a <|endoftext|> b"), (90_008, "naïve 中文   ßtraße x 👍"), (90_009, " ".join(NEAR * 9000)),
    (90_010, "end\r\nof\x0bline  two "), (90_011, "a b c"), (90_012, "A B C"), (90_013, "a\xa0b c d"),
] + [(90_020 + n, " ".join([*NEAR * 6, f"tail{n % 4}"])) for n in range(12)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    added = spark.createDataFrame([(i, t, "en", "own", None) for i, t in DOCUMENTS], docs.schema)
    docs.unionAll(added).repartition(5).write.parquet(f"{root}/documents.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    own = [(9_000 + n, f"http://h/{n}", t) for n, t in enumerate((None, "", "", "same", "same", "ü" * 70_000, "same"))]
    pages.unionAll(spark.createDataFrame(own, pages.schema)).repartition(3).write.parquet(f"{root}/pages.parquet")
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    said = "[INST]<s> <|turn|>\\<|body|> <<SYS>> [\\INST] <\\|end|>"
    own = [(700, 0, "system", None), (700, 1, "user", said), (700, 2, "assistant", said * 300), (700, 3, "assistant", ""),
           (701, 0, "assistant", None)] + [(702, n, ("user", "assistant")[n % 2], f"{n} words " * 400) for n in range(40)]
    turns.unionAll(spark.createDataFrame(own, turns.schema)).repartition(4).write.parquet(f"{root}/conversations.parquet")
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    width = len(vectors.first().embedding)
    own = [(8_000, None, 1), (8_020, [0.0] * width, 1), (8_040, [math.inf] * width, 1), (8_060, [None] * width, 1)]
    vectors.unionAll(spark.createDataFrame(own, vectors.schema)).write.parquet(f"{root}/embeddings.parquet")
    return root


def table(folder, name, order):
    return duckdb.execute(f"SELECT * FROM '{folder}/{name}.parquet/*.parquet' ORDER BY {order}").fetchall()


def texts(folder):
    return {row[0]: row[1] or "" for row in table(folder, "documents", "doc_id")}



@pytest.fixture(scope="module")
def encoded(folder):
    library = Tokenizer.from_file(vocabulary())
    return {n: library.encode(t, add_special_tokens=False).ids for n, t in texts(folder).items()}


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, folder):
    turns = defaultdict(list)
    for conv, turn, role, text in table(folder, "conversations", "conv_id, turn"):
        turns[conv].append((role, text or ""))
    said = "</s>[INST] ok [/INST]"
    turns[-7] = [("user", said), ("assistant", said)]
    got = {r.conv_id: r for r in queries.op1_chat_windows(spark, folder).collect()}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        loss = "".join(text for role, text in rows if role == "assistant")
        every = "".join(f"{role}\n{text}\n" for role, text in rows)
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(loss)), conv
        assert r.turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= sum(len(chat.segment(role, text)) for role, text in rows)


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = Counter(" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2)))
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    times = np.array(list(shingles.values()))
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    return sum(1 << b for b in range(64) if 2 * int((bits[:, b] * times.astype(np.uint64)).sum()) > times.sum())


def test_op3(spark, folder):
    prints = {n: fingerprint(t) for n, t in texts(folder).items()}
    ids = sorted(prints)
    smallest = {n: n for n in ids}
    for _ in ids:  # until no link lowers a component
        before = dict(smallest)
        for n in ids:
            near = [m for m in ids if (prints[n] ^ prints[m]).bit_count() <= 2]
            smallest[n] = min(smallest[m] for m in near)
        if smallest == before:
            break
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op3_simhash(spark, folder).collect()}
    assert got == {n: (f"{prints[n]:016x}", smallest[n]) for n in ids}


def test_op4(spark, folder):
    vectors = {row[0]: row[1] for row in table(folder, "embeddings", "vec_id")}
    good = {n: np.array(v, float) for n, v in vectors.items()
            if v and None not in v and np.isfinite(v).all() and np.any(v)}
    asked = [n for n in good if n % 20 == 0]
    found = defaultdict(list)
    for r in queries.op4_tree_search(spark, folder).orderBy("query_id", "rank").collect():
        found[r.query_id].append(r)
    assert sorted(found) == sorted(asked)
    recalls = []
    for q, rows in found.items():
        scores = {n: float(np.dot(good[q], v)) for n, v in good.items() if n != q}
        best = sorted(scores, key=lambda n: (-scores[n], n))[:20]
        assert [r["rank"] for r in rows] == list(range(1, 21)) and q not in {r.vec_id for r in rows}
        assert all(math.isclose(r.score, scores[r.vec_id], rel_tol=1e-9, abs_tol=1e-12) for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        recalls.append(len({r.vec_id for r in rows} & set(best)) / 20)
    assert np.mean(recalls) >= 0.9


def test_op5(spark, folder, encoded):
    pieces, places = defaultdict(list), defaultdict(list)
    for r in queries.op5_packing(spark, folder).collect():
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(encoded)
    for doc_id, rows in pieces.items():
        ids, at = [*encoded[doc_id], 1], 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == checksum(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    for sequence in places.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(len(ids) + 1 for ids in encoded.values())
    filled = Counter({s: sum(n for _, n in rows) for s, rows in places.items()})
    padded = sum(0 if n & (n - 1) == 0 else 2048 - n for n in filled.values())
    assert padded <= 0.02 * total + 2048


def test_op8(spark, folder, encoded):
    expected, start = {}, 0
    for doc_id in sorted(encoded):
        ids = [*encoded[doc_id], 0]
        expected[doc_id] = (start, len(ids), checksum(ids))
        start += len(ids)
    got = queries.op8_token_files(spark, folder).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == expected and len(got) == len(expected)


def test_op9(spark, folder):
    first, expected = {}, {}
    for page_id, _, html in table(folder, "pages", "page_id"):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        there = first.setdefault(payload, page_id)
        kind = ("response", None) if there == page_id else ("revisit", there)
        expected[page_id] = (len(payload), digest, *kind)
    got = queries.op9_warc(spark, folder).collect()
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got}
    assert found == expected and len(got) == len(expected)
