"""Filter interactions, URL filters and periodic runs against plain versions on awkward rows."""

import hashlib
import random
from fractions import Fraction
from itertools import permutations

import duckdb
import pandas as pd
import pytest

from tidemark.llm import audit, periods, queries, urls

DOCS = "doc_id long, text string, lang string, row string, part string, sha string, failed string, id string"
EXTRA = ("x",) * 5
GOOD_TEXT = " ".join(f"w{i}" for i in range(120))
DULL_TEXT = " ".join(f"w{i % 30}" for i in range(120))


def brute_audit(docs, labels):
    """Every order applied to every document, one filter after the other."""
    words = [[w for w in (t or "").replace("\t", " ").split(" ") if w] for _, t, _ in docs]
    failing = {"A": set(), "B": set(), "C": set(), "D": set(), "E": set()}
    for n, (i, text, _) in enumerate(docs):
        text, w = text or "", words[n]
        if len(w) < 100:
            failing["A"].add(n)
        if 100 * len(set(w)) < 80 * len(w):
            failing["B"].add(n)
        if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text):
            failing["C"].add(n)
        if set(text) & set("#$%&*|"):
            failing["D"].add(n)
        if i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in docs):
            failing["E"].add(n)
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    rows = []
    for part in {p or "" for _, _, p in docs}:
        members = [n for n, (_, _, p) in enumerate(docs) if (p or "") == part]
        shapley = dict.fromkeys(failing, 0)
        some = []
        for order in map("".join, permutations("ABCDE")):
            left = set(members)
            for step, letter in enumerate(order, 1):
                mine = failing[letter] & set(members)
                gone = left & mine
                others = set().union(*(failing[x] for x in failing if x != letter))
                left = left - gone
                shapley[letter] += len(gone)
                some.append([
                    part, order, step, len(left), len(gone), len(mine - gone), len(mine - others),
                    sum(docs[n][0] in good for n in gone), sum(docs[n][0] in toxic for n in gone), letter,
                ])
        rows += [(*r[:-1], shapley[r[-1]]) for r in some]
    return sorted(rows)


def test_filter_interactions(spark):
    docs = [
        (1, GOOD_TEXT, "en"), (2, GOOD_TEXT, "de"), (3, GOOD_TEXT + " $", "en"), (4, DULL_TEXT, "en"), (5, None, None),
        (6, "", "en"), (7, "AB  c\td", ""), (None, GOOD_TEXT, "en"), (2, GOOD_TEXT, "de"), (8, DULL_TEXT.upper(), "de"),
        (9, GOOD_TEXT * 300, "fr"), (10, "x | y", "de"), (10, "x | y", "de"), (11, "x | y", "de"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (4, 1, None), (None, 1, 1), (10, 0, 1), (10, 0, 1), (99, 1, 1), (5, 1, 0)]
    rows = spark.createDataFrame([(*d, *EXTRA) for d in docs], DOCS)
    marked = spark.createDataFrame([(*m, "x") for m in labels], "doc_id long, quality int, toxic int, id string")
    facts = audit.document_facts(rows, marked)
    found = audit.filter_interactions(facts, audit.failing_ids(facts))
    expected = brute_audit(docs, labels)
    assert sorted(tuple(r) for r in found.collect()) == expected
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    assert sorted(con.execute(audit.AUDIT_SQL).fetchall()) == expected


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    unmarked = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    facts = audit.document_facts(none, unmarked)
    assert audit.filter_interactions(facts, audit.failing_ids(facts)).collect() == []
    with pytest.raises(ValueError):
        audit.filter_interactions(facts, {})


def test_other_filters_by_id_tables(spark):
    """Stored id tables of any filters: repeated ids and ids of no row do nothing."""
    members = spark.range(10).selectExpr("id AS row", "'p' AS part", "id = 1 AS good", "id = 2 AS toxic")
    failing = {"X": spark.createDataFrame([(1,), (1,), (2,), (77,)], "row long"), "Y": spark.range(2, 5).toDF("row")}
    got = {(r.filter_order, r.step): r for r in audit.filter_interactions(members, failing).collect()}
    assert [(got[k].kept, got[k].removed, got[k].redundant) for k in [("XY", 1), ("XY", 2), ("YX", 1), ("YX", 2)]] == [
        (8, 2, 0), (6, 2, 1), (7, 3, 0), (6, 1, 1),
    ]
    assert got["XY", 1].shapley == 3 and got["YX", 2].unique_fails == 1 and got["XY", 1].toxic_lost == 1


URLS = [
    None, "", "x", "http://", "http://A.Example.COM/de/x?y#z", "http://example.com/De/", "https://a.net", "a://b.net/q",
    "https://Example.net/en/1", "https://sub.example.net/en?x", "https://notexample.net/en/1", "http://x.org/fr/#a/b",
    "http://xorg/fr/", "http://org/fr/://", "q://h?p/x", "http://h#f?/x", "http://spam-farm.de/", "http://spamfarm.de/",
    "http://XXX.de/", "http://cheap.de/cheap/cheap", "http://a.de/cheap_pills", "http://é.de/xxx", "http://u@h.net:80/a",
    "free" * 20_000 + " win free", "http://h.net./x", "http://.net/",
]


def test_urls(spark):
    rows = spark.createDataFrame([(n // 2 or None, u, "x", "x", "x") for n, u in enumerate(URLS)], "page_id long, url string, host string, _url string, rule string")
    got = urls.judge_urls(rows, queries.URL_RULES)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [(n // 2 or None, u) for n, u in enumerate(URLS)])
    expected = con.execute(urls.url_sql(queries.URL_RULES)).fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    assert urls.judge_urls(rows.limit(0), queries.URL_RULES).count() == 0


@pytest.mark.parametrize(
    "url, rule, verdict",
    [
        ("http://a.net/", "net/", "block"), ("http://a.net", None, "allow"),
        ("http://m.example.net/en/x", "example.net/en/", "allow"), ("http://example.net/enx", "net/", "block"),
        ("http://b.example.com/de/1", "example.com/de/", "block"), ("http://a.org/fr/xxx", "org/fr/", "allow"),
        ("http://a.org/xxx", None, "block"), ("http://spam-farm.org/", None, "block"), ("http://spam-spam.org/", None, "allow"),
    ],
)
def test_url_verdicts(url, rule, verdict):
    found = urls._judged(url, urls.by_host(queries.URL_RULES), urls.Search(urls.VOCABULARY))
    assert found[2:4] == (rule, verdict)


def test_vocabularies_are_checked():
    with pytest.raises(ValueError):
        urls.Vocabulary(("A",), ())
    with pytest.raises(ValueError):
        urls.Vocabulary(("a",), ("a",))
    assert urls.Search(urls.Vocabulary((), ())).hits("porn") == (0, 0, 0)
    equal = [urls.Rule("b.c", "/x/", "allow"), urls.Rule("c", "/x/yy", "block")]
    assert urls.fitting_rule("a.b.c", "/x/yy/", urls.by_host(equal)).host == "b.c"


def brute_runs(words, least=24, repeats=3):
    found = set()
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            end = j + q
            if end - i >= max(least, repeats * q) and j > i:
                if not any(all(words[k] == words[k + r] for k in range(i, end - r)) for r in range(1, q)):
                    found.add((i, end - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_texts(rng, count, most):
    for _ in range(count):
        alphabet = rng.choice([1, 2, 3, 6, 60])
        words = [b"w%d" % rng.randrange(alphabet) for _ in range(rng.randrange(most))]
        for _ in range(rng.randrange(4) if words else 0):
            at, period = rng.randrange(len(words)), 1 + rng.randrange(1 + len(words) // 3)
            base = words[at : at + period]
            for i in range(min(len(words) - at, period * rng.randrange(1, 6) + rng.randrange(period + 1))):
                words[at + i] = base[i % len(base)]
        yield words


@pytest.mark.parametrize("largest, direct", [(4096, 128), (16, 16), (32, 8)])
def test_runs_equal_a_plain_search(monkeypatch, largest, direct):
    monkeypatch.setattr(periods, "LARGEST", largest)
    monkeypatch.setattr(periods, "DIRECT", direct)
    periods._transform.cache_clear()
    rng = random.Random(largest)
    for _ in range(40):
        texts = list(planted_texts(rng, 4, 320))
        assert periods.runs_of(texts) == [brute_runs(words) for words in texts]
    periods._transform.cache_clear()


def test_transforms_multiply():
    rng = random.Random(5)
    for size in (8, 64, 128, 512, 4096):
        turn = periods.Transform(size)
        a, b = ([float(rng.randrange(periods.PRIME)) for _ in range(2 * size)] for _ in range(2))
        import numpy as np

        block, window = np.array([a[:size]]), np.array(b).reshape(2, size)
        seen, near = turn.forward(block), turn.forward(window)
        product = periods._modulo(seen[:, turn.negative] * periods._modulo(near[:1] + turn.sign * near[1:]) )
        got = turn.inverse(product)[0]
        whole = [int(x) for x in b]
        for lag in (0, 1, size // 2, size - 1):
            assert got[lag] == sum(int(x) * whole[lag + k] for k, x in enumerate(a[:size])) % periods.PRIME


def test_long_texts():
    rng = random.Random(3)
    words = [b"%d" % rng.randrange(400) for _ in range(40_000)]
    base = words[123 : 123 + 9001]
    for i in range(len(words) - 123):
        words[123 + i] = base[i % 9001]
    assert periods.runs_of([words, [b"x"] * 100_000]) == [[(123, 39_877, 9001)], [(0, 100_000, 1)]]


def plain_digests(doc_id, text):
    words = queries.repeating(doc_id, (text or "").encode().split())
    runs = brute_runs(words)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    top = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
        sha(b"".join(b"%d,%d,%d\n" % r for r in runs)), sha(b" ".join(w for k, w in enumerate(words) if k not in drop)),
    )


def test_run_query(spark, tmp_path):
    rng = random.Random(11)
    texts = [b" ".join(w).decode() for w in planted_texts(rng, 120, 200)]
    texts += [None, "", " \t\n", "é " * 30, "中文 x" * 40, "a\u00a0b " * 9 + "\x0b\x0cz", "a " * 24, "a " * 23]
    rows = [(n, t, "x", "x") for n, t in enumerate(texts)] + [(None, "b " * 40, "x", "x"), (3, "c d " * 20, "x", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_digests(i, t)) for i, t, *_ in rows)
    assert sum(r.n_runs > 0 for r in got) > 20
    assert periods.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, least=10)
