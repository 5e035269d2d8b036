"""URL filters: rules for hosts and paths, and a weighted vocabulary searched by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


def lowered(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case: one strict hit rejects, so do ``least_soft`` distinct soft terms.

    A hit counts where no ASCII letter or digit touches it, so a term inside a word is none.
    """

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    least_soft: int = 2

    def __post_init__(self) -> None:
        terms = [*self.strict, *self.soft]
        if not all(terms) or len(set(terms)) != len(terms) or any(t != lowered(t) for t in terms):
            raise ValueError("terms are distinct, not empty and in lower case")
        if self.least_soft < 1:
            raise ValueError("least_soft is at least 1")


class Rule(NamedTuple):
    """``verdict`` for the host, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The default terms.
VOCABULARY = Vocabulary(
    strict=(
        "casino", "escort", "hentai", "malware", "phishing", "porn", "sexcam", "viagra", "warez", "xxx",
    ),
    soft=(
        "adult", "bet", "bonus", "cheap", "click", "crack", "dating", "deals", "discount", "farm", "free",
        "hot", "loan", "nude", "pharmacy", "pills", "poker", "replica", "sex", "slots", "spam", "torrent", "win",
    ),
)


def judge_urls(
    rows: DataFrame,
    rules: Sequence[Rule] = (),
    vocabulary: Vocabulary = VOCABULARY,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``key, host, path, rule, verdict, strict_hits, soft_hits, soft_terms`` for every row.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; the path what follows up to ``?``, ``#`` or the end.  The longest fitting rule
    gives the verdict (of rules equally long the one with the longer host, then the earlier
    one); without any, the vocabulary does, over the whole address with A-Z in lower case:
    ``block`` for one strict hit or ``least_soft`` distinct soft terms, else ``allow``.

    A null url, or one without ``://``, has an empty host and path and fits no rule; its text is
    searched all the same (null: empty).  Null and repeated keys are rows like others, other
    columns are ignored, an empty table gives no rows.  Every row is judged where it lies; the
    rules and terms, which are parameters and do not grow with the table, go to every task.
    """
    fields = rows.select(F.col(key)).schema.add("host", "string").add("path", "string").add("rule", "string")
    fields = fields.add("verdict", "string").add("strict_hits", "long").add("soft_hits", "long")
    fields = fields.add("soft_terms", "long")
    listed = by_host(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(vocabulary)
        for batch in batches:
            judged = [_judged(u, listed, search) for u in batch.column(1).to_pylist()]
            columns = list(zip(*judged, strict=True)) or [()] * 7
            kinds = [pa.string()] * 4 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], fields.fieldNames()
            )

    return rows.select(F.col(key), F.col(url).cast("string").alias("_url")).mapInArrow(run, fields)


def _judged(url: str | None, listed: dict, search: Search) -> tuple:
    host, path = host_and_path(url)
    rule = fitting_rule(host, path, listed)
    strict, soft, terms = search.hits(url or "")
    verdict = rule.verdict if rule else BLOCK if search.rejects(strict, terms) else ALLOW
    return host, path, rule and rule.name, verdict, strict, soft, terms


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host_end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    path_end = min((k for k in (rest.find(c, host_end) for c in "?#") if k >= 0), default=len(rest))
    return lowered(rest[:host_end]), rest[host_end:path_end]


def by_host(rules: Sequence[Rule]) -> dict[str, tuple[dict[str, Rule], list[int]]]:
    """The rules of each host by path, and the lengths of those paths, longest first."""
    found: dict[str, dict[str, Rule]] = {}
    for rule in rules:
        if not rule.host or rule.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"a rule has a host, and allows or blocks: {rule}")
        found.setdefault(lowered(rule.host), {}).setdefault(rule.path, rule)
    return {host: (paths, sorted({*map(len, paths)}, reverse=True)) for host, paths in found.items()}


def fitting_rule(host: str, path: str, listed: dict) -> Rule | None:
    """The longest rule for the host or a domain above it; a look-up per label and path length."""
    best: Rule | None = None
    while host:
        paths, lengths = listed.get(host, ({}, []))
        for length in lengths:
            rule = paths.get(path[:length]) if length <= len(path) else None
            if rule:
                if best is None or len(rule.name) > len(best.name):
                    best = rule
                break
        host = host.partition(".")[2]
    return best


class Search:
    """The automaton of a vocabulary; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.least_soft = vocabulary.least_soft
        self.automaton = ahocorasick.Automaton()
        for strict, terms in ((True, vocabulary.strict), (False, vocabulary.soft)):
            for term in terms:
                self.automaton.add_word(term, (term, strict))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, url: str) -> tuple[int, int, int]:
        """Strict hits, soft hits and distinct soft terms that stand alone in the text."""
        if not len(self.automaton):
            return 0, 0, 0
        text, strict_hits, soft_hits, terms = lowered(url), 0, 0, set()
        for end, (term, strict) in self.automaton.iter(text):
            if _joins(text[end + 1 : end + 2]) or (end >= len(term) and _joins(text[end - len(term)])):
                continue
            if strict:
                strict_hits += 1
            else:
                soft_hits += 1
                terms.add(term)
        return strict_hits, soft_hits, len(terms)

    def rejects(self, strict_hits: int, soft_terms: int) -> bool:
        return strict_hits > 0 or soft_terms >= self.least_soft


def _joins(char: str) -> bool:
    return char.isascii() and char.isalnum()


def url_sql(rules: Sequence[Rule], vocabulary: Vocabulary = VOCABULARY) -> str:
    """The same judgement of ``pages`` in SQL, a pattern per term."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def found(term: str) -> str:
        return f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"

    def count(term: str) -> str:  # a hit's right boundary may be the next hit's left one
        return f"len(list_filter(regexp_split_to_array(low, '[^a-z0-9]'), lambda w: w = '{term}'))"

    listed = ", ".join(f"({n}, '{r.host}', '{r.path}', '{r.verdict}')" for n, r in enumerate(rules))
    return f"""
WITH cut AS (
    SELECT page_id, translate(coalesce(url, ''), '{upper}', '{lower}') AS low,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), named AS (
    SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
    FROM cut
), rules AS (SELECT * FROM (VALUES {listed}) AS t(no, rule_host, rule_path, said)
), fitting AS (
    SELECT n, arg_max((rule_host || rule_path, said), (length(rule_host || rule_path), length(rule_host), -no)) AS best
    FROM named JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY n
), counted AS (
    SELECT *, {" + ".join(count(t) for t in vocabulary.strict)} AS strict_hits,
        {" + ".join(count(t) for t in vocabulary.soft)} AS soft_hits,
        {" + ".join(f"CAST({found(t)} AS INT)" for t in vocabulary.soft)} AS soft_terms
    FROM named
)
SELECT page_id, host, path, best[1] AS rule,
    coalesce(best[2], CASE WHEN strict_hits > 0 OR soft_terms >= {vocabulary.least_soft} THEN 'block' ELSE 'allow' END)
        AS verdict, CAST(strict_hits AS BIGINT) AS strict_hits, CAST(soft_hits AS BIGINT) AS soft_hits,
    CAST(soft_terms AS BIGINT) AS soft_terms
FROM counted LEFT JOIN fitting USING (n)"""
