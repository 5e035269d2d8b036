"""Near-duplicates by SimHash: fingerprints, candidate blocks, Hamming distance, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import connected
from tidemark.llm.exact import keep_rows, pair_key, text_sha
from tidemark.operators.lookup import fits_broadcast, key_side, lookup_join
from tidemark.session import staged

BITS = 64
SEED = 42
# Fingerprints in a block that are compared pair by pair; a larger block is split further.
PAIRED = 64
# Bytes of a text, and shingles, that are worked on at once.
PIECE = 1 << 20
# Bits of the fingerprints that near copies meet by, as words, and what makes their hashes of one hash.
WIDE = 1024
_SALTS = np.random.default_rng(SEED).integers(0, 1 << 63, WIDE // 64, np.uint64) * np.uint64(2) + np.uint64(1)
_LANES, _LANE_BITS = np.uint64(0x0101010101010101), np.arange(8, dtype=np.uint64)[:, None, None]
# Fingerprints that a task searches at once, the share of the near pairs among them that it finds,
# and the share of all near pairs that may be missed.
SLOT, LOCAL, MISSED = 1 << 17, 0.9, 1e-5
# Shingles up to which sets also meet those that have one shingle more.
TINY = 9
# Pairs of one node, or members of one clump, that a task compares in a row.
SLOT_PAIRS = 1024
# Levels of slack that a group of shared differences is split into at most, and bits of a set's sketch.
LEVELS, SKETCH = 16, 512
# Members that a clump's centre is made of (at most 255), and what rounding may add to a sum.
SAMPLED, EXACT = 31, 1e-6


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3
) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for every row.

    Words are what stands between ASCII white space, with A-Z lower-cased; a text with fewer
    words than a shingle is one shingle, a text without words (or null) has fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            fps = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def fingerprint(text: bytes, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    ones, count = np.zeros(BITS, np.int64), 0
    hash_of = xxhash.xxh64_intdigest
    for words in _word_runs(text, shingle):
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends + 1).tolist()]
        last = max(1, len(words) - shingle + 1)
        spans = zip(starts[:last], ends[-last:].tolist(), strict=True)
        hashes = np.array([hash_of(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        count += len(hashes)
    return int(sum(1 << int(k) for k in np.flatnonzero(2 * ones > count)))


def _word_runs(text: bytes, shingle: int) -> Iterator[list[bytes]]:
    """The words in runs of bounded size; a run begins with the last words of the one before."""
    kept: list[bytes] = []
    rest, at, any_run = b"", 0, False
    while at < len(text):
        piece = rest + text[at : at + PIECE].lower()
        at += PIECE
        words = piece.split()
        # A word that reaches the end of the piece may go on in the next one.
        if at < len(text) and words and not piece[-1:].isspace():
            rest = words.pop()
        else:
            rest = b""
        run = kept + words
        if len(run) >= shingle:
            yield run
            any_run = True
            kept = run[len(run) - shingle + 1 :] if shingle > 1 else []
        else:
            kept = run
    if kept and not any_run:
        yield kept


def linked_pairs(prints: DataFrame, distance: int = 2, blocks: int = 4) -> DataFrame:
    """Links ``a < b`` that join all fingerprints at ``distance`` or fewer differing bits.

    The bits are split into ``blocks``; close fingerprints share at least ``blocks - distance``
    of them, so they meet under one of the combinations of that many blocks, and the distance
    of those that meet is verified.  A block with more than ``PAIRED`` fingerprints is split
    by its other bits instead of being paired off: each fingerprint goes to every value within
    half the distance of its own, and two close fingerprints have such a value in common.  Few
    fingerprints lie so near one value, whatever the size of the block, so nothing is lost and
    no group is large.  (In such blocks links of the verified distance are enough that the same
    components result.)
    """
    width = BITS // blocks
    if BITS % blocks or not 0 <= distance < blocks:
        raise ValueError("blocks must divide 64 and be more than the distance")
    shared = list(combinations(range(blocks), blocks - distance))
    masks = [sum(((1 << width) - 1) << (width * b) for b in chosen) for chosen in shared]
    fp = F.col("fp")
    keys = F.array(
        *[F.struct(F.lit(k).alias("no"), fp.bitwiseAND(_long(m)).alias("part")) for k, m in enumerate(masks)]
    )
    keyed = prints.select("fp", F.inline(keys))
    sizes = keyed.groupBy("no", "part").agg(F.count("*").alias("n")).where("n > 1")
    met = staged(keyed.join(sizes, ["no", "part"]), "blocks")
    near = met.where(F.col("n") <= PAIRED)
    pairs = _pairs_in(near.groupBy("no", "part"), distance)
    crowded = met.where(F.col("n") > PAIRED)
    flips = F.element_at(F.lit(None).cast("array<array<long>>"), 1)
    for k, mask in reversed(list(enumerate(masks))):
        flips = F.when(F.col("no") == k, F.array(*_flips(mask, (distance + 1) // 2))).otherwise(flips)
    around = crowded.select("fp", "no", F.explode(flips).alias("flip")).select(
        "fp", "no", fp.bitwiseXOR(F.col("flip")).alias("value")
    )
    return pairs.unionAll(_pairs_in(around.groupBy("no", "value"), distance)).distinct()


def _pairs_in(groups, distance: int) -> DataFrame:
    found = groups.agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    one = found.select("fps", F.explode("fps").alias("a"))
    close = F.filter(
        "fps", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= distance)
    )
    return one.select("a", F.explode(close).alias("b"))


def _flips(mask: int, radius: int) -> list[Column]:
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [_long(sum(1 << b for b in bits)) for r in range(radius + 1) for bits in combinations(free, r)]


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << BITS) if bits >> (BITS - 1) else bits).cast("long")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 3,
    distance: int = 2,
    blocks: int = 4,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, n_links``.

    ``component_id`` is the smallest id reachable over links between fingerprints (equal ones
    are linked); ``n_links`` counts the other fingerprints linked directly in candidate blocks.
    Rows without an id take part, but give no component id; if a component has no other rows
    it is null.  Null and empty texts have no words, the fingerprint zero, and are linked like
    any others; repeated rows are rows of their own.  Whole texts are read, however long; other
    columns of ``docs`` are ignored; an empty table gives no rows.
    """
    rows = staged(fingerprints(docs, text, doc_id, shingle), "fingerprints")
    members = component_of(rows, distance, blocks)
    return rows.join(members, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "n_links",
    )


def component_of(rows: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``fp, component_id, n_links, root`` for every fingerprint of ``rows``."""
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    pairs = staged(linked_pairs(prints.select("fp"), distance, blocks), "pairs")
    ends = pairs.select("a").unionAll(pairs.select("b")).groupBy(F.col("a").alias("fp"))
    linked = (
        connected(pairs)
        .withColumnRenamed("node", "fp")
        .join(ends.agg(F.count("*").alias("n_links")), "fp")
    )
    placed = prints.join(linked, "fp", "left").select(
        "fp",
        "first_id",
        F.coalesce("root", "fp").alias("root"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return placed.join(least, "root").select("fp", "component_id", "n_links", "root")


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes; a text without words has one, of nothing."""
    hash_of = xxhash.xxh64_intdigest
    found: list[np.ndarray] = []
    for words in _word_runs(text, shingle):
        last = max(1, len(words) - shingle + 1)
        hashes = (hash_of(b" ".join(words[k : k + shingle]), SEED) for k in range(last))
        found.append(np.unique(np.fromiter(hashes, np.uint64, last)))
    if not found:
        return np.array([hash_of(b"", SEED)], np.uint64)
    return np.unique(np.concatenate(found))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """SimHash of a shingle set: a bit is 1 if it is set for over half; in each word one shingle settles draws."""
    ones = np.zeros((8, WIDE // 8), np.int64)
    for at in range(0, len(hashes), 255):
        words = _mixed(hashes[at : at + 255])
        if at == 0:
            # The least one in another word: least values have few bits themselves.
            settles = words[np.arange(len(words)), np.roll(words, 1, axis=0).argmin(axis=1)]
        # Each byte counts one bit of up to 255 words.
        ones += ((words >> _LANE_BITS) & _LANES).sum(axis=2, dtype=np.uint64).astype("<u8").view(np.uint8)
    draws = np.unpackbits(settles.astype("<u8").view(np.uint8), bitorder="little")
    twice = 2 * ones.T.ravel()
    return np.packbits((twice > len(hashes)) | ((twice == len(hashes)) & (draws == 1)), bitorder="little").tobytes()


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """``WIDE`` bits for each hash: a row per word, a column per hash."""
    x = hashes + _SALTS[:, None]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _one_less(hashes: np.ndarray) -> list[bytes]:
    """The digests of a tiny set without one of its shingles."""
    if not 1 < len(hashes) <= TINY:
        return []
    return [xxhash.xxh3_128_digest(np.delete(hashes, k).tobytes()) for k in range(len(hashes))]


def first_of_each_group(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents less near copies: of each component the row with the smallest id stays.

    Two texts are linked if the Jaccard similarity of their sets of shingles (words as in
    ``fingerprints``) is ``similarity`` or more; every link is counted on the sets, so texts less
    alike stay.  Of rows with the smallest id the one with the smallest digest stays; null ids
    are the largest here and only stay among themselves; texts without words (null, empty) are
    one group.  All columns are returned as they were; an empty table stays empty; whole texts
    are read, however long.

    Candidates are pairs with close fingerprints (``wide_fingerprint``, see ``_meetings``); the
    similarity decides among them.  64 bits are too few for this: at similarity 0.8 some 10 of them
    differ, with a deviation of 3, and blocks for such a radius have 3 or 4 bits, that is, hold
    everything.  Of 1,024 bits 155 differ, with a deviation of 12, against 512 of unlike texts.
    """
    hashed = docs.select(
        F.col("doc_id").cast("long"), text_sha(F.col("text")).alias("sha"), F.col("text").cast("binary")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = [shingle_set(t.as_py() or b"", shingle) for t in some.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *some.columns[:2],
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([wide_fingerprint(s) for s in sets], pa.binary()),
                        pa.array([_one_less(s) for s in sets], pa.list_(pa.binary())),
                    ],
                    ["doc_id", "sha", "same", "print", "less"],
                )

    schema = "doc_id long, sha binary, same binary, print binary, less array<binary>"
    rows = staged(
        hashed.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "shingles"
    )
    # Rows with equal sets are one node.
    nodes = staged(rows.groupBy("same").agg(F.min("row").alias("node")), "nodes")
    first = key_side(nodes.select("node"))
    heads = rows.join(first, rows["row"] == first["node"], "left_semi")
    heads = heads.select(F.col("row").alias("node"), "sha", "same", "print", "less")
    links = staged(_similar_pairs(docs, heads, shingle, similarity), "links")
    roots = connected(links).withColumnRenamed("root", "found")
    placed = nodes.join(key_side(roots), "node", "left").select("same", F.coalesce("found", "node").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha")
    found = staged(rows.select("doc_id", "sha", "same").join(placed, "same"), "placed")
    stay = found.groupBy("root").agg(F.min(order).alias("first"))
    judged = found.join(stay, "root").select(
        F.col("doc_id"), F.col("sha"), (order == F.col("first")).alias("kept")
    )
    return keep_rows(docs, judged.select(pair_key(F.col("doc_id"), F.col("sha")).alias("key"), "kept"))


def _similar_pairs(docs: DataFrame, heads: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links ``a, b`` that join the same nodes as all similar pairs that ``_meetings`` joins.

    Nodes that meet form clumps, and a clump is described by what its sets differ from a
    common centre in.  With E(x) = set(x) without the centre, plus the centre without set(x), two
    sets are similar if and only if slack(x) + slack(y) <= 2 |E(x) and E(y)|, where slack(x) =
    |E(x)| - f |set(x)| and f = (1 - similarity) / (1 + similarity); that holds for every centre.

    So all nodes whose slack and the clump's least add up to no more than 0 are linked to the
    node with the least.  Only the others, heavy ones, can have further links, and those need
    common differences: heavy nodes meet others under the rarest of their differences (as many as
    such a link cannot do without), first the node of least slack there, afterwards only nodes of
    other components.  A large group of copies of one text thus costs a row or two a copy, and
    copies too far from each other do not meet at all.
    """
    meets = staged(_meetings(heads, similarity), "meets")
    clumps = connected(meets).select("node", F.col("root").alias("clump"))
    members = staged(heads.select("node", "sha").join(key_side(clumps), "node"), "members")
    rows = _differences(members, docs, shingle, (1 - similarity) / (1 + similarity))
    least = rows.groupBy("clump").agg(F.min(F.struct("slack", "node")).alias("least"))
    compared = staged(lookup_join(rows.drop("sketch"), staged(least, "least"), ["clump"], "inner", [F.col("node")]), "slacks")
    heavy = F.col("slack") + F.col("least.slack") > EXACT
    light = compared.where(~heavy & (F.col("node") != F.col("least.node")))
    direct = light.select(F.col("least.node").alias("a"), F.col("node").alias("b"))
    lightest = staged(compared.where(heavy).groupBy("clump").agg(F.min("slack").alias("heavy_slack")), "heavy")
    mixed = lookup_join(compared, lightest, ["clump"], "inner", [F.col("node")])
    # Common differences that any further link of the node needs.
    other = F.when(heavy, F.col("least.slack")).otherwise(F.col("heavy_slack"))
    need = F.greatest(F.ceil((F.col("slack") + other) / 2 - F.lit(EXACT)), F.lit(1)).cast("int")
    prefix = F.greatest(F.size("edits") - need + 1, F.lit(0))
    posted = mixed.select(
        "clump", "node", "slack", heavy.alias("heavy"), F.size("edits").alias("n_edits"),
        F.posexplode(F.slice("edits", F.lit(1), prefix)).alias("at", "token"),
    )
    posted = staged(posted.withColumn("left", F.col("n_edits") - F.col("at")).drop("n_edits", "at"), "posted")
    key = ["clump", "token"]
    shared = posted.groupBy(*key).agg(
        F.count("*").alias("n"), F.bool_or("heavy").alias("any"), F.min(F.struct("slack", "node", "left", "heavy")).alias("first")
    )
    shared = key_side(shared.where("n > 1 and any").drop("any"), fits_broadcast(posted))
    met = staged(posted.join(shared, key), "met")
    rest = met.where(F.col("node") != F.col("first.node"))
    stars = rest.where(_can_link(F.struct("slack", "left", "heavy"), F.col("first")))
    stars = _pair(F.col("first.node"), F.col("node"), stars)
    near = staged(direct.unionAll(_verified(stars, rows)), "near")
    # Pairs within a component, and those with the first, need no further comparison.
    others = rest.where("n > 2").join(key_side(connected(near)), "node", "left").withColumn("root", F.coalesce("root", "node"))
    others = staged(others.select(*key, "node", "slack", "left", "heavy", "root"), "others")
    for _ in range(2):  # What goes in the first round no longer keeps others in the second.
        others = staged(_reaching(others, key), "reaching")
    sketches = rows.select("node", "sketch", (F.size("edits") - F.col("slack")).alias("spare"))
    apart = key_side(others).join(sketches, "node")
    pairs = _pairs_apart(staged(apart, "apart"), key)
    return near.unionAll(_verified(pairs, rows))


def _reach() -> Column:
    """The most slack that a row can be similar to under its token."""
    return 2 * F.col("left") - F.col("slack") + F.lit(EXACT)


def _reaching(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of groups with several components, less those that can link to nothing in their group.

    Heavy rows are held against the extremes of their group, light ones against those of its heavy rows.
    """
    least, most, heavy = F.min("slack"), F.max(_reach()), F.col("heavy")
    ends = rows.groupBy(*key).agg(
        F.count("*").alias("n"), least.alias("low"), F.max("slack").alias("top"), most.alias("high"),
        F.min(F.when(heavy, F.col("slack"))).alias("heavy_low"), F.max(F.when(heavy, _reach())).alias("heavy_high"),
        F.min("root").alias("lo"), F.max("root").alias("hi"),
    )
    held = rows.drop("n", "low", "top").join(ends.where("lo < hi").drop("lo", "hi"), key)
    low, high = F.when(heavy, F.col("low")).otherwise(F.col("heavy_low")), F.when(heavy, F.col("high")).otherwise(F.col("heavy_high"))
    return held.where((_reach() >= low) & (F.col("slack") <= high)).select(*rows.drop("n", "low", "top").columns, "n", "low", "top")


def _pairs_apart(rows: DataFrame, key: list[str]) -> DataFrame:
    """``a, b``: pairs of a group, of different components, that can be similar by slacks and sketches.

    Groups are dealt over blocks of about ``PAIRED`` rows of similar slack; a component of more rows
    in a group has blocks of its own.  A row is sent to the blocks only whose extremes it can link to,
    so a group of rows that cannot link costs a row each, and only pairs that can be similar get a row.
    """
    alone = rows.groupBy(*key, "root").agg(F.count("*").alias("same")).where(F.col("same") > PAIRED)
    placed = rows.join(alone, [*key, "root"], "left")
    levels = F.least(F.ceil(F.col("n") / F.lit(PAIRED)), F.lit(LEVELS))
    level = F.floor(levels * (F.col("slack") - F.col("low")) / F.greatest(F.col("top") - F.col("low"), F.lit(1.0)))
    kind = [*key, "alone", "level"]
    placed = placed.select(
        *key, "node", "slack", "left", "heavy", "root", "spare", "sketch", level.alias("level"),
        F.when(F.col("same").isNotNull(), F.col("root")).otherwise(F.lit(-1)).alias("alone"),
    )
    blocks = placed.groupBy(*kind).agg(F.ceil(F.count("*") / F.lit(PAIRED)).cast("long").alias("blocks"))
    placed = placed.join(blocks, kind)
    name = F.xxhash64("alone", "level", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = staged(placed.withColumn("block", name).drop("alone", "level", "blocks"), "blocks")
    items = F.collect_list(F.struct("node", "slack", "left", "heavy", "root", "spare", "sketch"))
    ends = staged(placed.groupBy(*key, "block").agg(
        F.min("slack").alias("low"), F.max(_reach()).alias("high"), F.bool_or("heavy").alias("any"),
        F.min("root").alias("lo"), F.max("root").alias("hi"),
    ), "ends")
    others = ends.select(*key, *[F.col(c).alias(f"other_{c}") for c in ("block", "low", "high", "any", "lo", "hi")])
    cells = ends.join(others, key).where(
        (F.col("block") <= F.col("other_block")) & (F.col("any") | F.col("other_any"))
        & (F.col("high") >= F.col("other_low")) & (F.col("low") <= F.col("other_high"))
        & ~((F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("other_lo")) & (F.col("hi") == F.col("other_hi")))
    ).drop("low", "high", "any", "lo", "hi")
    sent = placed.join(cells, [*key, "block"]).where(
        (F.col("heavy") | F.col("other_any")) & (_reach() >= F.col("other_low")) & (F.col("slack") <= F.col("other_high"))
        & ~((F.col("root") == F.col("other_lo")) & (F.col("root") == F.col("other_hi")))
    )
    x = F.struct("node", "slack", "left", "heavy", "root", "spare", "sketch")
    one = sent.select(*key, F.col("other_block").alias("block"), x.alias("x"))
    met = one.join(placed.groupBy(*key, "block").agg(items.alias("all")), [*key, "block"])
    x = F.col("x")

    def joins(y: Column) -> Column:
        return (x["root"] != y["root"]) & _can_link(x, y) & _may_be_similar(x, y)

    found = met.select(x["node"].alias("one"), F.explode(F.filter("all", joins)["node"]).alias("other"))
    return _pair(F.col("one"), F.col("other"), found)


def _may_be_similar(one: Column, other: Column) -> Column:
    """Whether the sketches allow it: they differ in no more bits than the sets in shingles."""
    apart = [F.bit_count(one["sketch"][k].bitwiseXOR(other["sketch"][k])) for k in range(SKETCH // 64)]
    return sum(apart[1:], apart[0]) <= one["spare"] + other["spare"] + F.lit(EXACT)


def _meetings(heads: DataFrame, similarity: float) -> DataFrame:
    """Pairs that join all nodes with fingerprints as close as those of texts of ``similarity`` are.

    At similarity s two bits agree with 1 - acos(2s / (1 + s)) / pi (the least, for sets of one size).
    Every fingerprint is sent to several groups, to the slot that some of its bits name there (none
    of them for up to ``SLOT`` nodes); a slot is searched by blocks of further bits (``_close``).
    The numbers of groups and blocks follow from ``MISSED``, the bits of a block from the rows, so
    that few unlike texts share one.  A slot that is far too large is dealt over parts, and every
    two parts meet in a cell.  Half a bit in eight is a coarse measure of a few shingles, so sets of
    up to ``TINY`` also meet those with exactly one shingle more.
    """
    agree = min(1 - math.acos(min(2 * similarity / (1 + similarity), 1)) / math.pi, 0.999)
    radius = int(WIDE * (1 - agree) + 5.5 * math.sqrt(WIDE * agree * (1 - agree)))
    rows = max(heads.count(), 1)
    prefix = max(0, math.ceil(math.log2(rows / SLOT)))
    bits = max(8, math.ceil(math.log2(rows)) - prefix + 6)
    blocks = math.ceil(math.log(1 - LOCAL) / math.log1p(-(agree**bits)))
    groups = math.ceil(math.log(MISSED) / math.log1p(-LOCAL * agree**prefix))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(batch.column(1).to_pylist())
            named = [_keys(words, _bit_order(g)[:prefix]) for g in range(groups)]
            slots = pa.array(np.array(named, np.int64).T.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, slots], ["node", "print", "slots"])

    schema = "node long, print binary, slots array<long>"
    prints = staged(heads.select("node", "print").mapInArrow(sent, schema), "prints")
    key = ["group", "slot"]
    crowded = prints.select(F.posexplode("slots").alias(*key)).groupBy(*key).agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / F.lit(4 * SLOT)).cast("long").alias("parts")
    crowded = staged(crowded.where(F.col("n") > 4 * SLOT).select(*key, parts), "crowded")
    dealt = prints.select("node", "print", F.posexplode("slots").alias(*key))
    dealt = lookup_join(dealt, crowded, key, "left", [F.col("node")])
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    dealt = dealt.select(
        *key, "node", "print", F.pmod(F.xxhash64("node"), parts).alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"),
    )
    cell = [*key, "lo", "hi"]
    cells = dealt.select(*key, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "print")
    cells = cells.repartition(*cell).sortWithinPartitions(*cell)
    close = cells.mapInArrow(lambda b: _close(b, prefix, bits, blocks, radius), "a long, b long")
    whole = heads.select(F.col("node").alias("other"), F.col("same").alias("key"))
    more = heads.select("node", F.explode("less").alias("key")).join(whole, "key")
    return close.unionAll(more.select(F.least("node", "other"), F.greatest("node", "other"))).distinct()


def _bit_order(group: int) -> np.ndarray:
    return np.random.default_rng((SEED, group)).permutation(WIDE)


def _words(prints: list[bytes]) -> np.ndarray:
    """Fingerprints as columns of words."""
    return np.ascontiguousarray(np.frombuffer(b"".join(prints), "<u8").reshape(-1, WIDE // 64).T)


def _keys(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    keys = np.zeros(words.shape[1], np.uint64)
    for bit in bits.tolist():
        keys = (keys << np.uint64(1)) | ((words[bit // 64] >> np.uint64(bit % 64)) & np.uint64(1))
    return keys


def _close(
    batches: Iterator[pa.RecordBatch], prefix: int, bits: int, blocks: int, radius: int
) -> Iterator[pa.RecordBatch]:
    """Links in each cell; its rows come one after the other."""
    cell, nodes, prints = None, [], []

    def found() -> pa.RecordBatch:
        order = _bit_order(cell[0])[prefix:]
        a, b = close_pairs(_words(prints), order, bits, blocks, radius)
        ids = np.array(nodes, np.int64)
        least, greatest = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
        return pa.RecordBatch.from_arrays([pa.array(least), pa.array(greatest)], ["a", "b"])

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("group", "slot", "lo", "hi", "node", "print")]
        for *key, node, print_ in zip(*columns, strict=True):
            if key != cell:
                if len(nodes) > 1:
                    yield found()
                cell, nodes, prints = key, [], []
            nodes.append(node)
            prints.append(print_)
    if len(nodes) > 1:
        yield found()


def close_pairs(
    words: np.ndarray, order: np.ndarray, bits: int, blocks: int, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints at ``radius`` or fewer differing bits that share a block.

    In each block the first one left is compared with the others.  Those within the radius need
    no further comparison there, as what is close to them is within two radii of the first, and all
    those are linked.  So a block costs its rows times the unlike texts in it, not its pairs.
    """
    chooser, root = np.random.default_rng(order), np.arange(words.shape[1])
    links = [(np.zeros(0, np.int64),) * 2]
    for _ in range(blocks):
        keys = _keys(words, chooser.choice(order, bits, replace=False))
        left = np.argsort(keys)
        runs = keys[left]
        while len(left):
            again = runs[1:] == runs[:-1]
            shared = np.append(again, False) | np.append(False, again)
            left, runs = left[shared], runs[shared]
            if not len(left):
                break
            first = np.append(True, runs[1:] != runs[:-1])
            pivots = left[first][np.cumsum(first) - 1]
            apart = np.bitwise_count(words[:, pivots] ^ words[:, left]).sum(axis=0, dtype=np.int64)
            links.append(_joined(root, pivots[apart <= 2 * radius], left[apart <= 2 * radius]))
            left, runs = left[apart > radius], runs[apart > radius]
    return tuple(np.concatenate(ends) for ends in zip(*links, strict=True))


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links between different trees of ``root``, which it joins."""
    new = root[a] != root[b]
    a, b = links = a[new], b[new]
    while len(a):
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (root[root] != root).any():
            root[:] = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return links


def _pair(one: Column, other: Column, rows: DataFrame) -> DataFrame:
    return rows.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()


def _can_link(one: Column, other: Column) -> Column:
    """Whether enough differences are left from here on, and it is not settled by the slacks."""
    enough = 2 * F.least(one["left"], other["left"]) >= one["slack"] + other["slack"] - F.lit(EXACT)
    return enough & (one["heavy"] | other["heavy"])


def _differences(members: DataFrame, docs: DataFrame, shingle: int, factor: float) -> DataFrame:
    """``node, clump, slack, edits, sketch``: what each set differs from its clump's centre in, rarest first.

    The centre holds what most of up to ``SAMPLED`` members have, chosen by a hash; shingles that
    several of these have count as frequent.  The choice decides how fast links are found, not
    which.  A clump is dealt over slots, each with the centre before its members.  A sketch has a bit
    for each remainder of the shingles' hashes, set if an odd number of them have it.
    """
    sets = _sets_of(members, docs, shingle)
    order = Window.partitionBy("clump").orderBy(F.xxhash64("node"), "node")
    chosen = members.select("clump", "node", F.row_number().over(order).alias("n")).where(F.col("n") <= SAMPLED)
    few = fits_broadcast(members.select("node"))
    sample = sets.join(key_side(chosen.select("node"), few), "node", "left_semi")
    centres = sample.repartition("clump").sortWithinPartitions("clump").mapInArrow(
        _centres, "clump long, tokens binary, counts binary, sampled int"
    )
    slots = members.groupBy("clump").agg(F.ceil(F.count("*") / F.lit(SLOT_PAIRS)).cast("long").alias("slots"))
    named = staged(centres.join(key_side(slots, few), "clump"), "centres")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))
    heads = named.select("clump", every.alias("slot"), F.lit(None).cast("long").alias("node"), "tokens", "counts", "sampled")
    counts = named.select("clump", "slots")
    dealt = lookup_join(sets, staged(counts, "slots"), ["clump"], "inner", [F.col("node")]).select(
        "clump",
        F.pmod(F.xxhash64("node"), F.col("slots")).alias("slot"),
        "node",
        F.col("hashes").alias("tokens"),
        F.lit(None).cast("binary").alias("counts"),
        F.lit(0).alias("sampled"),
    )
    both = heads.unionByName(dealt).repartition("clump", "slot").sortWithinPartitions("clump", "slot", "node")
    schema = "node long, clump long, slack double, edits array<long>, sketch array<long>"
    return staged(both.mapInArrow(lambda b: _edits(b, factor), schema), "edits")


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that at least two of a clump's sampled sets have, and how many have them."""
    clump, held = None, []
    for batch in batches:
        for name, value in zip(batch.column("clump").to_pylist(), batch.column("hashes"), strict=True):
            if held and name != clump:
                yield _centre(clump, held)
                held = []
            clump = name
            held.append(np.frombuffer(value.as_py(), np.uint64))
    if held:
        yield _centre(clump, held)


def _centre(clump: int, held: list[np.ndarray]) -> pa.RecordBatch:
    tokens, counts = np.unique(np.concatenate(held), return_counts=True)
    known = counts > 1
    return pa.RecordBatch.from_pydict(
        {
            "clump": pa.array([clump], pa.int64()),
            "tokens": pa.array([tokens[known].tobytes()], pa.binary()),
            "counts": pa.array([counts[known].astype(np.uint8).tobytes()], pa.binary()),
            "sampled": pa.array([len(held)], pa.int32()),
        }
    )


def _edits(batches: Iterator[pa.RecordBatch], factor: float) -> Iterator[pa.RecordBatch]:
    known, counts, centre = (np.zeros(0, np.uint64),) * 3
    for batch in batches:
        nodes, clumps, slacks, edits, sketches = [], [], [], [], []
        columns = (batch.column(name) for name in ("clump", "node", "tokens", "counts", "sampled"))
        for clump, node, tokens, seen, sampled in zip(*columns, strict=True):
            this = np.frombuffer(tokens.as_py(), np.uint64)
            if not node.is_valid:
                known, counts = this, np.frombuffer(seen.as_py(), np.uint8)
                centre = known[2 * counts.astype(np.int64) > sampled.as_py()]
                continue
            changed = np.setxor1d(this, centre, assume_unique=True)
            at = np.minimum(np.searchsorted(known, changed), max(len(known) - 1, 0))
            often = np.where(known[at] == changed, counts[at], 0) if len(known) else np.zeros(len(changed))
            nodes.append(node.as_py())
            clumps.append(clump.as_py())
            slacks.append(len(changed) - factor * len(this))
            edits.append(changed[np.lexsort((changed, often))].view(np.int64))
            sketches.append(sketch(this))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes, pa.int64()), pa.array(clumps, pa.int64()), pa.array(slacks, pa.float64()),
                pa.array(edits, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
            ],
            ["node", "clump", "slack", "edits", "sketch"],
        )


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The odd remainders of a set's hashes, as words."""
    odd = np.bincount((hashes % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").astype(np.int64)


def _sets_of(members: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """``node, clump, hashes``: the shingle sets of ``members``, read from their texts."""
    texts = docs.select(text_sha(F.col("text")).alias("sha"), F.col("text").cast("binary").alias("text"))
    wanted = lookup_join(texts, members, ["sha"], "inner", [F.monotonically_increasing_id()], wide=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = [shingle_set(t.as_py() or b"", shingle).tobytes() for t in some.column(2)]
                yield pa.RecordBatch.from_arrays([*some.columns[:2], pa.array(sets, pa.binary())], ["node", "clump", "hashes"])

    found = wanted.select("node", "clump", "text").mapInArrow(run, "node long, clump long, hashes binary")
    # Rows with one text are one node.
    return staged(found.groupBy("node", "clump").agg(F.first("hashes").alias("hashes")), "sets")


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs that are similar by their differences; a node in many pairs is dealt over slots."""
    pairs = staged(pairs, "candidates")
    few = fits_broadcast(pairs)
    slots = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(SLOT_PAIRS)).cast("long").alias("slots"))
    asked = staged(
        pairs.join(key_side(slots, few), "a").select("a", F.pmod(F.xxhash64("b"), F.col("slots")).alias("slot"), "b"),
        "asked",
    )
    known = rows.select(F.col("node").alias("b"), "slack", "edits")
    own = key_side(asked.select("a", "slot").distinct().withColumn("b", F.col("a")), few).join(known, "b")
    both = own.unionByName(key_side(asked, few).join(known, "b"))
    # A node has a smaller number than those it is compared with, so its own row comes first.
    dealt = both.select("a", "slot", "b", "slack", "edits").repartition("a", "slot").sortWithinPartitions("a", "slot", "b")
    return dealt.mapInArrow(_compared, "a long, b long")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own, own_slack = np.zeros(0, np.int64), 0.0
    for batch in batches:
        found: list[tuple[int, int]] = []
        columns = (batch.column(name) for name in ("a", "b", "slack", "edits"))
        for a, b, slack, edits in zip(*columns, strict=True):
            a, b, slack = a.as_py(), b.as_py(), slack.as_py()
            this = np.sort(edits.values.to_numpy())
            if a == b:
                own, own_slack = this, slack
                continue
            both = len(np.intersect1d(own, this, assume_unique=True))
            if own_slack + slack <= 2 * both + EXACT:
                found.append((a, b))
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
