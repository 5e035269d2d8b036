"""Joins of a large table to a smaller one, safe when one key holds most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
MAX_SALTS = 256
# Bits of a block of a sieve of keys, and its blocks at most (32 MB).
BLOCK_BITS, SIEVE_BLOCKS = 32_768, 8192


def salts_of(spark: SparkSession) -> int:
    """As many salts as a quarter of the shuffle's partitions, so that a hot key uses the cluster."""
    return max(16, min(MAX_SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4))


def fits_broadcast(table: DataFrame) -> bool:
    """Count rows and bytes of ``table`` (one distributed aggregate, one row back)."""
    width = F.lit(16 * len(table.columns)).cast("long")
    for field in table.schema.fields:
        own = _extra_bytes(F.col(f"`{field.name}`"), field.dataType)
        if own is not None:
            width = width + F.coalesce(own.cast("long"), F.lit(0))
    size = table.agg(F.count("*").alias("rows"), F.sum(width).alias("bytes")).first()
    return size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES


def _extra_bytes(column: Column, kind: DataType) -> Column | None:
    """Bytes of a value beyond a fixed width: of texts, binaries, lists, maps and structures."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.octet_length(column)
    if isinstance(kind, ArrayType):
        inner = _extra_bytes(F.lit(None).cast(kind.elementType), kind.elementType)
        if inner is None:
            return F.greatest(F.size(column), F.lit(0)) * 16
        each = F.transform(column, lambda x: 16 + F.coalesce(_extra_bytes(x, kind.elementType).cast("long"), F.lit(0)))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b)
    if isinstance(kind, MapType):
        both = [_extra_bytes(part(column), ArrayType(t)) for part, t in ((F.map_keys, kind.keyType), (F.map_values, kind.valueType))]
        return both[0] + both[1]
    if isinstance(kind, StructType):
        width = F.lit(16 * len(kind.fields)).cast("long")
        for field in kind.fields:
            own = _extra_bytes(column[field.name], field.dataType)
            if own is not None:
                width = width + F.coalesce(own.cast("long"), F.lit(0))
        return width
    return None


def key_side(table: DataFrame, few: bool | None = None) -> DataFrame:
    """``table`` for a join by keys that Spark may broadcast only if its rows are known or measured to be few.

    Spark goes by the size of the files below and by an assumed width of the columns, so millions of
    ids can look small enough.  With more rows both sides of the join are shuffled.
    """
    return table if few or few is None and fits_broadcast(table) else table.hint("merge")


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str,
    spread: list[Column | str],
    small: bool | None = None,
    wide: bool = False,
) -> DataFrame:
    """Join ``facts`` to ``table`` on ``on`` (inner, left, left_semi or left_anti).

    The table is broadcast only when it is known or measured to be small.  Otherwise both
    sides are shuffled with a salt taken from the ``spread`` columns, the table repeated once
    per salt, so that no key ends up in one task; adaptive execution splits further what is
    still too large.  (Without the salt, a later grouping by the key and something else would
    reuse the join's partitioning, and then adaptive execution may not split it.)  Pass
    tables that are cheap to read (written ones), since measuring reads them.

    With nothing to ``spread`` by there is no salt: for keys like ids, which few rows share.
    ``wide`` says that ``facts`` has texts and few of its rows are in ``table`` (not for left
    joins; both have the same types of keys): rows whose key is surely not there are not shuffled.
    """
    if small if small is not None else fits_broadcast(table):
        return facts.join(F.broadcast(table), on, how)
    if wide:
        maybe = _unused("_maybe", facts, table)
        judged = _sieved(facts, table, on, maybe)
        found = lookup_join(judged.where(F.col(maybe)).drop(maybe), table, on, how, spread, small=False)
        return found.unionByName(judged.where(~F.col(maybe)).drop(maybe)) if how == "left_anti" else found
    if not spread:
        return facts.join(key_side(table, few=False), on, how)
    salts = salts_of(facts.sparkSession)
    salt = _unused("_salt", facts, table)
    salted = facts.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(salts)))
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")
    repeated = table.withColumn(salt, F.explode(every_salt))
    # Spark's estimate does not count the salts, so it would broadcast them all.
    return salted.join(key_side(repeated, few=False), [*on, salt], how).drop(salt)


def _unused(name: str, *frames: DataFrame) -> str:
    while name in {c.lower() for frame in frames for c in frame.columns}:
        name += "_"
    return name


def _sieved(facts: DataFrame, table: DataFrame, on: list[str], maybe: str) -> DataFrame:
    """``facts`` and, as ``maybe``, whether a key of the table has set the bit of the own key's hash.

    The bits are broadcast: 64 for each row of the table up to ``SIEVE_BLOCKS``, then fewer, with
    which more rows may be there.
    """
    block, bits = _unused("_block", facts, table), _unused("_bits", facts, table)
    blocks = min(max(1, -(-64 * table.count() // BLOCK_BITS)), SIEVE_BLOCKS)
    place = F.pmod(F.xxhash64(*on), F.lit(blocks * BLOCK_BITS))
    own = F.pmod(place, F.lit(BLOCK_BITS))
    number = F.floor(place / BLOCK_BITS).alias(block)
    sieve = table.select(number, own.alias("own")).groupBy(block).agg(F.bitmap_construct_agg("own").alias(bits))
    byte = F.substring(bits, (own / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(own, F.lit(8)).cast("int")) == 1
    joined = facts.select("*", number).join(F.broadcast(sieve), block, "left")
    return joined.select(*[F.col(f"`{c}`") for c in facts.columns], F.coalesce(is_set, F.lit(False)).alias(maybe))
