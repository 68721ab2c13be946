"""Sharding by a permutation-filled lookup table (Maglev hashing, Eisenbud et
al., 2016), with SQL functions only.

Each shard prefers the slots of a prime-sized table in its own order
``(offset + j * skip) mod size``, j = 0, 1, ... Shards take turns, and each
turn claims the shard's first free slot, until all are taken; so slots are
shared evenly (to one slot), and a shard that comes or goes moves few others.
The table is filled by one SQL fold over the turns. A key's slot is its hash
modulo the table size, and its shard comes from the broadcast table: one look-up
per row, no shuffle, so a hot key costs nothing extra. The broadcast holds
``size`` rows, whatever the data.

Cases: a null key is placed as the empty string is; equal keys get equal
shards, repeated rows their row each; other columns are ignored, whatever
their names; an empty table gives no rows. Shard names must be distinct and not
null, fewer than slots, and the size a prime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = [f"shard-{i:02d}" for i in range(16)]
SIZE = 4099          # slots: a prime, over a hundred times the shards
MAX_SIZE = 20_011    # the fold works in size * size steps


def _number(text: Column) -> Column:
    """First 15 hexadecimal digits of the MD5 sum, as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(spark: SparkSession, shards: list[str], size: int = SIZE) -> DataFrame:
    """(slot, shard) for every slot."""
    if not _prime(size) or size > MAX_SIZE:
        raise ValueError(f"size must be a prime up to {MAX_SIZE}, not {size}")
    if not shards or len(set(shards)) != len(shards) or len(shards) >= size:
        raise ValueError("shards must be distinct, at least one, and fewer than slots")
    names = F.array(*map(F.lit, shards))
    one = spark.range(1).select(names.alias("names"))
    j = F.sequence(F.lit(0).cast("long"), F.lit(size - 1).cast("long"))
    orders = F.transform("names", lambda s: F.transform(j, lambda k: (
        (_number(F.concat(s, F.lit("#offset"))) % size + k * (_number(F.concat(s, F.lit("#skip"))) % (size - 1) + 1)) % size
    ).cast("int")))
    one = one.select("names", orders.alias("orders"))
    filled = F.expr(f"""
        aggregate(sequence(0, {size - 1}), array_repeat(-1, {size}), (slots, turn) ->
          element_at(transform(array(filter(orders[turn % {len(shards)}], s -> slots[s] = -1)[0]),
            claim -> transform(slots, (held, s) -> IF(s = claim, turn % {len(shards)}, held))), 1))""")
    return (one.select("names", F.posexplode(filled).alias("slot", "owner"))
            .select("slot", F.expr("names[owner]").alias("shard")))


def assign(df: DataFrame, key_col: str, shards: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """(key, slot, shard) for every row."""
    slot = (_number(F.coalesce(F.col(key_col).cast("string"), F.lit(""))) % size).cast("int")
    table = F.broadcast(lookup_table(df.sparkSession, shards or SHARDS, size))
    return df.select(F.col(key_col).alias("key"), slot.alias("slot")).join(table, "slot").select("key", "slot", "shard")
