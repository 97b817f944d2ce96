"""Joins of a large frame with a fitted table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadspark.session import cut

BROADCAST_ROWS = 1_000_000
#: Bytes of all tables that one call may broadcast together, as measured by ``row_bytes``.
BROADCAST_BYTES = 64 << 20
#: What a row of a broadcast hash table takes beyond its values.
ROW_OVERHEAD = 48
#: Rows of one key that may meet in one task of a shuffle join; a key with more is salted.
ROWS_PER_SALT = 1_000_000
#: At most so many keys are salted, so the list of them is small whatever the input.
MAX_HOT_KEYS = 1 << 16


def row_bytes(table: DataFrame) -> Column:
    """Size of a row: its strings as they are, 8 bytes for each other value, and the overhead of a hash table."""
    size = F.lit(ROW_OVERHEAD)
    for f in table.schema.fields:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.AtomicType):
            size = size + F.lit(8)
        else:
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return size.cast("long")


def fits(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table may be broadcast, by a count of its rows and bytes."""
    n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(table)), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def fitting_parts(table: DataFrame, part: str, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> set[str]:
    """Parts of a stored table that may all be broadcast in one plan.

    One aggregation measures every part. The smallest come first, until rows or
    bytes of those taken so far would pass the bound; a part beyond it leaves the
    others alone.
    """
    sizes = table.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(table)).alias("size")).collect()  # one row a part
    taken, rows, total = set(), 0, 0
    for r in sorted(sizes, key=lambda r: (r["size"], r["n"], r[part])):
        rows, total = rows + r["n"], total + r["size"]
        if rows > max_rows or total > max_bytes:
            break
        taken.add(r[part])
    return taken


def hot_keys(df: DataFrame, on: list[str], rows_per_salt: int = ROWS_PER_SALT, max_keys: int = MAX_HOT_KEYS, rows: str | None = None) -> DataFrame:
    """(_kh, _salts) of the keys with more than ``rows_per_salt`` rows; column ``rows`` counts them where they were counted before.

    Rows are counted by a 64-bit hash of the key, map-side first. Where more than
    ``max_keys`` keys could be hot, the bound rises to the row count over
    ``max_keys``. Keys that share a hash are salted alike on both sides, which
    changes no result.
    """
    number = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
    counts = df.groupBy(F.xxhash64(*on).alias("_kh")).agg(number.alias("_n"))
    total = F.lit(df.agg(number).first()[0])
    least = F.greatest(F.lit(rows_per_salt), F.ceil(total / F.lit(max_keys)))
    return counts.where(F.col("_n") > least).select("_kh", F.ceil(F.col("_n") / F.lit(rows_per_salt)).cast("int").alias("_salts"))


def salted_join(df: DataFrame, table: DataFrame, on: list[str], how: str = "left", rows_per_salt: int = ROWS_PER_SALT, hot: DataFrame | None = None) -> DataFrame:
    """Shuffle join with a table of unique keys in which hot keys of ``df`` are spread over several tasks.

    A hot key's row of the table is repeated once a salt; rows of ``df`` take their
    salt from a hash of their own columns, so a task that runs again deals them
    the same way (exact repeats of a row share a salt). Null keys meet nothing, and are spread alike. ``df`` is read twice,
    or once with its hot keys given.
    """
    hot = cut(hot_keys(df, on, rows_per_salt) if hot is None else hot)  # at most MAX_HOT_KEYS rows of 12 bytes
    own = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    salts = F.coalesce("_salts", F.lit(1))
    key = F.xxhash64(*on)
    left = df.withColumn("_kh", key).join(F.broadcast(hot), "_kh", "left")
    left = left.withColumn("_salt", F.pmod(F.xxhash64(F.lit("salt"), *own), salts).cast("int")).drop("_kh", "_salts")
    right = table.withColumn("_kh", key).join(F.broadcast(hot), "_kh", "left")
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_kh", "_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    df: DataFrame, table: DataFrame, on: list[str] | str, how: str = "left", max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left or inner join with a table that has one row per key.

    The table is written once and measured. Up to ``max_rows`` and ``max_bytes`` it
    is broadcast, so the large side neither shuffles nor feels a hot key. Beyond
    that both sides shuffle by key, with the large side's hot keys salted.
    """
    on = [on] if isinstance(on, str) else list(on)
    fixed = cut(table)
    if fits(fixed, max_rows, max_bytes):
        return df.join(F.broadcast(fixed), on, how)
    return salted_join(df, fixed, on, how, rows_per_salt)
