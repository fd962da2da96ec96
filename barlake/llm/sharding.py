"""Shards by extendible hashing: a directory of hash prefixes, split only where a bucket is too large.

A row's address is the hash of its key followed by the hash of the row's own number, so rows of one
hot key part, too, once the key's bits are used up. A bucket is all rows that share the first bits of
their address. From the root on, each bucket above the byte limit is split on the next bit; what fits
stays a shard. Sizes of all prefixes within the next STEP bits are added up at once, so a round of
Spark jobs takes STEP levels of the directory; only rows of oversized buckets go to the next round.

The first KEY_BITS bits come from MD5, the same in every engine. Null keys hash like empty text; a
null or empty text has no bytes. A row above the limit ends as a shard of its own, flagged by its
size; rows of 0 bytes stay with their prefix. Repeated rows are rows like others. An empty table has
one empty shard and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import stored

LIMIT = 1 << 20
STEP = 8
KEY_BITS = 60
ROW_BITS = 60


def md5_bits(text: Column) -> Column:
    """The first 60 bits of the MD5 digest, written as 0 and 1."""
    number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.lpad(F.bin(number), KEY_BITS, "0")


def sized(docs: DataFrame, key: str, text: str, row: str | None = None) -> DataFrame:
    """(row, address, n_bytes) of each row of ``docs``; the row's number is kept with its key."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    own = F.coalesce(F.col(key).cast("string"), F.lit(""))
    numbered = docs.select(
        F.col(key).alias("key"), own.alias("own"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
        number.alias("row"),
    )
    address = F.concat(md5_bits(F.col("own")), md5_bits(F.concat(F.lit("row "), F.col("row").cast("string"))))
    # Row numbers hold for one evaluation only, so they are written down.
    return stored(numbered.select("key", "row", "n_bytes", address.alias("address")), "addresses")


def leaves(open_rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """(cell, shard): for each cell of STEP more bits its bucket that fits, null if even it doesn't."""
    cells = open_rows.groupBy(F.substring("address", 1, depth + STEP).alias("cell")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")
    )
    cells = stored(cells, "cells")
    levels = F.explode(F.sequence(F.lit(depth + 1 if depth else 0), F.lit(depth + STEP))).alias("level")
    by_level = cells.select("cell", "n_bytes", "n_rows", levels)
    prefix = F.expr("substring(cell, 1, level)")
    fitting = (
        by_level.groupBy(prefix.alias("prefix")).agg(F.sum("n_bytes").alias("b"), F.sum("n_rows").alias("n"))
        .where((F.col("b") <= limit) | (F.col("n") == 1))
        .select("prefix")
    )
    shard = by_level.select("cell", prefix.alias("prefix")).join(fitting, "prefix", "left_semi")
    least = shard.groupBy("cell").agg(F.min_by("prefix", F.length("prefix")).alias("shard"))
    return cells.select("cell").join(least, "cell", "left")


def assign(docs: DataFrame, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, shard, depth), one row per row of ``docs``; ``shard`` is the address prefix.

    The rows' addresses, not their texts, are what moves. A cell that holds a third of all rows is
    joined as one row with the rows' side split at will.
    """
    out = placed_rows(sized(docs, key, text), limit)
    return out.select(F.col("key").alias(key), "n_bytes", "shard", F.length("shard").alias("depth"))


def placed_rows(rows: DataFrame, limit: int) -> DataFrame:
    """(key, row, n_bytes, address, shard) of all rows of ``sized``."""
    depth, done = 0, []
    while True:
        cell = F.substring("address", 1, depth + STEP)
        found = rows.withColumn("cell", cell).join(stored(leaves(rows, depth, limit), "leaves"), "cell", "left")
        last = depth + STEP >= KEY_BITS + ROW_BITS
        shard = F.coalesce("shard", F.col("address")) if last else F.col("shard")
        placed = stored(found.select("key", "row", "n_bytes", "address", shard.alias("shard")), "placed")
        done.append(placed.where("shard IS NOT NULL"))
        rows, depth = placed.where("shard IS NULL").drop("shard"), depth + STEP
        if last or rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def directory(assigned: DataFrame) -> DataFrame:
    """(shard, depth, n_rows, n_bytes) of the shards that hold rows."""
    return assigned.groupBy("shard", "depth").agg(F.count("*").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> None:
    """Write the rows as Parquet, one folder per shard; null, repeated and hot keys are rows like others.

    The folders' column is ``shard``, with underscores behind if the rows have one of that name.
    """
    name = "shard"
    while name in docs.columns:
        name += "_"
    # Rows meet their shards by number; it is written with the row, as it holds for one evaluation only.
    number = f"{name}_row"
    while number in docs.columns:
        number += "_"
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = placed_rows(sized(numbered, key, text, number), limit)
    shards = found.select(F.col("row").alias(number), F.col("shard").alias(name))
    placed = numbered.join(shards, number).drop(number)
    placed.repartition(name).write.partitionBy(name).parquet(path)


def oracle(limit: int = LIMIT, levels: int = 24) -> str:
    """DuckDB SQL for unique keys: the shortest prefix of the hash whose bytes fit."""
    return f"""
WITH sized AS (
  SELECT doc_id, COALESCE(octet_length(encode(text)), 0) AS n_bytes,
         ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h
  FROM documents
), prefixes AS (
  SELECT doc_id, n_bytes, CAST(level AS INTEGER) AS depth,
         CASE WHEN level = 0 THEN '' ELSE substr(lpad(bin(h), {KEY_BITS}, '0'), 1, CAST(level AS INTEGER)) END AS shard
  FROM sized, range(0, {levels + 1}) AS t(level)
), buckets AS (
  SELECT depth, shard FROM prefixes GROUP BY depth, shard HAVING sum(n_bytes) <= {limit} OR count(*) = 1
)
SELECT doc_id, n_bytes, min_by(shard, depth) AS shard, min(depth) AS depth
FROM prefixes JOIN buckets USING (depth, shard) GROUP BY doc_id, n_bytes"""
