"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

The tree has regions, racks and shards. A shard draws ``-ln(u) / weight`` with ``u`` from a hash of (shard,
doc_id); an inner node's draw is the least draw below it, which is a draw of the summed weight. A
row descends to the child with the smallest draw at every level. So a draw depends on nothing but the
shard's own weight: a changed weight moves rows only into or out of that shard, and one more shard takes rows only into
itself, at any count. A row makes one draw per shard; descending compares them node by node.

``topology(n)``: a region holds up to 2 racks x 5 shards.

Law: ``key`` - doc_id and the shard count decide. A null doc_id draws as the
string ``null``; equal doc_ids share a shard. Slots are gapless per shard:
rows are counted per (shard, hash bucket), running totals over that small
table give each bucket's offset, and only one bucket is ever ordered.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenor.llm.blocks import shielded, unshielded

RACKS, SHARDS = 2, 5
SHARD_COUNT = 40
ROWS_PER_BUCKET = 10_000
ROW_BYTES = 16


def topology(n: int) -> list[tuple[int, int, int, float]]:
    """(region, rack, shard, weight) of shards 0..n-1."""
    return [(s // (RACKS * SHARDS), s // SHARDS, s, 1.0) for s in range(n)]


def draw(shard: Column, weight: Column, key: Column) -> Column:
    """Exponential draw of rate ``weight`` from a 53-bit hash."""
    h = F.xxhash64(F.concat(F.lit("shard:"), shard.cast("string"), F.lit(":"), key))  # the part before the key is folded
    return -F.log((h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") + 0.5) / F.lit(float(1 << 53))) / weight


def _choose(draws: Column, nodes: Column) -> Column:
    """(id, lo, n) of the child with the smallest draw (ties: the smaller child); a child is its range of ``draws``."""
    return F.array_min(F.transform(nodes, lambda c: F.struct(
        F.array_min(F.slice(draws, c["lo"], c["n"])).alias("d"), c["id"], c["lo"], c["n"])))


def draws(key: str, tree: list[tuple[int, int, int, float]]) -> Column:
    """The draws of all shards, in tree order."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.array(*[draw(F.lit(s), F.lit(float(w)), k) for _, _, s, w in sorted(tree) if w > 0])


def assign(df: DataFrame, key: str, tree: list[tuple[int, int, int, float]], out: str, drawn: str | None = None) -> DataFrame:
    """Add ``out``: the shard reached by descending region, rack and shard. Row-local. ``drawn`` names a column with the draws of a
    tree that begins with this one. The frame must hold no columns named _draws, _region or _rack."""
    leaves = sorted(leaf for leaf in tree if leaf[3] > 0)

    def nodes(level: int, inside: int | None = None) -> Column:
        """The nodes of a level below a parent, as ranges of the leaves (from 1)."""
        found: dict[int, list[int]] = defaultdict(list)
        for place, leaf in enumerate(leaves, 1):
            if inside is None or leaf[level - 1] == inside:
                found[leaf[level]].append(place)
        return F.array(*[F.struct(F.lit(c).alias("id"), F.lit(at[0]).alias("lo"), F.lit(len(at)).alias("n")) for c, at in sorted(found.items())])

    def below(level: int, at: str) -> Column:
        parents = sorted({leaf[level - 1] for leaf in leaves})
        table = F.create_map(*[x for p in parents for x in (F.lit(p), nodes(level, p))])
        return _choose(F.col("_draws"), F.element_at(table, F.col(f"{at}.id")))

    df = df.withColumn("_draws", F.col(drawn) if drawn else draws(key, tree)).withColumn("_region", _choose(F.col("_draws"), nodes(0)))
    df = df.withColumn("_rack", below(1, "_region"))
    return df.withColumn(out, below(2, "_rack")["id"].cast("int")).drop("_draws", "_region", "_rack")


def with_slots(df: DataFrame, n_shards: int, key: str = "doc_id", shard: str = "shard") -> DataFrame:
    """Add ``slot``: gapless from 0 within every shard, ordered by (hash, key, crc, size)."""
    buckets = max(1, math.ceil(df.count() / (n_shards * ROWS_PER_BUCKET)))
    df = df.withColumn("_h", F.xxhash64(F.lit("slot"), F.col(key), F.col("text_crc32"), F.col("size")))
    df = df.withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets)).cast("int"))
    w = Window.partitionBy(shard).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(shard, "_b").agg(F.count(F.lit(1)).alias("_c"))
               .select(shard, "_b", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off")))
    inside = Window.partitionBy(shard, "_b").orderBy("_h", key, "text_crc32", "size")
    return (df.withColumn("_r", F.row_number().over(inside) - 1).join(offsets, [shard, "_b"])
            .withColumn("slot", (F.col("_off") + F.col("_r")).cast("long")).drop("_h", "_b", "_r", "_off"))


NEW = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shard_documents(docs: DataFrame, n_shards: int = SHARD_COUNT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's columns plus size, text_crc32, law, shard, slot, grown_shard (one more
    shard). Null text: 16 bytes, checksum 0. Any other column may have any name; one named like a new column is replaced."""
    df, own = shielded(docs)
    t = F.coalesce(F.col(own[text]), F.lit(""))
    df = (df.withColumn("size", (F.octet_length(t) + ROW_BYTES).cast("long"))
          .withColumn("text_crc32", F.crc32(t.cast("binary"))).withColumn("law", F.lit("key")))
    df = df.withColumn("drawn", draws(own[key], topology(n_shards + 1)))  # a shard draws alike under both counts
    df = assign(df, own[key], topology(n_shards), "shard", "drawn")
    df = assign(df, own[key], topology(n_shards + 1), "grown_shard", "drawn")
    return with_slots(df.drop("drawn"), n_shards, own[key]).select(*unshielded(own, NEW), *NEW)


def digest(docs: DataFrame) -> DataFrame:
    return shard_documents(docs.select("doc_id", "text")).drop("text")
