"""N-gram Jaccard join by grouped prefixes, and its connected components.

Two documents link when ``100 * |A & B| >= 90 * |A | B|`` over their sets of
distinct 3-word shingles (both numbers are parameters). Steps:

1. Document frequencies of all shingles by the block exchange (exact counts of
   32-bit shingle keys; the frequencies only order the shingles, so a shared key
   costs selectivity, never a link).
2. Per document: set size n, the shingles no other document has (u of them),
   and the prefix of its set in (frequency, hash) order. Only ``n - u`` shingles
   can be shared, so a document with ``n - u < ceil(0.9 n)`` links with nothing
   and goes no further. Shingles of frequency one are left out of the prefix.
3. Documents with equal sets are one class. Classes with identical prefix and
   size are one *group*; only groups enter the posting lists.
4. Stars: in each list every group is paired with the list's pivot group; size and
   position bounds drop pairs; pairs are expanded to members (each against the
   pivot's member) and verified on the whole sets, keeping the exact overlaps.
5. Rest: lists that still hold two or more components pair classes of different
   components under the same bounds and one more: two classes that overlap one pivot
   share at most what both share with it plus what neither does. Pairs already
   verified are left out. Pairs inside one component cannot change the result, so
   groups of near copies are never expanded into all pairs.

Every pair of classes that links is either verified or lies inside a
component that verified links connect already. Texts without words, null
texts included, have an empty set and link with nothing; fewer than 3 words count as
one shingle. Equal sets link (their similarity is 1). A null doc_id gets a
component of its own kind: the smallest non-null doc_id of it, else null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor.llm import blocks, textkit
from tenor.llm.components import components

WORDS = 3
PERCENT = 90
U32 = np.uint64(32)


def shingle_sets(table: pa.Table, k: int, text: str):
    """Per slice: (first document, documents, distinct shingles, document of each), sorted by (document, shingle)."""
    raw, offsets = textkit.buffers(table.column(text))
    for lo, hi in textkit.slices(offsets):
        off = offsets[lo:hi + 1] - offsets[lo]
        h, first, _, _ = textkit.word_hashes(raw[offsets[lo]:offsets[hi]], off)
        toks, doc = textkit.shingles(h, first, k)
        counts = np.diff(first)
        for short in range(1, k):  # the whole sequence is the one shingle
            at = np.flatnonzero(counts == short)
            if len(at):
                acc = np.full(len(at), np.uint64(short), np.uint64)
                for j in range(short):
                    acc = textkit.mix(acc * textkit._STEP + h[first[at] + j])
                toks, doc = np.concatenate((toks, acc)), np.concatenate((doc, at))
        order = np.lexsort((toks, doc))
        toks, doc = toks[order], doc[order]
        new = np.ones(len(toks), bool)
        new[1:] = (toks[1:] != toks[:-1]) | (doc[1:] != doc[:-1])
        yield lo, hi - lo, toks[new], doc[new]


def _frequency_class(total: np.ndarray) -> np.ndarray:
    """Monotone 8-bit class of a frequency: exact up to 200, then quarter powers of two."""
    big = 200 + np.floor(4 * np.log2(np.maximum(total, 200) / 200))
    return np.where(total <= 200, total, np.minimum(big, 255)).astype(np.uint8)


def describe(docs: DataFrame, k: int, percent: int, key: str, text: str) -> DataFrame:
    """(key, cid, n, u, gid, prefix, toks): one row per document; gid, prefix and toks are null
    for documents that cannot link with a different set."""
    n_blocks = blocks.block_count(docs, text)
    rows = blocks.with_block(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), n_blocks)

    def block_keys(table: pa.Table):
        parts = [t >> U32 for _, _, t, _ in shingle_sets(table, k, "text")]
        return np.unique(np.concatenate(parts).astype(np.uint32), return_counts=True) if parts else (
            np.empty(0, np.uint32), np.empty(0, np.int64))

    def emit(table: pa.Table) -> pa.Table:
        keys, counts = block_keys(table)
        return blocks.pack(table.column("block")[0].as_py(), blocks.bucket_edges(keys, n_blocks),
                           {"keys": keys, "counts": np.minimum(counts, 65535).astype(np.uint16)})

    def merge(table: pa.Table) -> pa.Table:
        keys, sizes = blocks.unpack(table.column("keys"), np.uint32)
        counts, _ = blocks.unpack(table.column("counts"), np.uint16)
        _, inverse = np.unique(keys, return_inverse=True)
        cls = _frequency_class(np.bincount(inverse, weights=counts))[inverse]
        ends = np.cumsum(sizes)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "freq": pa.array([cls[e - s:e].tobytes() for s, e in zip(sizes, ends)], pa.binary())})

    replies = blocks.exchange(rows, emit, "bucket int, block int, keys binary, counts binary",
                              merge, "block int, bucket int, freq binary")
    schema = "doc_id long, cid binary, n int, u int, gid binary, prefix array<long>, toks array<long>"

    def finish(table: pa.Table, answer: pa.Table) -> pa.Table:
        keys = block_keys(table)[0]
        freq = blocks.answers(answer, "freq", np.uint8)
        ids = table.column("doc_id").to_pylist()
        out = {c: [] for c in ("doc_id", "cid", "n", "u", "gid", "prefix", "toks")}
        for lo, count, toks, doc in shingle_sets(table, k, "text"):
            f = freq[np.searchsorted(keys, (toks >> U32).astype(np.uint32))]
            order = np.lexsort((toks, f, doc))
            ranked, edges = toks[order], np.searchsorted(doc, np.arange(count + 1))
            alone = np.bincount(doc[f == 1], minlength=count)
            for i in range(count):
                s, e = edges[i], edges[i + 1]
                n, u = int(e - s), int(alone[i])
                need = -(-percent * n // 100)
                active = n > 0 and n - u >= need
                prefix = ranked[s + u:s + n - need + 1] if active else None
                out["doc_id"].append(ids[lo + i])
                out["cid"].append(hashlib.blake2b(toks[s:e].tobytes(), digest_size=16).digest() if n else None)
                out["n"].append(n)
                out["u"].append(u)
                out["gid"].append(hashlib.blake2b(prefix.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest()
                                  if active else None)
                out["prefix"].append(prefix.view(np.int64) if active else None)
                out["toks"].append(toks[s:e].view(np.int64) if active else None)
        types = {"doc_id": pa.int64(), "cid": pa.binary(), "n": pa.int32(), "u": pa.int32(), "gid": pa.binary(),
                 "prefix": pa.list_(pa.int64()), "toks": pa.list_(pa.int64())}
        return pa.table({c: pa.array(v, types[c]) for c, v in out.items()})

    return rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, schema)


def _may_link(percent: int, na: str, ua: str, nb: str, ub: str) -> Column:
    """Size and sharing bounds a linked pair meets. With the position of a token in place of
    ``u``: what the pair still can share if that token is the first they share."""
    n1, n2 = F.col(na).cast("long"), F.col(nb).cast("long")
    shared = F.least(n1 - F.col(ua), n2 - F.col(ub))
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & ((100 + percent) * shared >= percent * (n1 + n2)))


def _overlaps(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, na, nb, c): the exact overlap of the whole sets of every pair."""
    sets = nodes.select("cid", "toks")
    both = (pairs.select("a", "b").join(sets.select(F.col("cid").alias("a"), F.col("toks").alias("_ta")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("toks").alias("_tb")), "b"))
    return both.select("a", "b", F.size("_ta").alias("na"), F.size("_tb").alias("nb"),
                       F.size(F.array_intersect("_ta", "_tb")).alias("c"))


def _linked(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(100 * F.col("c") >= percent * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def links(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Verified links between classes; with equal sets they connect every linked pair. ``nodes``:
    (cid, n, u, gid, prefix, toks), one stored row per class that may link."""
    slim = nodes.select("cid", "gid", "n", "u")
    groups = blocks.stored(nodes.groupBy("gid").agg(
        F.min("cid").alias("pivot"), F.first("n").alias("n"), F.first("u").alias("u"), F.first("prefix").alias("prefix"),
        F.count(F.lit(1)).alias("members")), "groups")  # equal size and prefix: equal u
    post = blocks.stored(groups.select("gid", "n", "u", F.posexplode("prefix").alias("i", "t"))
                         .withColumn("i", F.col("i") + F.col("u")), "postings")
    lists = blocks.stored(post.groupBy("t").agg(F.min(F.struct("u", "gid", "n", "i")).alias("p"), F.count(F.lit(1)).alias("_n"))
                          .where(F.col("_n") > 1).select("t", F.col("p.gid").alias("pgid"), F.col("p.n").alias("pn"),
                                                         F.col("p.i").alias("pi")), "lists")
    # a group against the pivots of its lists, and its members against its own pivot
    star = (post.join(lists, "t").where((F.col("gid") != F.col("pgid")) & _may_link(percent, "n", "i", "pn", "pi"))
            .select("gid", "pgid").distinct()
            .unionByName(groups.where(F.col("members") > 1).select("gid", F.col("gid").alias("pgid"))))
    heads = groups.select(F.col("gid").alias("pgid"), F.col("pivot").alias("a"))
    pairs = (star.join(heads, "pgid").join(slim.select("gid", F.col("cid").alias("b")), "gid")
             .where(F.col("a") != F.col("b")).select("a", "b").distinct())
    stars = blocks.stored(_overlaps(pairs, nodes), "stars")
    found = blocks.stored(_linked(stars, percent), "links")
    label = components(found)
    # the pivot a class overlaps most, and by how much; others are their own
    near = stars.groupBy("b").agg(F.max(F.struct("c", "a")).alias("_m")).select(
        F.col("b").alias("cid"), F.col("_m.a").alias("pv"), F.col("_m.c").alias("pc"))
    member = (slim.join(label.withColumnRenamed("id", "cid"), "cid", "left").join(near, "cid", "left")
              .select("cid", "gid", F.coalesce("comp", "cid").alias("comp"), F.coalesce("pv", "cid").alias("pv"),
                      F.coalesce("pc", "n").alias("pc")))
    wide = blocks.stored(post.select("t", "gid", "n", "i").join(member, "gid").drop("gid"), "members")
    mixed = wide.groupBy("t").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where(
        F.col("_lo") != F.col("_hi")).select("t")
    wide = blocks.stored(wide.join(mixed, "t"), "mixed")
    side = lambda x: wide.select(F.col("t").alias(f"t{x}"), *[F.col(c).alias(f"{c}{x}") for c in ("cid", "n", "i", "comp", "pv", "pc")])
    # two sets share at most what both share with a third, and what neither shares with it
    over_pivot = F.least("pca", "pcb") + F.least(F.col("na") - F.col("pca"), F.col("nb") - F.col("pcb"))
    may = (F.col("pva") != F.col("pvb")) | ((100 + percent) * over_pivot.cast("long") >= percent * (F.col("na") + F.col("nb")).cast("long"))
    rest = (side("a").join(side("b"), (F.col("ta") == F.col("tb")) & (F.col("cida") < F.col("cidb"))
                           & (F.col("compa") != F.col("compb")) & _may_link(percent, "na", "ia", "nb", "ib") & may)
            .select(F.col("cida").alias("a"), F.col("cidb").alias("b")).distinct())
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = rest.join(known, ["a", "b"], "left_anti")
    return found.unionByName(_linked(_overlaps(rest, nodes), percent))


def jaccard_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row."""
    rows = blocks.stored(describe(docs, k, percent, key, text), "sets")
    nodes = blocks.stored(rows.where(F.col("gid").isNotNull())
                          .select("cid", "n", "u", "gid", "prefix", "toks").dropDuplicates(["cid"]), "classes")
    label = components(links(nodes, percent))
    ids = rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("doc_id").alias("rep"))
    ids = blocks.stored(ids.join(label.withColumnRenamed("id", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "members")
    # one row per component, stored apart: broadcast when it is small, else a join whose hot component AQE splits
    best = blocks.stored(ids.groupBy("comp").agg(F.min("rep").alias("component_id")), "components")
    table = ids.join(best, "comp").select("cid", "component_id")
    return (rows.select("doc_id", "n", "cid").join(table, "cid", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One row of every component: the smallest doc_id (null last), then the smallest hash of
    the row, and one of equal rows. Rows with an empty set stay. Columns may have any name."""
    own, names = blocks.shielded(docs)
    key, text = names[key], names[text]
    rows = own.withColumn("_row", blocks.row_hash(own))
    comp = (jaccard_components(rows, k, percent, "_row", text).where("n_shingles > 0")
            .groupBy(F.col("doc_id").alias("_row")).agg(F.min("component_id").alias("_comp"), F.count(F.lit(1)).alias("_copies")))
    named = blocks.stored(comp.join(rows.groupBy("_row").agg(F.min(key).alias("_key")), "_row"), "rows")
    lead = named.groupBy("_comp").agg(F.min(F.struct(F.col("_key").isNull(), "_key", "_row")).alias("_lead")).select("_lead._row")
    stay = rows.join(named.join(lead, "_row", "left_anti").select("_row"), "_row", "left_anti")
    many = named.where("_copies > 1").select("_row")
    once = stay.join(many, "_row", "left_semi").dropDuplicates(["_row"])
    return stay.join(many, "_row", "left_anti").unionByName(once).select(*blocks.unshielded(names))


ORACLE = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT rid, k FROM (
        SELECT rid, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS k
        FROM d WHERE len(ws) >= {WORDS}
        UNION ALL SELECT rid, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND {WORDS - 1})),
z AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
e AS (SELECT p.a, p.b FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.rid <> y.rid
        GROUP BY 1, 2) p JOIN z za ON za.rid = p.a JOIN z zb ON zb.rid = p.b
      WHERE 100 * p.c >= {PERCENT} * (za.n + zb.n - p.c)),
r(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, min(t.doc_id) AS component_id
FROM d JOIN r ON r.a = d.rid JOIN d t ON t.rid = r.b LEFT JOIN z ON z.rid = d.rid
GROUP BY d.rid, d.doc_id, z.n
"""
