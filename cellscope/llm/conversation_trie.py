"""Prefix trie of conversations by whole-sequence collapse (op13).

Conversations are rebuilt (the first h turns of the conversation that begins their block of
100, then their own turns after the first h), and every sequence of first d turns is a node.
A node is known by its depth and 128 bits: the XOR, over its turns, of two hashes of
(position, role, text).  Texts are read once and never shuffled.

1. Turns are ordered by a range exchange on the whole order key and scanned with carries
   (:mod:`cellscope.operators.ordered`), so a conversation of any length spreads over
   partitions.  The scan gives positions, prefix hashes and prefix lengths.
2. Collapse: identical rebuilt conversations become one weighted sequence.  Their ids, the
   end list, are sorted by a range exchange, written as pieces of at most ``PIECE`` ids and
   hashed piece by piece; no list is ever held whole.
3. Only the sequence's first conversation keeps its prefixes.  Sequences whose whole is a
   proper prefix of another one go by an anti-join; those left are the leaves.
4. Weighted prefixes are aggregated by node.  What a subtree saves is a difference of two
   sums that both come from the paths through a node, so no pair of a node and its
   ancestor is ever made: all copies of all turns below (weight times what is left of the
   sequence), less every node below once.  For the latter each node belongs to the least
   leaf below it; a leaf's own nodes are the end of its path, from depth k on, so it adds
   what is left of it from max(k, depth).

A node with very many children is met in two places: counting them (combined before the
shuffle) and giving them the parent's id (a left join whose large side Spark splits).

Cases: rows without conv_id belong to no conversation and are left out; null role or text is
empty; null turns come first; rows of equal turn are ordered by a hash of role and text, so
equal rows are turns of their own; block and remainder of a negative id are those of SQL
(-5 % 100 = -5); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import map_batches, materialize
from cellscope.operators.ordered import range_tagged, running_tagged

BLOCK = 100         # conversations that share a beginning
HEADS = 6           # 0 to HEADS - 1 turns are shared
PIECE = 1 << 14     # ids of an end list in one row
STRETCH = 10        # paths are joined in stretches of 2 ** STRETCH turns

NODE = ["depth", "p1", "p2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv_id: Column) -> Column:
    """Number of turns taken from the block's first conversation."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Rows of the rebuilt conversations, a beginning (kind -1) of each, then shared turns
    (kind 0) and all its own turns (kind 1): conv_id, kind, rank, turn, a1, a2, chars."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.xxhash64(F.lit(1), role, text).alias("a1"), F.xxhash64(F.lit(2), role, text).alias("a2"),
        F.length(text).cast("long").alias("chars"))
    ids = own.select("conv_id").distinct().withColumn("h", shared_turns(F.col("conv_id")))
    # At most HEADS - 1 rows of a conversation leave a task here.
    order = Window.partitionBy("conv_id").orderBy("turn", "a1", "a2")
    first = own.where(F.col("conv_id") % BLOCK == 0).withColumn("rank", F.row_number().over(order))
    first = first.where(F.col("rank") < HEADS).withColumnRenamed("conv_id", "block")
    heads = ids.withColumn("block", F.expr(f"conv_id - conv_id % {BLOCK}")).join(first, "block").where("rank <= h")

    def rows(df: DataFrame, kind: int, rank: Column) -> DataFrame:
        return df.select("conv_id", F.lit(kind).alias("kind"), rank.alias("rank"), "turn", "a1", "a2", "chars")

    begin = ids.select("conv_id", F.lit(None).cast(own.schema["turn"].dataType).alias("turn"),
                       *[F.lit(0).cast("long").alias(c) for c in ("a1", "a2", "chars")])
    return rows(begin, -1, F.lit(0)).union(rows(heads, 0, F.col("rank"))).union(rows(own, 1, F.lit(0)))


def prefixes(conversations: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation, the empty one included:
    conv_id, depth, p1, p2 (its hash), q1, q2 (that of its parent), chars (of its last
    turn), upto (of all its turns)."""
    kinds = {"is_head": F.col("kind") == 0, "is_own": F.col("kind") == 1}
    tagged = range_tagged(rebuilt(conversations).withColumns({n: c.cast("long") for n, c in kinds.items()}),
                          ["conv_id", "kind", "rank", "turn", "a1", "a2"])
    at = running_tagged(tagged, ["conv_id"], {"heads": "is_head", "owns": "is_own"})
    h = shared_turns(F.col("conv_id"))
    at = at.where((F.col("kind") < 1) | (F.col("owns") > h)).withColumn(
        "depth", F.col("heads") + F.greatest(F.col("owns") - h, F.lit(0)))
    for z, a in (("z1", "a1"), ("z2", "a2")):
        at = at.withColumn(z, F.when(F.col("kind") < 0, F.lit(0)).otherwise(F.xxhash64("depth", a)))
    at = running_tagged(at, ["conv_id"], {"upto": "chars"}, {"p1": "z1", "p2": "z2"})
    return at.select("conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("z1")).alias("q1"),
                     F.col("p2").bitwiseXOR(F.col("z2")).alias("q2"), "chars", "upto")


def _same_runs(batch, names):
    """Bounds of the runs of equal values in the columns ``names`` of a sorted batch."""
    import numpy as np

    change = np.zeros(batch.num_rows, bool)
    change[0] = True
    for n in names:
        v = batch.column(n).to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), batch.num_rows)


def _pieces(batches):
    """Sorted (node, conv_id) rows -> rows of up to PIECE ids of one sequence, written out."""
    import pyarrow as pa

    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = _same_runs(batch, NODE)
        ids = batch.column("conv_id").to_pylist()
        cut = [(a, min(a + PIECE, hi)) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
               for a in range(lo, hi, PIECE)]
        at = pa.array([a for a, _ in cut], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n).take(at) for n in NODE], batch.column("total").take(at),
             batch.column("conv_id").take(at), pa.array([b - a for a, b in cut], pa.int64()),
             pa.array([",".join(map(str, ids[a:b])) for a, b in cut])],
            [*NODE, "total", "conv_id", "n_ends", "ids"])


def _digests(batches):
    """Sorted pieces -> one row for each sequence with its weight and the hash of its ends."""
    import pyarrow as pa

    held = None
    names = [*NODE, "total", "conv_id", "n_ends", "ends_sha256"]

    def done(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(3)]
            + [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)]
            + [pa.array([r[4].hexdigest() for r in rows])], names)

    for batch in batches:
        out = []
        for *node, total, conv_id, n, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held is not None and held[0] == node:
                held[3] += n
                held[4].update(b"," + ids.encode())
                continue
            if held is not None:
                out.append(held)
            held = [node, total, conv_id, n, hashlib.sha256(ids.encode())]
        if out:
            yield done(out)
    if held is not None:
        yield done([held])


def sequences(paths: DataFrame) -> DataFrame:
    """Distinct whole sequences: depth, p1, p2, total (characters), conv_id (least), n_ends
    (weight), ends_sha256.  ``paths`` as from :func:`prefixes`."""
    whole = paths.groupBy("conv_id").agg(F.max(F.struct("depth", "p1", "p2", "upto")).alias("w")).select(
        "w.depth", "w.p1", "w.p2", F.col("w.upto").alias("total"), "conv_id")
    whole = materialize(whole, "trie-whole")
    fields = "depth long, p1 long, p2 long, total long, conv_id long, n_ends long"
    order = [*NODE, "conv_id"]
    pieces = map_batches(whole.repartitionByRange(*order).sortWithinPartitions(*order), _pieces, fields + ", ids string")
    return map_batches(pieces.repartition(*NODE).sortWithinPartitions(*order), _digests,
                       fields + ", ends_sha256 string")


def _along(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows of ``paths`` with the columns of their sequence's row in ``ends`` (both by the
    sequence's first conversation); long paths are joined stretch by stretch."""
    spread = ends.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright("length", STRETCH))))
    return paths.withColumn("stretch", F.shiftright("depth", STRETCH)).join(spread, ["conv_id", "stretch"]).drop("stretch")


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    every = materialize(prefixes(conversations), "trie-prefixes")
    whole = materialize(sequences(every), "trie-sequences")
    paths = materialize(_along(every, whole.select("conv_id", "total", F.col("n_ends").alias("weight"),
                                                   F.col("depth").alias("length"))), "trie-paths")
    inner = paths.where("depth < length").select(*NODE).distinct()
    leaves = whole.join(inner, NODE, "left_anti").select("conv_id", F.col("depth").alias("length"))
    leaves = materialize(leaves, "trie-leaves")
    to_leaf = _along(paths.drop("length"), leaves)
    # A leaf's own nodes: those of which it is the least leaf.
    own = to_leaf.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.first("upto").alias("upto"),
                                     F.first("chars").alias("chars"))
    own = own.groupBy("conv_id").agg(F.min(F.struct("depth", "upto", "chars")).alias("k")).select(
        "conv_id", F.col("k.depth").alias("k"), (F.col("k.upto") - F.col("k.chars")).alias("before"))
    once = _along(paths.drop("length"), leaves.join(own, "conv_id")).groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_leaves"),
        F.sum(F.col("total") - F.greatest(F.col("before"), F.col("upto") - F.col("chars"))).alias("once"))
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.sum(F.col("weight") * (F.col("total") - F.col("upto") + F.col("chars"))).alias("copies"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2"))
    nodes = nodes.join(once, NODE).join(whole.select(*NODE, "ends_sha256"), NODE, "left")
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"),
                                                F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                           F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, ["depth", "q1", "q2"], "left").join(children, NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        (F.col("copies") - F.col("once")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def op13_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = f"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, role, text) AS turns FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, turns, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc_table[xor(c & 255, b) + 1])), 4294967295) % {HEADS} AS h FROM own, t),
seqs AS (SELECT h.conv_id, list_concat(CASE WHEN b.turns IS NULL THEN [] ELSE b.turns[1:h.h] END,
    h.turns[h.h + 1:]) AS seq FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % {BLOCK}),
pre AS (SELECT conv_id, seq[1:d] AS node, d FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM seqs)),
nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n,
    CASE WHEN d = 0 THEN 0 ELSE length(node[d].t) END AS chars FROM pre GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
up AS (SELECT node[1:a] AS node, chars, n, leaf FROM (
    SELECT nodes.node, chars, n, n_children IS NULL AS leaf, unnest(range(0, d + 1)) AS a
    FROM nodes LEFT JOIN kids ON kids.node = nodes.node)),
sub AS (SELECT node, sum((n - 1) * chars) AS saved, count(*) FILTER (WHERE leaf) AS n_leaves FROM up GROUP BY node),
ends AS (SELECT seq AS node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
    FROM seqs GROUP BY seq)
SELECT nodes.conv_id, nodes.d AS depth, p.conv_id AS parent_conv_id, nodes.n AS n_convs,
    coalesce(kids.n_children, 0) AS n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves,
    CAST(sub.saved AS BIGINT) AS saved_tokens, coalesce(ends.ends, sha256('')) AS ends_sha256
FROM nodes LEFT JOIN nodes p ON nodes.d > 0 AND p.node = nodes.node[1:nodes.d - 1] AND p.d = nodes.d - 1
    LEFT JOIN kids ON kids.node = nodes.node JOIN sub ON sub.node = nodes.node
    LEFT JOIN ends ON ends.node = nodes.node
"""
