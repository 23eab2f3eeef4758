r"""Operator 9: near-duplicate groups by a parity-sketch join.

A document is the set of its distinct 4-word shingles (64-bit hashes).  Sets A and B
link when 100 |A & B| >= 85 |A | B|, which bounds their symmetric difference by
d = floor(3 (|A| + |B|) / 37).

* Sketch: the hash space is cut into k parts and the shingles of each part are XORed
  into one 64-bit word.  A shingle in one set only changes one part, so two linked sets
  differ in d parts at most; k is greater than d, so some part is equal (pigeonhole).
  k and d depend on a size band; a document takes part in its own band and, if it can
  have a larger partner there, in the next.  Empty parts carry no information and are
  left out unless they are so many that the pigeonhole needs them.
* A parity sketch of 1024 bits (each shingle flips one) bounds the symmetric difference
  from below by its Hamming distance and rejects most pairs before their sets are read.
* Equal sets count as one node.  Of the documents that share a part, each is paired
  with the smallest (a star, not all pairs).  Pairs are verified on whole sets, their
  groups found; two rounds do the same with one member of each group that shares a part;
  a last one pairs what still shares a part across groups, so that no link is lost.

Hot keys: equal parts are combined inside each batch before the shuffle; equal sets
collapse first.

Rows are known by two hashes of id and text, not by the id, so rows without one are nodes
like others.

Cases: null, empty and blank texts have no shingles, link with nothing and keep their
own id; fewer than four words count as one shingle; equal texts link; rows without an id
link like others and take the smallest id of their group, null if it has none; rows that
repeat an id are judged by their own text; an empty table gives no rows; other columns are
left aside.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import Words, among, arrow_batches, documents, map_batches, materialize, mix64, release
from cellscope.llm.components import components

WIDTH = 4
NUM, DEN = 85, 100          # links: DEN * intersection >= NUM * union
SKETCH_WORDS = 16           # 64-bit words of the parity sketch
BAND_RATIO = 1.3
COMMON_TURNS = 2            # star rounds over groups before the last comparison


def most_apart(size_sum):
    """Largest symmetric difference of two linked sets, by the sum of their sizes."""
    return (DEN - NUM) * size_sum // (DEN + NUM)


def _bands(limit: int) -> np.ndarray:
    """Lower bounds of the size bands up to ``limit``; below the first only equal sets link."""
    low = 2
    while most_apart(2 * low + 1) < 1:
        low += 1
    bounds = [low]
    while bounds[-1] <= limit:
        bounds.append(max(bounds[-1] + 1, int(np.ceil(bounds[-1] * BAND_RATIO))))
    return np.array(bounds + [max(bounds[-1] + 1, int(np.ceil(bounds[-1] * BAND_RATIO)))])


def _parts(bands: np.ndarray, b: int) -> tuple[int, int]:
    """(k, d) of band b."""
    d = int(most_apart(2 * (int(bands[b + 1]) - 1)))
    return d + 2 + (d * 6 + 99) // 100, d


def shingle_sets(texts):
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts)
    h, n = w.hashes, len(w.hashes)
    with np.errstate(over="ignore"):
        if n >= WIDTH:
            acc = np.zeros(n - WIDTH + 1, np.uint64)
            for j in range(WIDTH):
                acc = mix64(acc + h[j:n - WIDTH + 1 + j] + np.uint64(j + 1))
        else:
            acc = np.zeros(0, np.uint64)
        for r in range(w.rows):
            a, b = int(w.first[r]), int(w.first[r + 1])
            if b - a >= WIDTH:
                yield np.unique(acc[a:b - WIDTH + 1])
            elif b > a:
                one = np.uint64(b - a)
                for x in h[a:b]:
                    one = mix64(np.array([one * np.uint64(31) + x]))[0]
                yield np.array([one], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def signature(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit fingerprints of a set."""
    m = mix64(s + np.uint64(0x1234567))
    return int(np.bitwise_xor.reduce(m).astype(np.int64)), int(np.add.reduce(mix64(m)).astype(np.int64))


def parity(s: np.ndarray) -> np.ndarray:
    bits = np.bincount((s & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def part_keys(s: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Join keys of a set: one for each part of its sketch, in each band it takes part in."""
    n = len(s)
    if n < bands[0]:
        return np.zeros(0, np.uint64)
    own = int(np.searchsorted(bands, n, side="right")) - 1
    out = []
    for b in (own, own + 1):
        if b > own and n * DEN < NUM * int(bands[b]):
            continue
        k, d = _parts(bands, b)
        # Part j holds the hashes from edges[j] on; the set is sorted.
        edges = (np.arange(k, dtype=np.uint64) * np.uint64((1 << 64) // k))
        at = np.searchsorted(s, edges)
        filled = np.diff(np.append(at, n)) > 0
        xors = np.zeros(k, np.uint64)
        xors[filled] = np.bitwise_xor.reduceat(s, at[filled])
        names = mix64(np.arange(k, dtype=np.uint64) + np.uint64((b + 1) << 32))
        keys = mix64(xors + names)
        out.append(keys if k - int(filled.sum()) >= k - d else keys[filled])
    return np.concatenate(out)


def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, id, n (set size), s1, s2 (fingerprints), q0.. (parity sketch)."""
    kind = dict(docs.dtypes)

    def run(batches):
        import pyarrow as pa

        for batch in arrow_batches(batches, "text"):
            rows = []
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column("text")):
                    rows.append((len(s), *signature(s), *parity(s).tolist()))
            cols = [batch.column("doc_id"), batch.column("id"), *(pa.array(c, pa.int64()) for c in zip(*rows))]
            yield pa.RecordBatch.from_arrays(cols, names)

    names = ["doc_id", "id", "n", "s1", "s2", *(f"q{i}" for i in range(SKETCH_WORDS))]
    return map_batches(docs.select("doc_id", "id", "text"),
        run, f"doc_id {kind['doc_id']}, id {kind['id']}, " + ", ".join(f"{c} long" for c in names[2:]))


def keys_of(docs: DataFrame, largest: int) -> DataFrame:
    """key, s1, hub: the part keys of all sets.  Where several sets of a batch share a key,
    only the smallest s1 stands for the key (hub null); the others name it as hub."""
    bands = _bands(largest)

    def run(batches):
        import pyarrow as pa

        for batch in arrow_batches(batches, "text"):
            keys, sigs, seen = [], [], set()
            with np.errstate(over="ignore"):
                for s in shingle_sets(batch.column("text")):
                    if len(s) < bands[0]:
                        continue
                    s1 = signature(s)[0]
                    if s1 in seen:
                        continue
                    seen.add(s1)
                    k = part_keys(s, bands)
                    keys.append(k)
                    sigs.append(np.full(len(k), s1, np.int64))
            if not keys:
                continue
            key, sig = np.concatenate(keys).view(np.int64), np.concatenate(sigs)
            order = np.lexsort((sig, key))
            key, sig = key[order], sig[order]
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            hub = np.repeat(sig[head], np.diff(np.append(head, len(key))))
            is_head = np.zeros(len(key), bool)
            is_head[head] = True
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(sig), pa.array(hub, mask=is_head)], ["key", "s1", "hub"])

    return map_batches(docs.select("text"), run, "key long, s1 long, hub long")


def shared_parts(keys: DataFrame) -> DataFrame:
    """key, s1, hub for every set that shares a key with a smaller one (its hub)."""
    # Combined rows already have a hub: they are dealt by set, so a hot key isn't dealt to one task.
    dealt = keys.repartition(F.when(F.col("hub").isNull(), F.col("key")).otherwise(F.col("s1"))) \
        .sortWithinPartitions("key", "s1")

    def run(batches):
        import pyarrow as pa

        last_key = last_hub = last_sig = None
        for batch in batches:
            key, sig = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "s1"))
            local = batch.column("hub").is_valid().to_numpy(zero_copy_only=False)
            if local.any():
                yield batch.filter(pa.array(local))
            key, sig = key[~local], sig[~local]
            if not len(key):
                continue
            new = np.append(key[0] != last_key, key[1:] != key[:-1])
            head = np.flatnonzero(new)
            hub = np.full(len(key), 0 if last_hub is None else last_hub, np.int64)
            if len(head):
                hub[head[0]:] = np.repeat(sig[head], np.diff(np.append(head, len(key))))
            again = np.append(not new[0] and sig[0] == last_sig, ~new[1:] & (sig[1:] == sig[:-1]))
            member = ~new & ~again & (sig != hub)
            last_key, last_hub, last_sig = key[-1], hub[-1], sig[-1]
            if member.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[member]) for x in (key, sig, hub)], ["key", "s1", "hub"])

    return map_batches(dealt, run, "key long, s1 long, hub long")


def may_link(a: str, b: str):
    """Size and Hamming bounds on two class rows with column prefixes a and b."""
    total = F.col(f"{a}n") + F.col(f"{b}n")
    apart = sum((F.bit_count(F.col(f"{a}q{i}").bitwiseXOR(F.col(f"{b}q{i}"))) for i in range(SKETCH_WORDS)),
                F.lit(0))
    small, large = F.least(f"{a}n", f"{b}n"), F.greatest(f"{a}n", f"{b}n")
    return (small * DEN >= large * NUM) & (apart <= F.floor(total * (DEN - NUM) / F.lit(float(DEN + NUM))))


def _side(classes: DataFrame, p: str) -> DataFrame:
    return classes.select(*[F.col(c).alias(p + c) for c in classes.columns])


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, s1 and the whole set (sorted 64-bit hashes as bytes) of the wanted documents."""
    kind = dict(docs.dtypes)["doc_id"]
    wanted = materialize(wanted.select(F.col("rep").alias("doc_id")).distinct(), "jac-wanted")
    some = among(docs.select("doc_id", "text"), "doc_id", wanted, "doc_id").join(wanted, "doc_id", "left_semi")

    def run(batches):
        import pyarrow as pa

        seen = set()        # equal rows have one name; one of them is enough
        for batch in arrow_batches(batches, "text"):
            new = [i for i, d in enumerate(batch.column("doc_id").to_pylist()) if not (d in seen or seen.add(d))]
            batch = batch.take(pa.array(new, pa.int64()))
            if not batch.num_rows:
                continue
            with np.errstate(over="ignore"):
                sets = list(shingle_sets(batch.column("text")))
                sigs = [signature(s)[0] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sigs, pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["rep", "s1", "shingles"])

    return map_batches(some, run, f"rep {kind}, s1 long, shingles binary")


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, as1, b, bs1) those whose whole sets link: (a, b)."""
    pairs = materialize(pairs, "jac-verify")
    left = among(sets, "rep", pairs, "a").select(
        F.col("rep").alias("a"), F.col("s1").alias("as1"), F.col("shingles").alias("x"))
    right = among(sets, "rep", pairs, "b").select(
        F.col("rep").alias("b"), F.col("s1").alias("bs1"), F.col("shingles").alias("y"))
    both = pairs.join(left, ["a", "as1"]).join(right, ["b", "bs1"]).select("a", "b", "x", "y")

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in arrow_batches([whole], "x"):
                keep = []
                for x, y in zip(batch.column("x"), batch.column("y")):
                    x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(DEN * same >= NUM * (len(x) + len(y) - same))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = dict(both.dtypes)["a"]
    return map_batches(both, run, f"a {kind}, b {kind}")


def _regroup(labels: DataFrame, found: DataFrame) -> DataFrame:
    """labels (rep, comp) after merging the groups that ``found`` (a, b: comps) links."""
    found = materialize(found, "jac-links")
    if not found.take(1):
        return labels
    merged = components(found)
    if merged is None:
        return labels
    out = labels.join(merged.select(F.col("node").alias("comp"), "label"), "comp", "left")
    return materialize(out.select("rep", "s1", F.coalesce("label", "comp").alias("comp")), "jac-groups")


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    row = [F.col("doc_id"), F.col("text"), F.isnull("doc_id")]
    name = F.concat(F.hex(F.xxhash64(*row)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *row)))
    docs = docs.select(name.alias("doc_id"), F.col("doc_id").alias("id"), "text")
    sets = materialize(sets_of(docs), "jac-sets")
    docs = docs.drop("id")
    sketch = [f"q{i}" for i in range(SKETCH_WORDS)]
    classes = materialize(sets.where("n > 0").groupBy("n", "s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.min("id").alias("id"), *[F.min(q).alias(q) for q in sketch]), "jac-classes")
    largest = classes.agg(F.max("n")).first()[0] or 0
    shared = materialize(shared_parts(keys_of(docs, largest)), "jac-shared")
    release(docs.sparkSession)
    named = classes.drop("s2", "id")
    # Every member with each of its hubs once; votes: the parts they share.
    stars = shared.groupBy("s1", "hub").agg(F.count(F.lit(1)).alias("votes"))
    a, b = _side(named, "a"), _side(named, "b")
    stars = stars.join(a, stars.s1 == a.as1).join(b, stars.hub == b.bs1).where(may_link("a", "b"))
    stars = materialize(stars.select(F.col("arep").alias("a"), "as1", F.col("brep").alias("b"), "bs1", "votes")
                        .where("a <> b"), "jac-stars")
    nodes = materialize(shared.select("s1").union(shared.select(F.col("hub").alias("s1"))).distinct()
                        .join(named, "s1"), "jac-nodes")
    if not nodes.take(1):
        labels = nodes.select("rep", "s1", F.col("rep").alias("comp"))
    else:
        labels = _link_all(docs, shared, stars, nodes)
    comp = labels.groupBy("rep").agg(F.min("comp").alias("comp"))
    per_class = classes.select("n", "s1", "s2", "rep", "id").join(comp, "rep", "left").select(
        "n", "s1", "s2", "id", F.coalesce("comp", "rep").alias("comp"))
    least = per_class.groupBy("comp").agg(F.min("id").alias("component_id"))
    per_class = per_class.select("n", "s1", "s2", "comp").join(least, "comp").drop("comp")
    out = sets.select("id", "n", "s1", "s2").join(per_class, ["n", "s1", "s2"], "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _link_all(docs: DataFrame, shared: DataFrame, stars: DataFrame, nodes: DataFrame) -> DataFrame:
    named = nodes
    whole = materialize(whole_sets(docs, _reps(stars)), "jac-whole")
    release(docs.sparkSession)
    labels = nodes.select("rep", "s1", F.col("rep").alias("comp"))
    # 1. Each member with the hub it shares most parts with.
    best = stars.groupBy("a", "as1").agg(F.max_by(F.struct("b", "bs1"), F.struct("votes", "b")).alias("h"))
    found = links(best.select("a", "as1", "h.b", "h.bs1"), whole)
    labels = _regroup(labels, found)
    # 2. The other hubs, where they are still in another group.
    label_a = labels.select(F.col("rep").alias("a"), F.col("s1").alias("as1"), F.col("comp").alias("ca"))
    label_b = labels.select(F.col("rep").alias("b"), F.col("s1").alias("bs1"), F.col("comp").alias("cb"))
    rest = stars.join(label_a, ["a", "as1"]).join(label_b, ["b", "bs1"]).where("ca <> cb")
    found = links(rest.select("a", "as1", "b", "bs1"), whole)
    labels = _regroup(labels, _as_groups(found, labels))
    # 3. Parts that several groups share: one member of each group (another one each time)
    # with one of the first group.
    members = materialize(shared.select("key", "s1").union(
        shared.select("key", F.col("hub").alias("s1"))).distinct(), "jac-members")
    for turn in range(COMMON_TURNS):
        rows = _open_parts(members, labels)
        one = rows.groupBy("key", "comp").agg(F.min_by("s1", F.xxhash64("s1", F.lit(turn))).alias("s1"))
        hub = one.groupBy("key").agg(F.min_by("s1", "comp").alias("hub"))
        pairs = one.join(hub, "key").where("s1 <> hub").select("s1", "hub").distinct()
        a, b = _side(named, "a"), _side(named, "b")
        pairs = pairs.join(a, pairs.s1 == a.as1).join(b, pairs.hub == b.bs1).where(may_link("a", "b")).select(
            F.col("arep").alias("a"), "as1", F.col("brep").alias("b"), "bs1")
        pairs = materialize(pairs, "jac-common")
        if not pairs.take(1):
            break
        labels = _regroup(labels, _as_groups(links(pairs, whole_sets(docs, _reps(pairs))), labels))
    # 4. Whatever still shares a part across groups is compared.
    rows = _open_parts(members, labels).join(named, "s1")
    x, y = _side(rows, "a"), _side(rows, "b")
    pairs = x.join(y, (F.col("akey") == F.col("bkey")) & (F.col("arep") < F.col("brep"))
                   & (F.col("acomp") != F.col("bcomp")) & may_link("a", "b"))
    pairs = materialize(pairs.select(F.col("arep").alias("a"), "as1", F.col("brep").alias("b"), "bs1").distinct(),
                        "jac-pairs")
    if not pairs.take(1):
        return labels
    return _regroup(labels, _as_groups(links(pairs, whole_sets(docs, _reps(pairs))), labels))


def _reps(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep")))


def _open_parts(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, s1, comp of the parts whose members are in more than one group."""
    rows = members.join(labels.select("s1", "comp"), "s1")
    mixed = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    return materialize(rows.join(mixed.select("key"), "key"), "jac-open")


def _as_groups(found: DataFrame, labels: DataFrame) -> DataFrame:
    comp = labels.groupBy("rep").agg(F.min("comp").alias("comp"))
    ca = comp.select(F.col("rep").alias("a"), F.col("comp").alias("ca"))
    cb = comp.select(F.col("rep").alias("b"), F.col("comp").alias("cb"))
    return found.join(ca, "a").join(cb, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return groups(documents(spark, sf_dir))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sig AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM s GROUP BY doc_id),
rep AS (SELECT min(doc_id) AS r, k FROM sig GROUP BY k),
c AS (SELECT s.g, s.doc_id, n.n, count(*) OVER (PARTITION BY s.g) AS df FROM s
  JOIN rep ON rep.r = s.doc_id JOIN n ON n.doc_id = s.doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m
  FROM c a JOIN c b ON a.g = b.g AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85
  GROUP BY 1, 2),
e AS (SELECT a, b FROM i WHERE 100 * m >= 85 * (na + nb - m)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(x, y) AS (SELECT r, r FROM rep UNION SELECT reach.x, e2.b FROM reach JOIN e2 ON e2.a = reach.y),
comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(comp.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN sig ON sig.doc_id = d.doc_id
LEFT JOIN rep ON rep.k = sig.k LEFT JOIN comp ON comp.x = rep.r
"""
