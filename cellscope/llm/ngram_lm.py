r"""Operator 4: text scores under a word-pair language model in Elias-Fano tries.

Tokens are lower-cased words and one end per text.  Every training word is a class of its
own, however rare; words that no training text has share the class RARE.  With c the training
counts and P1 the add-half unigram over classes,

    P(v | u) = (c(u, v) + MU * P1(v)) / (c(u) + MU)             for classes u, v

``CLASSES`` can be set to bound the classes to the most frequent words; all others then share
RARE and are told apart inside it by (c(w) + 1) / (N_rare + V_rare + 1).

The pairs form a trie: a level of contexts with monotone pointers to their successors,
successors stored relative to the last one of the context before (so that the whole
level is one monotone sequence), both as Elias-Fano sequences, and 8-bit codes of the
quantised logarithms of P's numerators (the denominator is the context's alone and added
exactly).  Levels are written to a file and memory-mapped; a pair is found by successor search
inside its context's range.

How it spreads: word counts are combined in tasks, then by word.  Tasks hold the counts of
the ``TABLE`` most frequent words; any other word is known by its hash.  Pairs among the
``HOT`` most frequent classes (a table of fixed size) are counted beforehand and scored
where the text is, so a frequent pair is never sent anywhere.  Every other pair goes,
combined by document, to a shard, which counts it over all training rows, builds its parts of
the trie and answers for its pairs, one part after the other, with one row for each document: a pair whose successor is in the table to the shard that
the pair's hash names, any other to that of its successor.  Such a shard meets every
occurrence of the successor (each follows one token), so it knows c(v), and with it P1(v) and
the denominator that v gives as a context.  Per-document sums come back in one aggregation.

Cases: null, empty and blank texts are one end token; rows with null or repeated ids
are rows of their own (a null id's fold is that of the empty text); an empty table gives
no rows; without training rows every count is 0 and all scores are finite; other columns
are left aside.  Words count as equal when their hashes (64 bits, 63 outside the table) are.
"""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import Words, arrow_batches, documents, fold, map_batches, materialize, mix64

CLASSES = None          # most words that are classes of their own; None: all
TABLE = 65_000          # words whose counts every task holds
HOT = 512
MU = 500.0
FOLDS, HELD = 7, 2
SHARD_PAIRS = 2_500_000
PART_PAIRS = 850_000     # of a shard that are worked on at once
MIN_SHARDS = 32
SLICE_BYTES = 1 << 20         # bytes of text whose words a task holds as arrays at once
BOS, END, RARE, FIRST = 0, 1, 2, 3
_HASHED = np.uint64(1 << 63)     # marks the hash of a word outside the table

_LOCAL = np.dtype([("row", "<i8"), ("doc", "<i8"), ("named", "u1"), ("held", "u1"), ("tokens", "<i8"),
                   ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])


# --- Elias-Fano sequences and the trie ------------------------------------------------------

_POP = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)      # place of the k-th set bit of a byte, lowest first
for _b in range(256):
    for _k, _i in enumerate(i for i in range(8) if _b >> i & 1):
        _SELECT[_b, _k] = _i


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary with a rank directory."""

    def __init__(self, low, high, directory, width: int, n: int):
        self.low, self.high, self.directory, self.width, self.n = low, high, directory, width, n

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        width = max(0, (top // max(1, n)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        marks = np.zeros((top >> width) + n + 1, np.uint8)
        marks[(values >> width) + np.arange(n)] = 1
        high = np.packbits(marks, bitorder="little")
        high = np.append(high, np.zeros(-len(high) % 8 + 8, np.uint8))
        ones = _POP[high].reshape(-1, 8).sum(1)
        directory = np.append(0, np.cumsum(ones)).astype(np.uint32)
        return cls(np.append(low, np.zeros(8, np.uint8)), high, directory, width, n)

    def parts(self):
        return self.low, self.high, self.directory

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at the places i."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.directory, i, side="right") - 1
        left = i - self.directory[word].astype(np.int64)
        at = word * 8
        for _ in range(7):      # the byte of the word that holds the bit
            ones = _POP[self.high[at]].astype(np.int64)
            go = left >= ones
            if not go.any():
                break
            left = np.where(go, left - ones, left)
            at = at + go
        high = at * 8 + _SELECT[self.high[at], left].astype(np.int64) - i
        if not self.width:
            return high
        bit = i * self.width
        at, shift = bit >> 3, (bit & 7)
        low = np.zeros(len(i), np.int64)
        for k in range((self.width + 7) // 8 + 1):
            low |= self.low[at + k].astype(np.int64) << (8 * k)
        return (high << self.width) | ((low >> shift) & ((1 << self.width) - 1))


class Trie:
    """Contexts -> successors with quantised log probabilities, in memory-mapped levels."""

    def __init__(self, context: np.ndarray, successor: np.ndarray, logp: np.ndarray):
        """Pairs sorted by (context, successor)."""
        head = np.flatnonzero(np.append(True, context[1:] != context[:-1])[:len(context)])
        # Successors are stored on top of the last stored one of the context before.
        step = successor[np.append(head[1:], len(context))[:len(head)] - 1].astype(np.int64) + 1
        base = np.cumsum(step) - step
        stored = successor + np.repeat(base, np.diff(np.append(head, len(context))))
        self.codebook, codes = quantise(logp)
        levels = [EliasFano.build(context[head]), EliasFano.build(np.append(head, len(context))),
                  EliasFano.build(stored)]
        self.file = tempfile.TemporaryFile()
        arrays = [codes]
        for level in levels:
            arrays += level.parts()
        places, at = [], 0
        for a in arrays:
            self.file.write(b"\0" * (-at % 8))
            at += -at % 8
            places.append(at)
            self.file.write(a.tobytes())
            at += a.nbytes
        self.file.flush()
        self.bytes = at
        mapped = [np.memmap(self.file, a.dtype, "r", p, a.shape) if a.size else a
                  for a, p in zip(arrays, places)]
        self.codes = mapped[0]
        self.contexts, self.pointers, self.successors = (
            EliasFano(*mapped[1 + 3 * k:4 + 3 * k], level.width, level.n) for k, level in enumerate(levels))

    def find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Log probability of each pair; NaN where the trie lacks it."""
        out = np.full(len(context), np.nan)
        if not self.contexts.n or not len(context):
            return out
        # Queries come sorted: each context is looked up once.
        head = np.flatnonzero(np.append(True, context[1:] != context[:-1])[:len(context)])
        node = self._search(self.contexts, context[head], np.zeros(len(head), np.int64),
                            np.full(len(head), self.contexts.n, np.int64))
        there = node >= 0
        begin, end = np.zeros(len(head), np.int64), np.zeros(len(head), np.int64)
        begin[there], end[there] = self.pointers.get(node[there]), self.pointers.get(node[there] + 1)
        base = np.zeros(len(head), np.int64)
        inner = there & (begin > 0)
        base[inner] = self.successors.get(begin[inner] - 1) + 1
        times = np.diff(np.append(head, len(context)))
        ask = np.repeat(there, times)
        place = self._search(self.successors, (successor + np.repeat(base, times))[ask],
                             np.repeat(begin, times)[ask], np.repeat(end, times)[ask])
        found = np.flatnonzero(ask)[place >= 0]
        out[found] = self.codebook[self.codes[place[place >= 0]]]
        return out

    @staticmethod
    def _search(level: EliasFano, value, lo, hi) -> np.ndarray:
        """Place of each value in its range [lo, hi) of the level, or -1."""
        lo, stop = lo.copy(), hi
        hi = hi.copy()
        active = np.flatnonzero(lo < hi)
        while len(active):
            mid = (lo[active] + hi[active]) >> 1
            less = level.get(mid) < value[active]
            lo[active[less]] = mid[less] + 1
            hi[active[~less]] = mid[~less]
            active = active[lo[active] < hi[active]]
        out = np.full(len(value), -1, np.int64)
        inside = np.flatnonzero(lo < stop)
        same = inside[level.get(lo[inside]) == value[inside]] if len(inside) else inside
        out[same] = lo[same]
        return out


def quantise(x: np.ndarray, levels: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Codebook of bin means over equally filled bins, and the code of every value."""
    if not len(x):
        return np.zeros(1), np.zeros(0, np.uint8)
    edges = np.unique(np.quantile(x, np.linspace(0, 1, levels + 1)[1:-1]))
    codes = np.searchsorted(edges, x, side="right").astype(np.uint8)
    total = np.bincount(codes, x, minlength=len(edges) + 1)
    count = np.bincount(codes, minlength=len(edges) + 1)
    return total / np.maximum(count, 1), codes


# --- the model's shared numbers ---------------------------------------------------------------

class Counts:
    """Totals and the frequent words: all that every task holds (bounded by TABLE and HOT).

    ``limited``: words outside the table share RARE instead of being classes of their own.
    """

    def __init__(self, hashes, counts, n_words, n_distinct, n_texts, limited):
        order = np.lexsort((hashes, -counts))
        hashes, counts = hashes[order], counts[order]
        self.sorted = np.argsort(hashes)
        self.hashes = hashes[self.sorted]
        self.n = n_words + n_texts                      # N: training tokens
        self.v = n_distinct + (n_texts > 0)             # V
        self.n_texts = n_texts
        self.n_rare = n_words - int(counts.sum())
        self.v_rare = n_distinct - len(counts)
        self.limited = limited
        self.by_class = np.concatenate([[n_texts, n_texts, self.n_rare if limited else 0], counts]).astype(np.float64)
        shares = self.by_class + 0.5
        shares[BOS] = 0
        self.shares = shares.sum() + (0 if limited else self.n_rare + 0.5 * self.v_rare)
        self.p1 = shares / self.shares
        self.hot = None

    def classes(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), RARE, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.sorted[at] + FIRST, RARE)

    @property
    def n_hot(self) -> int:
        return min(len(self.by_class), HOT + FIRST)

    def keys(self, h: np.ndarray) -> np.ndarray:
        """What pairs know words by: their class, or their marked hash."""
        cls = self.classes(h).astype(np.uint64)
        return cls if self.limited else np.where(cls == RARE, h | _HASHED, cls)

    @staticmethod
    def log_top(count, p1):
        """Logarithm of the numerator of P(v | u)."""
        with np.errstate(divide="ignore"):      # a text's begin follows nothing
            return np.log10(count + MU * p1)

    @staticmethod
    def log_under(c):
        """Logarithm of the denominator that a context gives."""
        return np.log10(c + MU)

    def base(self, c):
        return np.log10((c + 1.0) / (self.n + self.v + 1.0))

    def inside_rare(self, c):
        return np.log10((c + 1.0) / (self.n_rare + self.v_rare + 1.0))


def _combined(hashes: list, counts: list):
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    head = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    return h[head], np.add.reduceat(c, head)


def _train_words(w: Words, train: np.ndarray) -> np.ndarray:
    return w.hashes[train[w.row]]


def word_counts(docs: DataFrame) -> DataFrame:
    """h, c: training counts by word hash."""
    def run(batches):
        import pyarrow as pa

        hashes, counts, held = [], [], 0
        for batch in arrow_batches(batches, "text", SLICE_BYTES):
            w = Words(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            h, c = np.unique(_train_words(w, train), return_counts=True)
            if not len(h):
                continue
            hashes.append(h)
            counts.append(c)
            held += len(h)
            if held > 1_500_000:
                h, c = _combined(hashes, counts)
                hashes, counts, held = [h], [c], len(h)
                if held > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])
                    hashes, counts, held = [], [], 0
        if hashes:
            h, c = _combined(hashes, counts)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

    return map_batches(docs.select("train", "text"), run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def learn(docs: DataFrame) -> Counts:
    counted = materialize(word_counts(docs), "lm-words")
    n_texts = docs.where("train").count()
    step = F.floor(F.log2("c") * 8)
    steps = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect()
    room, least = TABLE if CLASSES is None else CLASSES, None
    for r in sorted(steps, key=lambda r: -r.step):
        room -= r.n
        if room < 0:
            break
        least = r.step
    frequent = counted.where(step >= least).toArrow() if least is not None else None
    h = frequent["h"].to_numpy().view(np.uint64) if frequent is not None else np.zeros(0, np.uint64)
    c = frequent["c"].to_numpy() if frequent is not None else np.zeros(0, np.int64)
    model = Counts(h, c, sum(r.c for r in steps), sum(r.n for r in steps), n_texts, CLASSES is not None)
    model.hot = _hot_pairs(docs, model)
    return model


def _pairs(w: Words, model: Counts):
    """Pairs of all texts' keys: (row, context, successor), begin and end included."""
    n = np.diff(w.first)
    row = np.concatenate([np.arange(w.rows), w.row])
    place = np.concatenate([np.full(w.rows, -1), np.arange(len(w.hashes))])
    order = np.lexsort((place, row)) if w.rows else np.zeros(0, np.int64)
    seq = np.concatenate([np.full(w.rows, BOS, np.uint64), model.keys(w.hashes)])[order]
    row = row[order]
    after = np.append(seq[1:], np.uint64(BOS))
    after[after == BOS] = END       # what follows a text's last token
    return row, seq, after, n


def _hot_pairs(docs: DataFrame, model: Counts) -> np.ndarray:
    """Training counts of the pairs among the HOT first classes: a table of fixed size."""
    n = model.n_hot

    def run(batches):
        import pyarrow as pa

        table = np.zeros(n * n, np.int64)
        for batch in arrow_batches(batches, "text", SLICE_BYTES):
            row, u, v, _ = _pairs(Words(batch.column("text")), model)
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            take = (u < n) & (v < n) & train[row]
            table += np.bincount((u[take] * np.uint64(n) + v[take]).astype(np.int64), minlength=n * n)
        pair = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(table[pair])], ["pair", "c"])

    got = map_batches(docs.select("train", "text"), run, "pair long, c long").groupBy("pair").agg(
        F.sum("c").alias("c")).toArrow()
    table = np.zeros(n * n)
    table[got["pair"].to_numpy()] = got["c"].to_numpy()
    return table


# --- what texts send to the shards ---------------------------------------------------------

def _planes(x: np.ndarray) -> bytes:
    """Bytes by significance: runs of equal high bytes compress well in the shuffle."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _pack(u: np.ndarray, v: np.ndarray, ref: np.ndarray, times: np.ndarray) -> bytes:
    return b"".join([np.array([len(u)], np.int64).tobytes(), *map(_planes, (u, v, ref, times))])


def _unpack(raw, part: int):
    """u, v, ref, times of one of the packs that stand one behind the other in ``raw``."""
    for _ in range(part):
        raw = raw[8 + 24 * int(np.frombuffer(raw, np.int64, 1)[0]):]
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    cut = 8 + n * np.array([0, 8, 16, 20, 24])
    return [_unplanes(raw[a:b], t) for a, b, t in zip(cut, cut[1:], (np.uint64, np.uint64, np.uint32, np.uint32))]


def _combined_pairs(u: np.ndarray, v: np.ndarray, ref: np.ndarray):
    """Equal (u, v, ref) once, in order: (u, v, ref, times)."""
    order = np.lexsort((ref, v, u))
    u, v, ref = u[order], v[order], ref[order]
    head = np.flatnonzero(np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]) | (ref[1:] != ref[:-1]))[:len(u)])
    return u[head], v[head], ref[head], np.diff(np.append(head, len(u))).astype(np.uint32)


def _by_shard(u: np.ndarray, v: np.ndarray, ref: np.ndarray, times: np.ndarray, shards: int, parts: int,
              by_successor: bool):
    """Combined pairs cut by shard and, inside, by part: (shard, packs of all parts)."""
    hashed = mix64(v) if by_successor else mix64(u ^ mix64(v))
    cell = (hashed % np.uint64(shards) * np.uint64(parts) + hashed // np.uint64(shards) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cut = np.searchsorted(cell[order], np.arange(shards * parts + 1))
    for s in np.flatnonzero(np.diff(cut[::parts])):
        at = [order[a:b] for a, b in zip(cut[s * parts:], cut[s * parts + 1:(s + 1) * parts + 1])]
        yield int(s), b"".join(_pack(u[x], v[x], ref[x], times[x]) for x in at)


def _sender(model: Counts, shards: int, parts: int):
    """Rows of :func:`_send`.  Words are taken from a slice of a batch at a time; only combined pairs wait
    for the batch's end."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 36
        n_hot = model.n_hot
        # Numerators of the pairs of hot classes.
        hot = model.log_top(model.hot, np.tile(model.p1[:n_hot], n_hot))
        under = model.log_under(model.by_class)

        def worked_out(batch, first):
            """What a slice that begins with the batch's row ``first`` gives: its sums, pairs of both kinds."""
            w = Words(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            row, u, v, n = _pairs(w, model)
            here = (u < n_hot) & (v < n_hot)
            ref = ((first + np.arange(w.rows)) * 2 + train).astype(np.uint32)
            local = np.zeros(w.rows, _LOCAL)
            local["row"] = at + first + np.arange(w.rows)
            docs_ = batch.column("doc_id")
            local["named"] = docs_.is_valid().to_numpy(zero_copy_only=False)
            local["doc"] = docs_.fill_null(0).to_numpy(zero_copy_only=False)
            local["held"], local["tokens"] = ~train, n + 1
            of_hot = hot[(u[here] * np.uint64(n_hot) + v[here]).astype(np.int64)]
            local["score"] = np.bincount(row[here], of_hot, minlength=w.rows)
            held = u < _HASHED
            local["score"] -= np.bincount(row[held], under[u[held].astype(np.int64)], minlength=w.rows)
            cls = model.classes(w.hashes)
            known = cls >= FIRST
            count = model.by_class[cls[known]]
            local["known"] = np.bincount(w.row[known], minlength=w.rows) + (model.n_texts > 0)
            local["base"] = np.bincount(w.row[known], model.base(count), minlength=w.rows) + model.base(model.n_texts)
            rare = v >= _HASHED
            pairs = ~here & ~rare
            if model.limited:
                hashed = w.hashes[~known]
                alone = np.zeros(len(hashed), np.uint64), hashed, ref[w.row[~known]]
            else:
                alone = u[rare], v[rare], ref[row[rare]]
            return local, _combined_pairs(u[pairs], v[pairs], ref[row[pairs]]), _combined_pairs(*alone)

        for batch in arrow_batches(batches, "text"):
            found, first = [], 0
            for part in arrow_batches([batch], "text", SLICE_BYTES):
                found.append(worked_out(part, first))
                first += part.num_rows
            locals_, *kinds = zip(*found)
            found = None
            out = [(int(at // 4096 % shards), at, 2, b"".join(x.tobytes() for x in locals_))]
            while kinds:
                pairs = [np.concatenate(x) for x in zip(*kinds.pop())]
                out += [(s, at, len(kinds), raw) for s, raw in _by_shard(*pairs, shards, parts, len(kinds) == 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
                ["shard", "base", "kind", "payload"])
            at += batch.num_rows
    return run


def _send(docs: DataFrame, model: Counts, shards: int, parts: int) -> DataFrame:
    """shard, base, kind, payload.  Kinds: 0 pairs whose successor is a class of the table, 1 pairs
    whose successor is another word (with limited classes: such words alone), 2 sums worked out here."""
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "train", "text"),
        _sender(model, shards, parts), "shard int, base long, kind int, payload binary")


def _gather(sent, part: int):
    """A part's pairs sent to a shard: context, successor, row, whether it is a training row, times."""
    out = []
    for base, raw in sent:
        u, v, ref, times = _unpack(raw, part)
        out.append((u, v, base + (ref >> 1).astype(np.int64), (ref & 1).astype(bool), times))
    return [np.concatenate(x) for x in zip(*out)]


def _distinct(u, v, train, times):
    """Distinct pairs in order, each occurrence's place among them, training counts."""
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.append(True, (u[1:] != u[:-1]) | (v[1:] != v[:-1]))
    place = np.empty(len(u), np.int64)
    place[order] = np.cumsum(new) - 1
    u, v = u[new], v[new]
    return u, v, place, np.bincount(place, times * train, minlength=len(u))


def _sums(row, *values):
    order = np.argsort(row, kind="stable")
    head = np.flatnonzero(np.append(True, row[order][1:] != row[order][:-1]))
    return row[order][head], [np.add.reduceat(v[order], head) for v in values]


def pair_tops(u, v, counts, p1, model: Counts) -> np.ndarray:
    """Logarithms of the numerators of distinct pairs in order, out of a trie of those that the
    training rows have.  Its levels number the shard's contexts and successors."""
    context, successor = np.unique(u, return_inverse=True)[1], np.unique(v, return_inverse=True)[1]
    seen = counts > 0
    trie = Trie(context[seen], successor[seen], model.log_top(counts[seen], p1[seen]))
    found = trie.find(context, successor)
    return np.where(np.isnan(found), model.log_top(0, p1), found)


def _of_classes(u, v, row, train, times, model: Counts):
    """Rows and their known, base, score from a part's pairs of kind 0."""
    u, v, place, counts = _distinct(u, v, train, times)
    top = pair_tops(u, v, counts, model.p1[v.astype(np.int64)], model)
    rows, (score,) = _sums(row, top[place] * times)
    return rows, np.zeros(len(rows), np.int64), np.zeros(len(rows)), score


def _of_others(u, v, row, train, times, model: Counts):
    """The same from pairs of kind 1."""
    u, v, place, counts = _distinct(u, v, train, times)
    # All that precedes a word is here, so these are the word's own counts.
    word = np.unique(v, return_inverse=True)[1]
    c = np.bincount(word, counts)[word]
    if model.limited:
        score = model.inside_rare(c)
    else:
        score = pair_tops(u, v, counts, (c + 0.5) / model.shares, model) - model.log_under(c)
    rows, sums = _sums(
        row, (c[place] > 0) * times.astype(np.int64), model.base(c)[place] * times, score[place] * times)
    return rows, *sums


def _answer(model: Counts, n_parts: int):
    """Per-document sums of one shard."""
    def run(table):
        import pyarrow as pa

        kinds = {0: [], 1: [], 2: []}
        for base, kind, raw in zip(table["base"].to_pylist(), table["kind"].to_pylist(), table["payload"]):
            kinds[kind].append((base, memoryview(raw.as_buffer())))
        out = None
        for kind, answered in ((0, _of_classes), (1, _of_others)):
            for part in range(n_parts) if kinds[kind] else ():
                pairs = _gather(kinds[kind], part)
                if len(pairs[0]):
                    more = answered(*pairs, model)
                    if out:
                        row, sums = _sums(*(np.concatenate(x) for x in zip(out, more)))
                        more = row, *sums
                    out = more
        parts = [pa.table({"row": pa.array(r), "doc_id": pa.nulls(len(r), pa.int64()),
                           "held_out": pa.nulls(len(r), pa.bool_()), "n_tokens": pa.nulls(len(r), pa.int64()),
                           "n_known": pa.array(k), "base_score": pa.array(b), "score": pa.array(s)})
                 for r, k, b, s in ([out] if out else [])]
        for _, raw in kinds[2]:
            x = np.frombuffer(raw, _LOCAL)
            parts.append(pa.table({
                "row": pa.array(x["row"]), "doc_id": pa.array(x["doc"], mask=x["named"] == 0),
                "held_out": pa.array(x["held"].astype(bool)), "n_tokens": pa.array(x["tokens"]),
                "n_known": pa.array(x["known"]), "base_score": pa.array(x["base"]), "score": pa.array(x["score"])}))
        return pa.concat_tables(parts)

    return run


def score(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select("doc_id", (fold(F.col("doc_id"), FOLDS) != HELD).alias("train"), "text")
    model = learn(docs)
    shards = max(MIN_SHARDS, -(-int(model.n) // SHARD_PAIRS))
    parts = max(1, -(-int(model.n) // (shards * PART_PAIRS)))
    sent = _send(docs, model, shards, parts)
    sums = sent.groupBy("shard").applyInArrow(
        _answer(model, parts), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "base_score double, score double")
    out = sums.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known",
                      F.lit(int(model.n)).cast("long").alias("train_tokens"), "base_score", "score")


def op4_ngram_lm(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
