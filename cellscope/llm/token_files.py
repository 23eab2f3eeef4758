"""Token ids of documents in compressed binary files, and back (op12).

Writing: documents are dealt in ascending order of their id (a range exchange), tokenised, and
the ids of a partition become one file of frames.  A frame holds up to FRAME_IDS ids of
documents one after the other (a long document runs on into the next frame), cut into equal
blocks: the lanes that :mod:`cellscope.llm.id_coder` codes in step, each with its own payload and
checksum, by one model that starts afresh in every frame.  Frames are rows of a Parquet file
(file, frame, first, n_ids, data), so that Spark's committer publishes them.

A frame's ``data``, all little-endian::

    magic "TIDS", version u16, -            8 bytes
    vocabulary, parts, ids, ids of a block, blocks: 5 x u32
    for each part (a document or a piece of one):
        known u8 (0: its id is null), doc_id i64, ids of the document u64,
        ids of it in earlier frames u64, ids here u32     (column by column)
    for each block: payload words u32, crc32 of its ids as u32 words u32
    crc32 of all the above u32
    payloads, words of 20 bits, two in five bytes

Reading checks every checksum and returns whole documents; any frame can be read alone.

Tokenising: a text is cut where the vocabulary's pattern must cut it whatever stands around
(:func:`cuts`), equal pieces of a batch are found by packing them into words, and only pieces
that the worker hasn't met are given to the tokenizers library.  The ids are the library's, as
the tests hold.

Cases: null text is empty and has the end id alone; null ids come first; rows of equal id are
ordered by a hash of the text; equal rows are documents of their own; an empty table gives no
files' rows and no result; further columns are ignored; a vocabulary of more than 65,536
ids is refused.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscope.llm import id_coder
from cellscope.llm.common import arrow_batches, documents, map_batches, materialize, mix64, utf8
from cellscope.llm.packing import SHORT, packed
from cellscope.session import scratch_path

END = 0
FRAME_IDS = 1 << 22
LANES = 1 << 13         # most blocks of a frame
LEAST_BLOCK = 256       # ids
JOINED = 1 << 10        # bytes of pieces given to the library as one text
KNOWN = 1 << 20         # pieces that a worker remembers (about 60 bytes each)

MAGIC, VERSION = b"TIDS", 3
_HEAD = "<4sHH5I"
_PART = (("known", "u1"), ("doc_id", "<i8"), ("whole", "<u8"), ("earlier", "<u8"), ("here", "<u4"))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SOLID = np.zeros(256, bool)        # surely no white space
_SOLID[0x21:0x7F] = True
_BEFORE = _SOLID.copy()             # surely no white space and no beginning of a special string
_BEFORE[ord("<")] = False
_BEFORE[0x80:] = True
_BEFORE[[0xC2, 0xE1, 0xE2, 0xE3]] = False       # bytes that white space beyond ASCII begins with
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b",.;:!?")] = True
# A byte's kinds as bits; what must stand before a space and a stop is one bit higher than these.
_KINDS = (_SPACE | _SOLID * 2 | _STOP * 4 | _LETTER * 8 | _BEFORE * 16).astype(np.uint8).tobytes()


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of pieces that byte-level BPE's usual pattern tokenises alike alone and in the
    text: white space after something solid; the last white space before something solid; a
    stop after a letter.  Other places may be safe too, but aren't known to be from two bytes."""
    kind = np.frombuffer(data.tobytes().translate(_KINDS), np.uint8)
    begin = np.zeros(len(data) + 1, np.uint8)
    begin[1:-1] = kind[:-1] >> 1 & kind[1:] & 5
    # A row's last byte has nothing after it.
    last = offsets[1:-1] - 1
    last = last[last > 0]
    ends = begin[last]
    begin[1:-2] |= kind[2:] >> 4 & kind[1:-1]
    begin[last] = ends
    begin[offsets] = 1
    return np.flatnonzero(begin[:-1] != 0)


class Pieces:
    """Ids of a batch's texts, from the library's ids of distinct pieces.

    Pieces of up to SHORT bytes are remembered by their two words in the order in which they
    came; a 64-bit hash of the words, kept sorted, leads to their place, and the words are
    compared, so a piece is never taken for another.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        # Bytes of every id: byte-level vocabularies write a byte as one character.
        self.bytes = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for token, i in tokenizer.get_vocab().items():
            self.bytes[i] = len(token)
        self.hash, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        # By place, with room for more: a piece's words, its ids' places in flat, whether it was met again.
        self.high, self.low, self.begin, self.count, self.again = (
            np.zeros(1 << 10, t) for t in (np.uint64, np.uint64, np.int64, np.int64, bool))
        self.flat = np.zeros(0, np.uint16)

    def _forget(self) -> None:
        """Keeps the pieces that were met again since the last time, if that leaves half the room."""
        if 2 * int(self.again.sum()) > KNOWN:
            self.again[:] = False
        kept = np.flatnonzero(self.again)
        there = self.again[self.place]
        self.hash = self.hash[there]
        self.place = np.searchsorted(kept, self.place[there]).astype(np.int32)
        self.high, self.low, begin, self.count = (c[kept] for c in (self.high, self.low, self.begin, self.count))
        upto = np.cumsum(self.count)
        self.begin = upto - self.count
        self.flat = self.flat[np.repeat(begin - self.begin, self.count) + np.arange(int(self.count.sum()))]
        self.again = np.zeros(len(kept), bool)

    def _library(self, data, start, length) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of pieces one after the other, and how many each has.

        Pieces that begin with white space and end with something solid can stand one behind
        the other in one text (see :func:`cuts`); the ids' bytes tell whose they are.
        """
        joined = _SPACE[data[start]] & _SOLID[data[start + length - 1]] & (length > 1)
        count = np.empty(len(start), np.int64)
        both = []
        for some in (np.flatnonzero(joined), np.flatnonzero(~joined)):
            n = length[some]
            end = np.cumsum(n)
            text = data[np.repeat(start[some] - (end - n), n) + np.arange(int(end[-1]) if len(n) else 0)].tobytes()
            # Texts of JOINED bytes or a single piece.
            last = np.arange(1, len(some) + 1)
            if len(both) == 0 and len(some):
                last = np.append(np.flatnonzero(np.diff(end // JOINED)) + 1, len(some))
            edges = [0, *end[last - 1].tolist()] if len(some) else [0]
            texts = [text[a:b].decode() for a, b in zip(edges, edges[1:])]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.fromiter(chain.from_iterable(found), np.uint16, sum(map(len, found)))
            if len(both):
                count[some] = np.fromiter(map(len, found), np.int64, len(found))
            else:
                upto = np.searchsorted(np.cumsum(self.bytes[ids]), end, side="right")
                count[some] = np.diff(upto, prepend=0)
            both.append(ids)
        # Back in the pieces' own order.
        place = np.empty(len(start), np.int64)
        place[np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])] = np.arange(len(start))
        ids, here = np.concatenate(both), np.empty(len(start), np.int64)
        here[place] = count
        begin = (np.cumsum(here) - here)[place]
        upto = np.cumsum(count)
        return ids[np.repeat(begin - (upto - count), count) + np.arange(int(upto[-1]) if len(upto) else 0)], count

    def _lookup(self, hashed, high, low) -> tuple[np.ndarray, np.ndarray]:
        """Places of pieces among those known, and which are known."""
        at = np.zeros(len(hashed), np.int64)
        if not len(self.hash):
            return at, np.zeros(len(hashed), bool)
        order = np.argsort(hashed)      # neighbours are looked up one after the other
        at[order] = self.place[np.minimum(np.searchsorted(self.hash, hashed[order]), len(self.hash) - 1)]
        return at, (self.high[at] == high) & (self.low[at] == low)

    def _learn(self, hashed, high, low, pieces) -> np.ndarray:
        """Places of pieces that weren't known."""
        flat, count = self._library(*pieces)
        begin = len(self.flat) + np.cumsum(count) - count
        self.flat = np.concatenate([self.flat, flat])
        n = len(self.hash)
        if n + len(count) > len(self.high):
            more = np.zeros(max(n, len(count)), np.int8)
            self.high, self.low, self.begin, self.count, self.again = (
                np.concatenate([c, more.astype(c.dtype)]) for c in (self.high, self.low, self.begin, self.count, self.again))
        for column, values in ((self.high, high), (self.low, low), (self.begin, begin), (self.count, count)):
            column[n:n + len(count)] = values
        order = np.argsort(hashed)
        # Behind an equal hash: the piece that came first is found, the other is learned whenever it comes.
        upto = np.searchsorted(self.hash, hashed[order], side="right")
        self.hash = np.insert(self.hash, upto, hashed[order])
        self.place = np.insert(self.place, upto, n + order)
        return np.arange(n, n + len(count))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by END, and every text's number of ids."""
        import pandas as pd

        raw, offsets = utf8(texts)
        data, rows = np.ascontiguousarray(raw), len(offsets) - 1
        start = cuts(data, offsets)
        length = np.diff(np.append(start, len(data)))
        short = length <= SHORT
        if len(data) and not data.all():       # packed pieces can't hold the byte 0
            short &= np.add.reduceat(data == 0, start, dtype=np.int64) == 0
        where = np.flatnonzero(short)
        high, low = packed(data, start[where], length[where])
        code, hashed = pd.factorize(high ^ mix64(low))
        first = np.empty(len(hashed), np.int64)
        first[code[::-1]] = np.arange(len(where))[::-1]
        # Pieces that aren't the first one of their hash, and those below, go to the library by themselves.
        alone = [np.flatnonzero(~short), where[(high != high[first][code]) | (low != low[first][code])]]
        keys = hashed, high[first], low[first]
        at, known = self._lookup(*keys)
        self.again[at[known]] = True
        if len(self.hash) + int((~known).sum()) > KNOWN:
            self._forget()
            at, known = self._lookup(*keys)
            self.again[at[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            here = where[first[new]]
            at[new] = self._learn(*(k[new] for k in keys), (data, start[here], length[here]))
        size, begin = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        size[where], begin[where] = self.count[at][code], self.begin[at][code]
        rest, flat = np.unique(np.concatenate(alone)), self.flat
        if len(rest):
            others, count = self._library(data, start[rest], length[rest])
            size[rest], begin[rest] = count, len(flat) + np.cumsum(count) - count
            flat = np.concatenate([flat, others])
        # The end id of each text is one more piece.
        of_row = np.searchsorted(start, offsets)
        size = np.insert(size, of_row[1:], 1)
        begin = np.insert(begin, of_row[1:], len(flat))
        flat = np.append(flat, np.uint16(END))
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        return ids, np.diff(upto[of_row + np.arange(rows + 1)])


_KEPT: dict[str, Pieces] = {}


def pieces_of(vocabulary: str) -> Pieces:
    """The pieces that this process knows of a vocabulary (the text of its file): Spark's Python
    workers run many tasks, which need not give the library the same pieces again."""
    if vocabulary not in _KEPT:
        from tokenizers import Tokenizer

        _KEPT.clear()
        _KEPT[vocabulary] = Pieces(Tokenizer.from_str(vocabulary))
    return _KEPT[vocabulary]


def write_frame(ids: np.ndarray, parts: dict[str, np.ndarray], vocabulary: int) -> bytes:
    """``parts`` has the columns of _PART."""
    blocks = max(1, min(LANES, -(-len(ids) // LEAST_BLOCK)))
    length = -(-len(ids) // blocks)
    blocks = -(-len(ids) // length)
    lanes = np.zeros((blocks, length), np.int32)
    lanes.ravel()[:len(ids)] = ids
    words, count = id_coder.encode(np.ascontiguousarray(lanes.T), vocabulary)
    crc = [zlib.crc32(row) for row in lanes.astype("<u4")]
    head = b"".join([
        struct.pack(_HEAD, MAGIC, VERSION, 0, vocabulary, len(parts["here"]), len(ids), length, blocks),
        *[np.asarray(parts[name]).astype(kind).tobytes() for name, kind in _PART],
        count.astype("<u4").tobytes(), np.array(crc, "<u4").tobytes()])
    return head + struct.pack("<I", zlib.crc32(head)) + id_coder.pack(words)


def read_frame(data: bytes) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The ids of a frame as little-endian uint32 and its parts."""
    if len(data) < struct.calcsize(_HEAD) or data[:4] != MAGIC:
        raise ValueError("not a frame of token ids")
    _, version, _, vocabulary, n_parts, n_ids, length, blocks = struct.unpack_from(_HEAD, data)
    if version != VERSION:
        raise ValueError(f"frame of version {version}")
    at, parts = struct.calcsize(_HEAD), {}
    for name, kind in [*_PART, ("words", "<u4"), ("crc", "<u4")]:
        n = blocks if name in ("words", "crc") else n_parts
        parts[name] = np.frombuffer(data, kind, n, at)
        at += parts[name].nbytes
    if zlib.crc32(data[:at]) != struct.unpack_from("<I", data, at)[0]:
        raise ValueError("damaged frame index")
    words, crc = parts.pop("words"), parts.pop("crc")
    payload = id_coder.unpack(memoryview(data)[at + 4:], int(words.sum()))
    lanes = np.ascontiguousarray(id_coder.decode(payload, words.astype(np.int64), length, vocabulary).T).astype("<u4")
    for k, row in enumerate(lanes):
        if zlib.crc32(row) != crc[k]:
            raise ValueError(f"damaged block {k}")
    return lanes.ravel()[:n_ids], parts


_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo CRC-32's (bit 31 is the constant term)."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def crc_before(crc: int, n_bytes: int) -> int:
    """What ``crc`` of a part adds (by XOR) to the crc32 of a whole in which ``n_bytes`` follow."""
    power, base = 1 << 31, 1 << 23          # 1 and x^8
    while n_bytes:
        if n_bytes & 1:
            power = _times(power, base)
        base = _times(base, base)
        n_bytes >>= 1
    return _times(crc, power)


def _frames(spec, vocabulary: int):
    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # the task has one core
        pieces = pieces_of(spec.value)
        file = frame = first = 0
        ids: list[np.ndarray] = []
        parts: list[tuple[np.ndarray, ...]] = []        # known, doc_id, whole, earlier, here

        def flushed():
            """The ids held so far as a row."""
            nonlocal frame, first, ids, parts
            whole = np.concatenate(ids)
            columns = {name: np.concatenate([p[i] for p in parts]) for i, (name, _) in enumerate(_PART)}
            data = write_frame(whole, columns, vocabulary)
            row = [pa.array([v], t) for v, t in ((file, pa.int32()), (frame, pa.int32()), (first, pa.int64()),
                                                 (len(whole), pa.int64()), (data, pa.binary()))]
            frame, first, ids, parts = frame + 1, first + len(whole), [], []
            return pa.RecordBatch.from_arrays(row, ["file", "frame", "first", "n_ids", "data"])

        held = 0
        for batch in arrow_batches(batches, "text"):
            file = batch.column("file")[0].as_py()
            key = batch.column("doc_id")
            known = key.is_valid().to_numpy(zero_copy_only=False)
            key = key.fill_null(0).to_numpy(zero_copy_only=False)
            made, n = pieces.encode(batch.column("text"))
            before = np.concatenate([[0], np.cumsum(n)])
            at = 0
            while at < len(made):
                upto = min(len(made), at + FRAME_IDS - held)
                # The documents that have ids between at and upto.
                lo, hi = np.searchsorted(before, at, side="right") - 1, np.searchsorted(before, upto)
                earlier = np.maximum(at - before[lo:hi], 0)
                here = np.minimum(before[lo + 1:hi + 1], upto) - before[lo:hi] - earlier
                parts.append((known[lo:hi], key[lo:hi], n[lo:hi], earlier, here))
                ids.append(made[at:upto])
                held += upto - at
                at = upto
                if held == FRAME_IDS:
                    yield flushed()
                    held = 0
        if held:
            yield flushed()
    return run


def write(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Write the ids of all texts, END after each, in ascending order of doc_id to ``path``."""
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    size = Tokenizer.from_str(text).get_vocab_size()
    if size > id_coder.MAX_ID + 1:
        raise ValueError(f"{size} ids don't fit 16 bits")
    spec = docs.sparkSession.sparkContext.broadcast(text)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "tie", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    frames = map_batches(rows.select(F.spark_partition_id().alias("file"), "doc_id", "text"), _frames(spec, size),
                         "file int, frame int, first long, n_ids long, data binary")
    frames.write.option("compression", "none").parquet(path)


def _parts(batches):
    import pyarrow as pa

    for batch in batches:
        for row in batch.to_pylist():
            ids, parts = read_frame(row["data"])
            if len(ids) != row["n_ids"] or int(parts["here"].sum()) != len(ids):
                raise ValueError("a frame's parts don't add up")
            end = np.cumsum(parts["here"].astype(np.int64))
            begin = end - parts["here"]
            raw = memoryview(ids.tobytes())
            whole, earlier = parts["whole"].astype(np.int64), parts["earlier"].astype(np.int64)
            after = whole - earlier - parts["here"]
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            crc = [crc_before(c, 4 * m) if m else c for c, m in zip(crc, after.tolist(), strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row["file"], np.int32)), pa.array(row["first"] + begin - earlier),
                 pa.array(parts["doc_id"], pa.int64(), mask=parts["known"] == 0), pa.array(whole),
                 pa.array(parts["here"].astype(np.int64)), pa.array(crc, pa.int64())],
                ["file", "at", "doc_id", "n_tokens", "here", "crc"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document in the files: doc_id, start, n_tokens, ids_crc32."""
    frames = spark.read.schema("file int, frame int, first long, n_ids long, data binary").parquet(path)
    parts = materialize(map_batches(frames, _parts, "file int, at long, doc_id long, n_tokens long, here long, crc long"),
                        "token-parts")
    # One row for each file, and as few in this window.
    files = frames.groupBy("file").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    split = parts.where("here < n_tokens").groupBy("file", "at").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.sum("here").alias("here"),
        F.bit_xor("crc").alias("crc"))
    split = split.withColumn("crc", F.when(F.col("here") == F.col("n_tokens"), F.col("crc")).otherwise(
        F.raise_error(F.lit("a document's frame is missing"))))
    docs = parts.where("here = n_tokens").unionByName(split)
    return docs.join(F.broadcast(files), "file").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32"))


def op12_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write(documents(spark, sf_dir), str(public_tokenizers.path("byte_bpe_50k.json")), path)
    return read(spark, path)
