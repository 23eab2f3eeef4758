import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from cellscope.llm import id_coder, token_files
from cellscope.session import scratch_path
from tests.llm import cases

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


ODD = ["a", "B", "é", "ß", "日", "😀", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x00", " ", " ",
       " ", "　", "\x85", "'s", "'", "’", ",", ".", "...", "!?", "1", "23", "<|endoftext|>", "<", "|>", "_", "-",
       "—", "word", "the"]


@settings(max_examples=250, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=30).map("".join), max_size=5))
def test_pieces_give_the_librarys_ids(library, texts):
    ids, n = token_files.Pieces(library).encode(pa.array(texts, pa.string()))
    want = [ids_of(library, t) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_pieces_of_equal_hash_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(token_files, "mix64", lambda x: x * np.uint64(0))
    texts = ["abcdefgh123 abcdefgh456 abcdefgh123"]
    ids, _ = token_files.Pieces(library).encode(pa.array(texts))
    assert ids.tolist() == ids_of(library, texts[0])


def test_new_pieces_are_given_to_the_library_together(library, monkeypatch):
    monkeypatch.setattr(token_files, "JOINED", 40)
    rng = random.Random(4)
    texts = [cases.prose(rng, 300) + " fin, été — naïve. <|endoftext|> x" for _ in range(3)]
    ids, n = token_files.Pieces(library).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in ids_of(library, t)]


def test_a_task_forgets_pieces(library, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN", 5)
    pieces = token_files.Pieces(library)
    for text in ("a b c d", "c d e f", "one two three four five six seven"):
        assert pieces.encode(pa.array([text]))[0].tolist() == ids_of(library, text)


class Counted:
    """The library, and how many bytes it was given."""

    def __init__(self, library):
        self.library, self.given = library, 0

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode_batch_fast(self, texts, **options):
        self.given += sum(map(len, texts))
        return self.library.encode_batch_fast(texts, **options)


def test_pieces_met_again_outlive_others(library, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN", 8)
    counted = Counted(library)
    pieces = token_files.Pieces(counted)
    for text in ("a one two", "a one three four", "a five six seven eight"):
        assert pieces.encode(pa.array([text]))[0].tolist() == ids_of(library, text)
    assert len(pieces.hash) <= 8
    counted.given = 0
    assert pieces.encode(pa.array(["a one"]))[0].tolist() == ids_of(library, "a one")
    assert counted.given == 0


def test_a_process_keeps_its_pieces(library):
    vocabulary = library.to_str()
    pieces = token_files.pieces_of(vocabulary)
    pieces.encode(pa.array(["kept from one task to the next"]))
    again = token_files.pieces_of("".join([vocabulary]))
    assert again is pieces and len(again.hash) > 0
    other = token_files.pieces_of(vocabulary + " ")
    assert other is not pieces and len(other.hash) == 0


def test_more_pieces_than_there_is_room(library):
    rng = random.Random(8)
    pieces = token_files.Pieces(library)
    for _ in range(4):
        texts = [cases.prose(rng, 200) + "".join(f" x{rng.randrange(10 ** 6)}" for _ in range(900))]
        assert pieces.encode(pa.array(texts))[0].tolist() == ids_of(library, texts[0])
    n = len(pieces.hash)
    assert n > 1 << 10 and (np.diff(pieces.hash.astype(object)) >= 0).all()
    assert sorted(pieces.place.tolist()) == list(range(n))


@pytest.mark.parametrize("seed", range(4))
def test_coder_round_trip(seed):
    rng = np.random.default_rng(seed)
    length, lanes = ((1, 1), (40, 3), (300, 17), (700, 5))[seed]
    ids = rng.integers(0, 50257, (length, lanes))
    ids[:, ::2] = rng.integers(0, 4, (length, len(range(0, lanes, 2))))     # predictable and rare symbols
    ids[length // 2:, 0] = 50256
    words, count = id_coder.encode(ids, 50257)
    assert (id_coder.unpack(id_coder.pack(words), len(words)) == words).all()
    assert (id_coder.decode(words, count, length, 50257) == ids).all()


def test_predictions_pay():
    """A repeated sequence costs a fraction of the raw 16 bits, lane by lane."""
    rng = np.random.default_rng(1)
    once = rng.integers(0, 50257, (50, 8))
    words, count = id_coder.encode(np.tile(once, (20, 1)), 50257)
    assert count.max() * id_coder.WORD < 0.25 * 16 * 1000
    fresh, _ = id_coder.encode(rng.integers(0, 50257, (1000, 8)), 50257)
    assert len(fresh) > 3 * len(words)


def test_last_nibbles_of_high_ids_are_learned():
    """Eight ids in no order, all from SMALL on: nothing of them is coded evenly."""
    rng = np.random.default_rng(5)
    ids = rng.choice([700, 1801, 9402, 20_003, 20_050, 33_333, 40_960, 50_256], (1000, 16))
    words, count = id_coder.encode(ids, 50257)
    assert len(words) * id_coder.WORD < 7 * ids.size
    assert (id_coder.decode(words, count, 1000, 50257) == ids).all()


def test_lanes_learn_from_each_other():
    """A rare sequence that stands in every lane at another place is cheap where it comes again."""
    rng = np.random.default_rng(6)
    once = rng.integers(20_000, 50257, 64)
    ids = np.stack([np.roll(once, k) for k in range(0, 64, 2)], 1)
    words, count = id_coder.encode(ids, 50257)
    alone, _ = id_coder.encode(ids[:, :1], 50257)
    assert len(words) * 2 < len(alone) * ids.shape[1]
    assert (id_coder.decode(words, count, 64, 50257) == ids).all()


def test_lanes_that_meet_in_one_step():
    """Equal lanes write the same contexts in the same step, and code what one writes."""
    rng = np.random.default_rng(7)
    ids = np.repeat(rng.integers(0, 50257, (200, 1)), 9, 1)
    ids[::7, 4:] = 11
    words, count = id_coder.encode(ids, 50257)
    assert (id_coder.decode(words, count, 200, 50257) == ids).all()


def test_weights_of_agreeing_predictions_add_up():
    model = id_coder._Model(3, 50257)
    first = model.predict().copy()
    assert (first[0] == first[1]).all() and (model.edges[:, 1] == id_coder.TOTAL // 2).all()
    for ids in ([5, 6, 7], [8, 9, 10]) * 40:
        ids = np.array(ids, np.int32)
        right = model.predict() == ids
        model.learn(np.where(right[1], 0, 2 - right[0]), ids)
    model.predict()
    assert model.agree.all() and (model.edges[:, 1] == model.bounds[:, 1]).all()
    assert (model.bounds[:, 0] < model.bounds[:, 1]).all()      # the one keeps its weight against the other


def frame(ids):
    parts = {"known": [1, 0], "doc_id": [7, 0], "whole": [len(ids) - 3, 3], "earlier": [0, 0], "here": [len(ids) - 3, 3]}
    return token_files.write_frame(np.array(ids), {k: np.array(v) for k, v in parts.items()}, 50257)


def test_damage_is_noticed():
    ids = list(range(1000))
    data = frame(ids)
    assert token_files.read_frame(data)[0].tolist() == ids
    for at in (0, 9, 30, len(data) - 400):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_files.read_frame(bytes(broken))


@pytest.mark.parametrize("a,b", [(b"", b"xyz"), (b"hello", b""), (b"abc", b"q" * 1001), (b"\0\0", b"\0")])
def test_checksums_of_parts_combine(a, b):
    assert token_files.crc_before(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def brute(library, rows):
    """Sorted result; documents of equal id in any order, so without their starts."""
    out, total = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(library, text)
        out.append((doc_id, total, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        total += len(ids)
    return out


@pytest.mark.parametrize("frame_ids", [1 << 22, 700])
def test_whole_operator_equals_the_library(spark, library, monkeypatch, frame_ids):
    """With small frames: documents that run over several."""
    monkeypatch.setattr(token_files, "FRAME_IDS", frame_ids)
    rng = random.Random(3)
    rows = cases.edge_texts()
    rows += [(rng.randrange(100, 10_000), cases.prose(rng, rng.randrange(0, 400))) for _ in range(40)]
    path = scratch_path(spark, "test-tokens")
    token_files.write(cases.documents(spark, rows).repartition(5), VOCABULARY, path)
    got = token_files.read(spark, path).collect()
    want = brute(library, rows)
    plain = lambda x: sorted(((r[0], *r[2:]) for r in x), key=str)
    assert plain(got) == plain(want)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    once = {r[0] for r in rows if sum(r[0] == q[0] for q in rows) == 1}
    assert {tuple(r) for r in got if r.doc_id in once} == {r for r in want if r[0] in once}
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    assert [key(r) for r in sorted(got, key=lambda r: r.start)] == sorted(map(key, got))


def test_empty(spark):
    path = scratch_path(spark, "test-tokens")
    token_files.write(cases.empty(spark), VOCABULARY, path)
    assert token_files.read(spark, path).collect() == []
