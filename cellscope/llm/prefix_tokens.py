r"""Operator 2: exact token counts by dynamic programming over prefixes.

For a byte-level BPE vocabulary with word ends, every prefix of a word has one
encoding, and the encoding of a prefix ends with the one token whose own left
neighbour fits it.  So a table over prefixes (last token, token count) is filled
from left to right: of the tokens that end at a place, take the one that fits the
last token of what stands before it.  Two tokens fit when no merge across their
border would have come before the merges that built the tokens.  The table answers
how many tokens any prefix has, and so where a text must be cut for a budget,
without encoding anything again.

The vocabulary is a file in the ``tokenizers`` JSON format; its path is a parameter.
It is read once by the driver and sent to the tasks as text (a fixed, small size).

Cases: null and empty texts have no bytes and no tokens; special strings of the
vocabulary inside a text count as one token each; whole texts are counted whatever
their length; repeated rows, null ids: a row each; an empty table gives no rows; other columns are
left aside.  Words seen before are looked up in a table that is emptied when full.
"""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscope.llm.common import arrow_batches, documents, map_batches

LIMIT = 2048
KNOWN_WORDS = 200_000        # size of a task's table of words seen before

# White_Space code points, as the vocabulary's \s.
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: character -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts for one vocabulary."""

    def __init__(self, spec: str):
        import regex

        conf = json.loads(spec)
        model = conf["model"]
        end = model.get("end_of_word_suffix") or ""
        letters = byte_alphabet()
        self.inner: dict[str, int] = {}      # byte string (as latin-1) -> id, inside a word
        self.final: dict[str, int] = {}      # the same for tokens that end a word
        vocab = model["vocab"]
        for token, i in vocab.items():
            ends = bool(end) and token.endswith(end)
            body = token[:-len(end)] if ends else token
            raw = "".join(chr(letters[c]) for c in body)
            (self.final if ends else self.inner)[raw] = i
        self.merge: dict[int, int] = {}      # left id << 32 | right id -> rank
        self.parts: dict[int, tuple[int, int, int]] = {}   # id -> left, right, rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y = vocab[a], vocab[b]
            self.merge[x << 32 | y] = rank
            self.parts.setdefault(vocab[a + b], (x, y, rank))
        self.inner_tails, self.final_tails = self._tails(self.inner), self._tails(self.final)
        self.right: dict[int, list] = {}
        self.left: dict[int, list] = {}
        self.fit: dict[int, bool] = {}
        special = [t["content"] for t in conf.get("added_tokens", []) if t.get("special")]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.word = regex.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WS}\p{{L}}\p{{N}}]+")

    @staticmethod
    def _tails(tokens: dict[str, int]) -> dict[str, int]:
        """All endings of tokens, with the id of the token that is the whole ending, or -1."""
        out = {t[i:]: -1 for t in tokens for i in range(1, len(t))}
        out.update(tokens)
        return out

    def _edge(self, token: int, side: int, known: dict) -> list[tuple[int, float]]:
        """Pieces at one edge of a token, each with the rank of the merge that used it up."""
        got = known.get(token)
        if got is None:
            got, piece, used = [], token, float("inf")
            while True:
                got.append((piece, used))
                if piece not in self.parts:
                    break
                used = self.parts[piece][2]
                piece = self.parts[piece][side]
            known[token] = got
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can follow token a in an encoding."""
        key = a << 32 | b
        known = self.fit.get(key)
        if known is None:
            known = True
            for x, x_used in self._edge(a, 1, self.right):
                for y, y_used in self._edge(b, 0, self.left):
                    rank = self.merge.get(x << 32 | y)
                    # Of equal merges the left one comes first.
                    if rank is not None and rank < x_used and rank <= y_used:
                        known = False
                        break
                if not known:
                    break
            if len(self.fit) > 4 * KNOWN_WORDS:
                self.fit.clear()
            self.fit[key] = known
        return known

    def _table(self, s: str, upto: int) -> tuple[list[int], list[int]]:
        """For each prefix of s that doesn't end the word: last token, number of tokens."""
        last, count = [0] * (upto + 1), [0] * (upto + 1)
        tails, known, fits = self.inner_tails, self.fit, self.fits
        for i in range(1, upto + 1):
            for at in range(i - 1, -1, -1):
                token = tails.get(s[at:i])
                if token is None:
                    break       # no token ends like this, so no longer one does
                if token >= 0:
                    if at:
                        before = last[at]
                        fit = known.get(before << 32 | token)
                        if not (fits(before, token) if fit is None else fit):
                            continue
                    last[i], count[i] = token, count[at] + 1
                    break
        return last, count

    def _close(self, s: str, n: int, last: list[int], count: list[int]) -> int:
        """Tokens of the first n bytes of s as a whole word."""
        for at in range(n - 1, -1, -1):
            token = self.final_tails.get(s[at:n])
            if token is None:
                break
            if token >= 0 and (at == 0 or self.fits(last[at], token)):
                return count[at] + 1
        raise ValueError("the vocabulary lacks a byte")

    def count_word(self, word: str) -> int:
        s = word if word.isascii() else word.encode("utf-8", "replace").decode("latin-1")
        return self._close(s, len(s), *self._table(s, len(s) - 1))

    def word_prefixes(self, word: str) -> list[int]:
        """Tokens of the first 1, 2, ... characters of a word, each as a whole word."""
        s = word.encode("utf-8", "replace").decode("latin-1")
        last, count = self._table(s, len(s) - 1)
        out, at = [], 0
        for c in word:
            at += len(c.encode("utf-8", "replace"))
            out.append(self._close(s, at, last, count))
        return out

    def segments(self, text: str):
        """Normalised text between special strings, and None for each of these."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield self._normal(text[at:m.start()])
            yield None
            at = m.end()
        yield self._normal(text[at:] if at else text)

    @staticmethod
    def _normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()


class _Known(dict):
    """Token counts by word, worked out when first asked for."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        n = self[word] = self.counter.count_word(word)
        return n


def count_text(counter: PrefixCounter, known: dict, text: str) -> int:
    total = 0
    for part in counter.segments(text):
        total += 1 if part is None else sum(map(known.__getitem__, counter.word.findall(part)))
    return total


def fitting_chars(counter: PrefixCounter, known: dict, text: str, budget: int) -> int:
    """Length in characters of the longest prefix of the normalised text (special
    strings count as 0 characters) with ``budget`` tokens at most."""
    chars = 0
    for part in counter.segments(text):
        if part is None:
            if not budget:
                return chars
            budget -= 1
            continue
        for m in counter.word.finditer(part):
            n = known[m.group()]
            if n > budget:
                inside = [i for i, k in enumerate(counter.word_prefixes(m.group()), 1) if k <= budget]
                return chars + m.start() + max(inside, default=0)
            budget -= n
        chars += len(part)
    return chars


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars (characters of the normalised
    text that ``limit`` tokens hold; null where the text isn't over the limit)."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        import pyarrow as pa

        counter = PrefixCounter(spec.value)
        known = _Known(counter)
        for batch in arrow_batches(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [count_text(counter, known, t) for t in texts]
            fit = [fitting_chars(counter, known, t, limit) if n > limit else None
                   for t, n in zip(texts, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_()), pa.array(fit, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return map_batches(docs.select("doc_id", n_bytes.alias("n_bytes"), "text"),
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), str(public_tokenizers.path("word_bpe_49k.json")))
