"""BPE encoding and decoding with forced-boundary splitting.

Two neighbouring bytes that stand inside no vocabulary token can never be merged over, so a cut
between them is certain. A word is split at its certain cuts, each fragment is encoded by itself
and the ids are concatenated. Fragments are short and repeat, so a bounded cache answers most.

Null texts count as empty: no ids, decoded to the empty text. Texts of any length are encoded
whole; merging a fragment takes O(n log n). Ids are little-endian unsigned 32-bit integers in a
binary column, which needs no array objects on either side.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Callable
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm.common import free_names, without

CACHED = 1 << 18  # words a task keeps; with the tables about 100 MB
CACHED_SYMBOLS, CACHED_FRAGMENTS = 1 << 17, 1 << 14  # words of unusual texts; fragments, asked for by new words only
CACHED_CHARS = 64  # longer words are not kept
SHORT = 32  # symbols up to which a list is searched for the next pair; longer fragments use a heap
NO_PAIR = 1 << 30  # above every rank
IDS = np.dtype("<u4")
WORD_END = "</w>"
# Characters (and their lower case) whose NFC form, class and white space do not differ between
# Unicode versions. A text with others is normalised and split by the tokenizer's own tables instead.
UNUSUAL = re.compile("[^\x00-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")


def _byte_symbols() -> list[str]:
    """The printable character of each byte: itself where printable, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


def _usual(pattern: str) -> str:
    """The splitter's pattern with its Unicode classes spelled out for the usual characters."""
    usual = [c for c in map(chr, range(0x2100)) if not UNUSUAL.match(c)]
    of_kind = lambda kind: "".join(c for c in usual if unicodedata.category(c)[0] == kind)
    spaces = "\t-\r \x85\xa0"
    return pattern.replace(r"\p{L}", of_kind("L")).replace(r"\p{N}", of_kind("N")).replace(r"\s", spaces)


class _Words(dict):
    """Word to ids (as bytes), filled when asked."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class ForcedBoundaryBpe:
    """``spec`` is the JSON text of a word-end BPE tokenizer (NFC, one space, lower case; byte-level)."""

    def __init__(self, spec: str):
        parts = json.loads(spec)
        self.spec = spec
        vocabulary = parts["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
        self.rank = {(a, b): n for n, (a, b) in enumerate(pairs)}
        self.ids = vocabulary
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = re.compile(_usual(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]))
        self.symbols = _byte_symbols()
        self.inside, self.at_end = self._joined_pairs(vocabulary)
        self.words = _Words(self._encode_word, CACHED)
        self.symbol_words = _Words(self._encode_symbols, CACHED_SYMBOLS)
        self.fragments: dict[str, bytes] = {}

    @staticmethod
    def _joined_pairs(vocabulary) -> tuple[set[str], set[str]]:
        """Pairs inside a token, and pairs whose second byte ends a word inside a token."""
        inside, at_end = set(), set()
        for token in vocabulary:
            inside.update(map("".join, zip(token, token[1:])))
            if token.endswith(WORD_END):
                at_end.add(token[: -len(WORD_END)][-2:])
        return inside, at_end

    @cached_property
    def tables(self):
        """The library's own normaliser and splitter, for unusual texts."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.spec)

    def _encode_piece(self, text: str) -> bytes:
        """The ids of text without special tokens."""
        if UNUSUAL.search(text):
            normal = self.tables.normalizer.normalize_str(text)
            found = self.tables.pre_tokenizer.pre_tokenize_str(normal)
            return b"".join([self.symbol_words[symbols] for symbols, _ in found])
        # White space is dropped by the splitter, so runs of it need not be joined first.
        return b"".join(map(self.words.__getitem__, self.pieces.findall(text.lower())))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.specials is None or not self.specials.search(text):
            return self._encode_piece(text)
        out = []
        for n, piece in enumerate(self.specials.split(text)):
            if n % 2:
                out.append(struct.pack("<I", self.special[piece]))
            elif piece:
                out.append(self._encode_piece(piece))
        return b"".join(out)

    def _encode_word(self, word: str) -> bytes:
        return self._encode_symbols("".join([self.symbols[b] for b in word.encode()]))

    def _encode_symbols(self, word: str) -> bytes:
        """Cut at the certain boundaries; a fragment in the middle of a word has no word end."""
        last = len(word) - 1
        start, out = 0, []
        for i in range(last):
            joined = self.at_end if i + 1 == last else self.inside
            if word[i : i + 2] not in joined:
                out.append(self._encode_fragment(word[start : i + 1]))
                start = i + 1
        out.append(self._encode_fragment(word[start:] + WORD_END))
        return b"".join(out)

    def _encode_fragment(self, fragment: str) -> bytes:
        found = self.fragments.get(fragment)
        if found is None:
            parts = list(fragment)
            if fragment.endswith(WORD_END):
                parts[-len(WORD_END) - 1 :] = [fragment[-len(WORD_END) - 1 :]]
            ids = [self.ids[t] for t in self._merge(parts)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(fragment) <= CACHED_CHARS:
                if len(self.fragments) >= CACHED_FRAGMENTS:
                    self.fragments.clear()
                self.fragments[fragment] = found
        return found

    def _merge(self, parts: list[str]) -> list[str]:
        if len(parts) > SHORT:
            return self._merge_long(parts)
        rank = self.rank.get
        found = [rank(p, NO_PAIR) for p in zip(parts, parts[1:])]
        while found and (best := min(found)) != NO_PAIR:
            i = found.index(best)
            parts[i] += parts.pop(i + 1)
            del found[i]
            if i:
                found[i - 1] = rank((parts[i - 1], parts[i]), NO_PAIR)
            if i < len(found):
                found[i] = rank((parts[i], parts[i + 1]), NO_PAIR)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """Always the pair of lowest rank, leftmost first: a heap over a doubly linked list."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.rank
        heap = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if j >= n or not parts[i] or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (fresh := ranks.get((parts[left], parts[right]))) is not None:
                    heapq.heappush(heap, (fresh, left))
        return [t for t in parts if t]


def token_texts(spec: str) -> list[str | None]:
    """The text of each id."""
    parts = json.loads(spec)
    texts = {i: t for t, i in parts["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parts["added_tokens"]}
    return [texts.get(i) for i in range(max(texts) + 1)]


def decode(ids: bytes | None, texts: list[str | None]) -> str:
    found = [texts[i] for i in np.frombuffer(ids or b"", IDS).tolist() if i < len(texts)]
    return " ".join([t for t in found if t is not None] if None in found else found)


def _model(spark: SparkSession, path: str):
    """The tokenizer file, read once by the driver: a fixed size of a few MB, whatever the data."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


class _InTask:
    """A function of one value that ``make`` makes in each task, when the first value comes."""

    def __init__(self, make: Callable[[], Callable]):
        self.make = make

    @cached_property
    def convert(self) -> Callable:
        return self.make()


def _by_value(make: Callable[[], Callable], kind: str):
    """Values go to Python and back a hundred at a time, pickled. An Arrow batch has 10,000 texts or 64 MB, held on both
    sides of every core with room to grow: more than the tables and caches."""
    task = _InTask(make)

    @F.udf(kind, useArrow=False)
    def convert(value):
        return task.convert(value)

    return convert


def encoder(spark: SparkSession, path: str):
    spec = _model(spark, path)
    return _by_value(lambda: ForcedBoundaryBpe(spec.value).encode, "binary")


def decoder(spark: SparkSession, path: str):
    spec = _model(spark, path)

    def make():
        texts = token_texts(spec.value)
        return lambda ids: decode(ids, texts)

    return _by_value(make, "string")


def round_trip(spark: SparkSession, path: str):
    """Ids and the digest of what they decode to, from one function: a second one would hold another Python worker,
    with another copy of the tables, on every core."""
    spec = _model(spark, path)

    def make():
        model = ForcedBoundaryBpe(spec.value)
        texts = token_texts(spec.value)

        def both(text: str | None) -> tuple[bytes, str]:
            ids = model.encode(text)
            return ids, hashlib.sha256(decode(ids, texts).encode("utf-8", "surrogatepass")).hexdigest()

        return both

    both = _by_value(make, "ids binary, digest string")
    return both.asNondeterministic()  # so that it stays one column, computed once


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / IDS.itemsize).cast("long")


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids", n: str = "n_tokens") -> DataFrame:
    """``df`` with the ids of every whole text and their number. Columns of these names are replaced."""
    encoded = encoder(df.sparkSession, path)(F.col(f"`{text}`"))
    kept = [f"`{c}`" for c in without(df, ids, n).columns]
    return df.select(*kept, encoded.alias(ids)).withColumn(n, n_ids(F.col(f"`{ids}`")))


def encode_checked(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", n: str = "n_tokens", digest: str = "decoded_sha256"
) -> DataFrame:
    """``df`` with the ids of every whole text, their number, and the SHA-256 of the text they decode to, in one pass.
    Columns of these names are replaced."""
    rest = without(df, *(name for name in (ids, n, digest) if name != text))
    (found,) = free_names(rest, "found")
    kept = [f"`{c}`" for c in rest.columns if c not in (ids, n, digest)]
    coded = rest.withColumn(found, round_trip(df.sparkSession, path)(F.col(f"`{text}`")))
    part = lambda name: F.col(f"`{found}`.{name}")
    return coded.select(*kept, part("ids").alias(ids), n_ids(part("ids")).alias(n), part("digest").alias(digest))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids``; unknown ids have no text."""
    decoded = decoder(df.sparkSession, path)(F.col(f"`{ids}`"))
    return without(df, out).withColumn(out, decoded)
