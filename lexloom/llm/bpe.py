"""BPE encoding and decoding by tree concatenation.

A text is normalised and split into pieces as its tokenizer file says.  A piece
that has no split point may be arbitrarily long; it is cut into halves down to
leaves of ``LEAF`` symbols, the leaves are encoded in parallel, and neighbours
are joined bottom up: the tokens around the join are encoded again in a window
that grows until its first and last token equal the tokens already there.  A
sequence in which every adjacent pair is what BPE gives for that pair is what
BPE gives for the whole, so the result is exact.

Defined results: null and empty texts have no tokens, an empty id list and an
empty decoded text.  Special tokens written out in a text become their ids, as
the tokenizers library does by default.  Decoding joins the token strings by one
space, which is what a tokenizer file without a decoder asks for.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.runtime import lean, text_or_empty

#: Symbols of a piece that are encoded in one go, and pieces in each of the two generations of a worker's cache.
LEAF = 64
CACHED_PIECES = 120_000
#: Tokens on either side of a join that the first window takes.
FIRST_WINDOW = 4
#: Leaves from which a piece's leaves are encoded by a pool of threads.
POOL_LEAVES = 256

_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
_DIGITS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u0085 "
#: Texts of these characters lower-case and compose one by one, so a plain pattern splits them.
_PLAIN = re.compile("[\u0001-\u001b\u0020-įı-ſ]*")
_PLAIN_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACES}{_LETTERS}{_DIGITS}]+")


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


_ALPHABET = _byte_alphabet()
_TO_ALPHABET = {i: c for i, c in enumerate(_ALPHABET)}


def concatenate(left: list, right: list, encode: Callable[[list, list, bool, bool], list]) -> list:
    """Tokens of two neighbours joined exactly.

    ``encode(a, b, at_start, at_end)`` gives the tokens of the text of the token
    lists ``a + b``; the flags say whether the window reaches the outer ends.
    """
    if not left or not right:
        return left or right
    k = FIRST_WINDOW
    while True:
        a, b = left[-k:], right[:k]
        whole_left, whole_right = len(a) == len(left), len(b) == len(right)
        new = encode(a, b, whole_left, whole_right)
        if (whole_left or new[0] == a[0]) and (whole_right or new[-1] == b[-1]):
            return left[: len(left) - len(a)] + new + right[len(b) :]
        k *= 2


class TreeEncoder:
    """Encoder for one tokenizer file of the tokenizers library with a BPE model and a word-end suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab, merges = model["vocab"], [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.ends = BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.suffix) if self.suffix else BPE(vocab=vocab, merges=merges)
        self.inner = BPE(vocab=vocab, merges=merges) if self.suffix else self.ends
        self.vocab = vocab
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        plain = json.dumps([spec.get("normalizer"), spec.get("pre_tokenizer"), spec.get("decoder")])
        # The plain pattern below holds only for this combination; any other goes through the library's own parts.
        self.plain = all(x in plain for x in ('"NFC"', '"Lowercase"', '"Split"', "'s|'t|'re|'ve|'m|'ll|'d|[", '"use_regex": false')) and spec.get("decoder") is None
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.old: dict[str, tuple[int, str, str]] = {}

    # -- one piece, in the byte alphabet ---------------------------------
    def _leaf(self, text: str, at_end: bool) -> list[tuple[int, str]]:
        return [(t.id, t.value) for t in (self.ends if at_end else self.inner).tokenize(text)]

    def _surface(self, tokens: list[tuple[int, str]]) -> str:
        text = "".join(v for _, v in tokens)
        return text.removesuffix(self.suffix) if self.suffix else text

    def tokens(self, piece: str) -> list[tuple[int, str]]:
        """(id, token) pairs of one piece."""
        if len(piece) <= LEAF:
            return self._leaf(piece, True)
        starts = range(0, len(piece), LEAF)
        leaves = [(piece[i : i + LEAF], i + LEAF >= len(piece)) for i in starts]
        if len(leaves) >= POOL_LEAVES:
            with ThreadPoolExecutor(4) as pool:
                level = list(pool.map(lambda x: self._leaf(*x), leaves))
        else:
            level = [self._leaf(*x) for x in leaves]
        while len(level) > 1:
            last = (len(level) - 1) // 2
            level = [
                concatenate(level[2 * i], level[2 * i + 1], lambda a, b, _, at_end, tail=i == last: self._leaf(self._surface(a) + self._surface(b), tail and at_end))
                if 2 * i + 1 < len(level)
                else level[2 * i]
                for i in range((len(level) + 1) // 2)
            ]
        return level[0]

    def _keep(self, key: str, entry: tuple[int, str, str]) -> tuple[int, str, str]:
        """Remember an entry; a full generation becomes the old one, whose used entries come back."""
        if len(key) <= LEAF:
            if len(self.cache) >= CACHED_PIECES:
                self.old, self.cache = self.cache, {}
            self.cache[key] = entry
        return entry

    def _piece(self, key: str) -> tuple[int, str, str]:
        """The entry of one piece; a key that starts with NUL is in the byte alphabet already."""
        entry = self.cache.get(key)
        if entry is None:
            entry = self.old.get(key)
            if entry is None:
                if key[0] == "\0" and len(key) > 1:
                    piece = key[1:]
                else:
                    piece = key if key.isascii() and key.isprintable() else key.encode().decode("latin-1").translate(_TO_ALPHABET)
                found = self.ends.tokenize(piece) if len(piece) <= LEAF else None
                if found is not None:
                    entry = (len(found), " ".join([str(t.id) for t in found]), " ".join([t.value for t in found]))
                else:
                    pairs = self.tokens(piece)
                    entry = (len(pairs), " ".join([str(i) for i, _ in pairs]), " ".join([v for _, v in pairs]))
            self._keep(key, entry)
        return entry

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        """The entry of a run of characters between white space, made of its pieces' entries."""
        entry = self.old.get(chunk)
        if entry is None:
            if chunk.isalpha():
                return self._piece(chunk)
            parts = [self._piece(p) for p in _PLAIN_PIECE.findall(chunk)]
            if len(parts) == 1:
                return parts[0]
            entry = (sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts]))
        return self._keep(chunk, entry)

    # -- whole texts -----------------------------------------------------
    def _pieces(self, text: str) -> list[tuple[int, str, str]]:
        cache = self.cache
        if self.plain and _PLAIN.fullmatch(text):
            out = []
            for chunk in text.lower().split():  # white space always ends a piece
                entry = cache.get(chunk)
                if entry is None:
                    entry = self._chunk(chunk)
                out.append(entry)
            return out
        normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal) if normal else []
        return [self._piece("\0" + p) for p, _ in split]

    def entries(self, text: str) -> list[tuple[int, str, str]]:
        """(number of ids, ids, token strings) of each piece, in order."""
        if self._special is None or "<" not in text or not self._special.search(text):
            return self._pieces(text)
        out: list[tuple[int, str, str]] = []
        for part in self._special.split(text):
            if part in self.special:
                out.append((1, str(self.special[part]), part))
            elif part:
                out += self._pieces(part)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.entries(text) for i in ids.split()]


@lru_cache(maxsize=4)
def encoder(path: str) -> TreeEncoder:
    """The worker's encoder for a file; the file must lie at that path on every executor."""
    return TreeEncoder(path)


class Decoder:
    """Ids back to text: token strings joined by one space, special tokens kept."""

    def __init__(self, path: str):
        own = encoder(path)
        self.names = {i: t for t, i in own.vocab.items()} | {i: t for t, i in own.special.items()}

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids if i in self.names)


@lru_cache(maxsize=4)
def decoder(path: str) -> Decoder:
    return Decoder(path)


SCHEMA_DIGEST = "doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digests(own: TreeEncoder, back: Decoder, text: str) -> tuple[int, str, str]:
    """Number of tokens, SHA-256 of the ids, and of the text that the decoder makes of those ids."""
    got = own.entries(text)
    ids = " ".join(b for _, b, _ in got)
    return sum(a for a, _, _ in got), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.decode([int(i) for i in ids.split()]).encode()).hexdigest()


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of tokens, SHA-256 of the ids and of the decoded text (see the module's docstring)."""
    kind = docs.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reader = encoder(path), decoder(path)
        for batch in batches:
            found = [digests(own, reader, text.as_py()) for text in batch.column(1)]
            n, ids, back = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(lean(run), SCHEMA_DIGEST.format(kind=kind))


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and the token ids themselves (``ids array<int>``)."""
    kind = docs.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # long lists leave in small batches
                part = batch.slice(at, 256)
                ids = [own.encode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(lean(run), f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and decoded text; null ids decode to the empty text."""
    kind = encoded.select(id_col).dtypes[0][1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            texts = [own.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(lean(run), f"doc_id {kind}, text string")
