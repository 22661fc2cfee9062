"""Operator 1: BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols are leaves in order; each leaf holds the merge rank of the pair that starts there,
and each inner node the least (rank, position) below it. The root is therefore the leftmost pair of
the lowest rank. A merge changes three leaves (the merged pair, the pair before, the pair that was
its right neighbour), each a logarithmic update, so a word of n symbols takes O(n log n) whatever
its length. Texts are cut into words with the vocabulary file's own normaliser and word pattern.

Row cases: a null text counts as empty (no tokens, decoded ""); repeated rows give repeated rows;
other columns are ignored, whatever their names; a text that is one long word is encoded whole; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from constella.llm.common import lean_batches, table, text_batches

VOCABULARY = "word_bpe_49k.json"
#: Chunks and words remembered per Python worker; memos only, results do not depend on them.
MEMO_CHUNKS, MEMO_WORDS = 300_000, 300_000

# White space of the vocabulary file's pattern (Unicode White_Space), which never belongs to a word.
_CHUNK = re.compile("[^\t-\r \x85\xa0  -     　]+")

# Chunks of these characters are their own NFC form and lower-cased character by character, and their
# letters and numbers are the same in every Unicode version; others go through the library's normaliser.
_PLAIN = re.compile("[!-~¡-ɏ]+")
_PLAIN_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# the byte alphabet: printable bytes stand for themselves, the others for the characters from 256 on
_SELF = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_SELF))}


def merge_symbols(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """``symbols`` after all merges, always the leftmost pair of the lowest rank first."""
    n = len(symbols)
    if n < 2:
        return symbols
    bits = (n - 1).bit_length()
    size = 1 << bits
    never = 1 << 62
    position = size - 1
    tree = [never] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        hit = get((symbols[i], symbols[i + 1]))
        if hit is not None:
            tree[size + i] = hit[0] << bits | i
    for k in range(size - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    if tree[1] == never:
        return symbols
    following = list(range(1, n + 1))
    previous = list(range(-1, n - 1))
    symbols = list(symbols)

    def put(leaf: int, key: int) -> None:
        k = size + leaf
        if tree[k] == key:
            return
        tree[k] = key
        k >>= 1
        while k:
            left, right = tree[2 * k], tree[2 * k + 1]
            least = left if left < right else right
            if tree[k] == least:
                return
            tree[k] = least
            k >>= 1

    while (root := tree[1]) != never:
        at = root & position
        gone = following[at]
        symbols[at] = ranks[symbols[at], symbols[gone]][1]
        after = following[gone]
        following[at] = after
        put(gone, never)
        if after < n:
            previous[after] = at
            hit = get((symbols[at], symbols[after]))
            put(at, never if hit is None else hit[0] << bits | at)
        else:
            put(at, never)
        before = previous[at]
        if before >= 0:
            hit = get((symbols[before], symbols[at]))
            put(before, never if hit is None else hit[0] << bits | before)
    out, at = [], 0
    while at < n:
        out.append(symbols[at])
        at = following[at]
    return out


class BpeCodec:
    """Encoder and decoder for one vocabulary file (BPE with a word-end suffix, byte alphabet)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.suffix: str = spec["model"]["end_of_word_suffix"] or ""
        self.vocab = vocab
        self.ranks = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        words = Tokenizer.from_file(path)  # only its normaliser and word pattern are used
        self._normalize = words.normalizer.normalize_str
        self._words = words.pre_tokenizer.pre_tokenize_str
        tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        self._tokens = np.array(tokens, dtype=object)
        self._word_memo: dict[str, bytes] = {}
        self._chunk_memo: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self._word_memo.get(word)
        if ids is None:
            symbols = [self.vocab[c] for c in word[:-1]]
            symbols.append(self.vocab[word[-1] + self.suffix])
            ids = array("I", merge_symbols(symbols, self.ranks)).tobytes()
            if len(self._word_memo) >= MEMO_WORDS:
                self._word_memo.clear()
            if len(word) < 64:
                self._word_memo[word] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join([self._word(w if w.isascii() else w.encode().decode("latin-1").translate(_ALPHABET))
                             for w in _PLAIN_WORDS.findall(chunk.lower())])
        out = []
        for i, part in enumerate(self._special.split(chunk) if self._special else [chunk]):
            if i % 2:
                out.append(array("I", [self.special[part]]).tobytes())
            elif part:
                out += [self._word(w) for w, _ in self._words(self._normalize(part))]
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, packed as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        memo, out = self._chunk_memo, []
        for chunk in _CHUNK.findall(text):
            ids = memo.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(memo) >= MEMO_CHUNKS:
                    memo.clear()
                if len(chunk) < 64:
                    memo[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of packed ids: tokens joined by blanks, as the vocabulary file names no decoder."""
        return " ".join(self._tokens[np.frombuffer(ids, "<u4")])


_CODECS: dict[str, BpeCodec] = {}


def codec(vocabulary: str = VOCABULARY) -> BpeCodec:
    """The codec of a public vocabulary file, one per Python worker."""
    if vocabulary not in _CODECS:
        _CODECS[vocabulary] = BpeCodec(public_tokenizers.path(vocabulary))
    return _CODECS[vocabulary]


def encode_decode(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (packed, see ``BpeCodec.encode``), decoded (from the ids)."""

    lean_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for part, texts in text_batches(batches, 1):
            ids = [bpe.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([bpe.decode(x) for x in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_decode(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: doc_id, n_tokens, ids and decoded text of every row."""
    return encode_decode(docs)
