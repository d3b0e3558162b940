"""Byte-level BPE encoding of whole corpora with a public vocabulary (problem 8).

The encoder keeps the symbols of one pre-token in a doubly linked list and takes
merges from a priority queue ordered by (rank, position).  A queue entry whose
symbols have been merged since it was pushed is stale and is skipped.  Decoding
concatenates the vocabulary strings.

Defined results: null, empty text -> ``[]``; blank text is encoded as any text;
strings of special tokens are ordinary text.  Other columns are not touched.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.sources.shared import spread

#: Directory of the public tokenizer files; every entry point takes it as a parameter.
TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"

#: Entries of a worker's memo of pre-tokens, and the longest pre-token kept in it.  A memo only: results don't depend on it.
MEMO_ENTRIES = 200_000
MEMO_CHARS = 48

#: White space as a character class body (fixed values of the Unicode property).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(keep) -> str:
    """Character class body of all code points for which keep(category) holds."""
    out, start = [], None
    for cp in range(sys.maxunicode + 2):
        hit = cp <= sys.maxunicode and not 0xD800 <= cp < 0xE000 and keep(unicodedata.category(chr(cp)))
        if hit and start is None:
            start = cp
        elif not hit and start is not None:
            out.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return "".join(out)


def pretoken_pattern() -> re.Pattern[str]:
    r"""The published splitting rule, with \p{L}, \p{N} and \s written out for ``re``.

    A class of all letters is slow in ``re``: letters are what ``\w`` has beyond marks, numbers and
    the underscore, and ``\w`` itself is a fast test.
    """
    number = _ranges(lambda c: c[0] == "N")
    # \w is isalnum() or "_": letters and numbers.  What \w holds besides letters is the class number and "_".
    space = SPACE
    letters = f"(?:[a-zA-Z\\uac00-\\ud7a3\\u3041-\\u3096]|[^\\W_0-9{number}])+"
    return re.compile(
        rf"'(?:s|t|re|ve|m|ll|d)| ?{letters}| ?[{number}]+| ?(?:_|[^\w{space}])+|[{space}]+(?![^{space}])|[{space}]+"
    )


class Encoder:
    """BPE over bytes; ranks maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.strings = {i: b for b, i in ranks.items()}
        self.split = pretoken_pattern().findall
        # A pre-token never spans these cuts, so words with their punctuation can be looked up whole.
        self.words = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        self.memo: dict[str, tuple[int, ...]] = {}
        self.word_memo: dict[str, tuple[int, ...]] = {}

    @classmethod
    def parse(cls, data: bytes) -> "Encoder":
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())})

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        n, ranks = len(piece), self.ranks
        if n == 1:
            return [ranks[piece]]
        end = list(range(1, n + 1))  # symbol i covers piece[i:end[i]]; 0 marks a symbol that was merged away
        before = list(range(-1, n - 1))
        queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # stale: one of its symbols is gone or has grown
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(queue, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(queue, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        ids = self.memo.get(piece)
        if ids is None:
            ids = tuple(self.merge(piece.encode()))
            if len(piece) <= MEMO_CHARS:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[piece] = ids
        return ids

    def word_ids(self, word: str) -> tuple[int, ...]:
        get, slow, out = self.memo.get, self.piece_ids, []
        for piece in self.split(word):
            out += get(piece) or slow(piece)
        ids = tuple(out)
        if len(word) <= MEMO_CHARS:
            if len(self.word_memo) >= MEMO_ENTRIES:
                self.word_memo.clear()
            self.word_memo[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if text:
            get, slow = self.word_memo.get, self.word_ids
            for word in self.words(text):
                out += get(word) or slow(word)
        return out

    def counts(self, text: str) -> tuple[list[str], list[int]]:
        """The pre-tokens of text and the number of ids of each."""
        pieces = self.split(text)
        return pieces, [len(self.piece_ids(p)) for p in pieces]

    def count(self, text: str) -> int:
        return len(self.encode(text))

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}


def worker_encoder(data: bytes) -> Encoder:
    """The encoder of this Python worker, parsed once."""
    key = zlib.crc32(data)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder.parse(data)
    return _ENCODERS[key]


def vocabulary(spark, tokenizer_dir: str = TOKENIZER_DIR, name: str = BYTE_BPE):
    """The vocabulary file as a broadcast: a fixed public file (under 1 MB), independent of the data."""
    data = Path(tokenizer_dir, name).read_bytes()
    if len(data) > 8 << 20:
        raise ValueError(f"{name}: {len(data)} bytes is no vocabulary of the expected size")
    return spark.sparkContext.broadcast(data)


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(key, ids array<int>) of every row of df, in one pass without a shuffle."""
    shared = vocabulary(df.sparkSession, tokenizer_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        for batch in batches:
            flat, offsets = array("i"), array("i", [0])
            for value in batch.column(1).to_pylist():
                flat.extend(encoder.encode(value))
                offsets.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["key", "ids"])

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(df[key].alias("key"), df[text].alias("text"))).mapInArrow(run, f"key {kind}, ids array<int>")
    return out.withColumnRenamed("key", key)


def decode_corpus(df: DataFrame, key: str = "doc_id", ids: str = "ids", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(key, text) from ids; null or empty ids give ''."""
    shared = vocabulary(df.sparkSession, tokenizer_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        for batch in batches:
            texts = [encoder.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key].alias("key"), df[ids].alias("ids")).mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)
