"""Splitting oversized texts by content-defined chunking (problem 10).

A rolling hash over the last pre-tokens marks landmarks that depend on the text
around them alone.  From the last cut, the first landmark past the minimum size
is moved to the nearest natural boundary (heading near it, else heading or paragraph, else
sentence or line, else word) between the minimum and the maximum size, so an edit moves the
cuts next to it and the later ones fall back into step.  Each piece after the
first starts at most ``overlap`` tokens before the end of the piece before, at the
strongest boundary there.

Defined results: null and empty texts give no piece; a text within the limit gives
one piece; a text without any boundary is cut between characters.  Rows with equal
keys are cut each for itself.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.bpe import TOKENIZER_DIR, Encoder, vocabulary, worker_encoder
from folioscope.sources.shared import spread

MAX_TOKENS = 2000
OVERLAP = 100
#: Share of the maximum below which no cut is made, window of the rolling hash in pre-tokens, mean distance of landmarks in pre-tokens.
MIN_SHARE = 0.6
WINDOW = 8
EVERY = 64
#: Share of the maximum within which a heading is preferred to a paragraph that is nearer.
HEADING_SHARE = 0.25
#: A pre-token of more tokens than this is divided into runs of RUN characters, between which it may be cut.
LONG = 32
RUN = 8

HEADING, PARAGRAPH, SENTENCE, WORD = 4, 3, 2, 1
_HEADING = re.compile(r"^(?=#{1,6} |<[hH][1-6]\b|={1,6} ?\S[^\n]*=\s*$|\\(?:sub)*(?:section|chapter|paragraph)\b|[^\n]+\n[=-]{3,}\s*$)", re.M)
_PARAGRAPH = re.compile(r"\n[ \t]*\n\s*")
_SENTENCE = re.compile(r"[.!?…][\"'”’)\]]*(?=\s)|[。！？]+[」』）]*|\n")


def _atoms(encoder: Encoder, text: str) -> tuple[list[str], list[int], list[int]]:
    """Units between which the text may be cut, their token counts, and 1 for units that start inside a pre-token."""
    parts, sizes, inside = [], [], []
    for piece, n in zip(*encoder.counts(text), strict=True):
        if n <= LONG:
            parts.append(piece)
            sizes.append(n)
            inside.append(0)
        else:
            for i in range(0, len(piece), RUN):
                parts.append(run := piece[i : i + RUN])
                sizes.append(encoder.count(run))
                inside.append(int(i > 0))
    return parts, sizes, inside


def _levels(text: str, parts: list[str], starts: list[int], inside: list[int]) -> list[int]:
    """For each unit, the strength of the boundary before it."""
    level = [0] * len(parts)
    for i in range(1, len(parts)):
        if not inside[i] and (parts[i][0].isspace() or parts[i - 1][-1].isspace() or not (parts[i][0].isalnum() and parts[i - 1][-1].isalnum())):
            level[i] = WORD

    def mark(at: int, strength: int) -> None:
        i = bisect_left(starts, at)
        if 0 < i < len(parts) and starts[i] == at:
            level[i] = max(level[i], strength)

    for m in _SENTENCE.finditer(text):
        mark(m.end(), SENTENCE)
    for m in _PARAGRAPH.finditer(text):
        mark(m.end(), PARAGRAPH)
    for m in _HEADING.finditer(text):
        mark(m.start(), HEADING)
    return level


def landmarks(parts: list[str]) -> np.ndarray:
    """Indexes of the units after which the rolling hash of the last WINDOW units hits."""
    own = np.fromiter((zlib.crc32(p.encode()) for p in parts), np.uint64, len(parts))
    rolled = np.zeros(len(parts), np.uint64)
    for k in range(min(WINDOW, len(parts))):
        rolled[k:] += own[: len(parts) - k] * np.uint64(pow(0x9E3779B1, k + 1, 1 << 61) | 1)
    return np.nonzero((rolled >> np.uint64(20)) % np.uint64(EVERY) == 0)[0] + 1


def chunk(encoder: Encoder, text: str | None, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """(start, end, tokens, tokens repeated) of each piece; start and end count characters."""
    if not text:
        return []
    if (tokens := encoder.count(text)) <= max_tokens:
        return [(0, len(text), tokens, 0)]
    parts, sizes, inside = _atoms(encoder, text)
    total = np.concatenate([[0], np.cumsum(sizes)])
    n = len(parts)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()
    level = np.array(_levels(text, parts, starts[:-1], inside) + [HEADING])
    marks = landmarks(parts)
    fresh = max_tokens - overlap
    out, begin, cut = [], 0, 0
    while True:
        # begin: first unit of the piece; cut: first unit that no piece holds yet
        if total[n] - total[cut] <= fresh:
            end = n
        else:
            low = int(np.searchsorted(total, total[cut] + int(fresh * MIN_SHARE)))
            high = max(int(np.searchsorted(total, total[cut] + fresh, "right")) - 1, cut + 1)
            low = min(max(low, cut + 1), high)
            k = int(np.searchsorted(marks, low))
            mark = int(marks[k]) if k < len(marks) and marks[k] <= high else high
            end = mark
            for least, reach in ((HEADING, fresh * HEADING_SHARE), (PARAGRAPH, fresh), (SENTENCE, fresh), (WORD, fresh)):
                near = np.nonzero(level[low : high + 1] >= least)[0] + low
                near = near[np.abs(total[near] - total[mark]) <= reach]
                if len(near):
                    end = int(near[np.argmin(np.abs(total[near] - total[mark]))])
                    break
        tokens = encoder.count(text[starts[begin] : starts[end]])
        while tokens > max_tokens and end > cut + 1:  # only where a long pre-token was cut
            end -= 1
            tokens = encoder.count(text[starts[begin] : starts[end]])
        while tokens > max_tokens and begin < cut:
            begin += 1
            tokens = encoder.count(text[starts[begin] : starts[end]])
        out.append((starts[begin], starts[end], tokens, encoder.count(text[starts[begin] : starts[cut]]) if begin < cut else 0))
        if end >= n:
            return out
        begin = cut = end
        first = max(int(np.searchsorted(total, total[end] - overlap)), 1)
        if first < end:
            begin = first
            for least in (SENTENCE, WORD):
                near = np.nonzero(level[first:end] >= least)[0]
                if len(near):
                    begin = first + int(near[0])
                    break


def chunk_corpus(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP,
    with_text: bool = True,
    tokenizer_dir: str = TOKENIZER_DIR,
) -> DataFrame:
    """One row per piece: key, piece_no (from 1), pieces, start_char, end_char, n_tokens, overlap_tokens and piece_text."""
    if not 0 <= overlap < max_tokens // 2:
        raise ValueError("overlap must be less than half of max_tokens")
    shared = vocabulary(df.sparkSession, tokenizer_dir)
    names = ["key", "piece_no", "pieces", "start_char", "end_char", "n_tokens", "overlap_tokens"] + ["piece_text"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        for batch in batches:
            source, rows, texts = [], [], []
            for i, value in enumerate(batch.column(1).to_pylist()):
                pieces = chunk(encoder, value, max_tokens, overlap)
                for no, piece in enumerate(pieces, 1):
                    source.append(i)
                    rows.append((no, len(pieces), *piece))
                    if with_text:
                        texts.append(value[piece[0] : piece[1]])
            columns = list(zip(*rows, strict=True)) or [()] * 6
            out = [batch.column(0).take(pa.array(source, pa.int64())), *(pa.array(c, pa.int32()) for c in columns)]
            yield pa.RecordBatch.from_arrays(out + [pa.array(texts, pa.string())] * with_text, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, " + ", ".join(f"{c} int" for c in names[1:7]) + ", piece_text string" * with_text
    return spread(df.select(df[key].alias("key"), df[text].alias("text"))).mapInArrow(run, schema).withColumnRenamed("key", key)


def oversized(df: DataFrame, key: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, **kw) -> DataFrame:
    """Keys of the texts that are cut into more than one piece.

    A token holds at least one byte, so texts of at most max_tokens bytes are left out before Python.
    """
    long = df.where(F.octet_length(df[text]) > max_tokens)
    pieces = chunk_corpus(long, key, text, max_tokens, with_text=False, **kw)
    return pieces.where("pieces > 1 and piece_no = 1").select(key)
