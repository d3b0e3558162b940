"""Repetition inside single documents (problem 3).

A document is a bag of hashed n-gram features: the hash bucket of each run of GRAM
letters and digits, with its level: said for the first time in the document, or again.
Two multinomials over buckets and levels are fitted, one to the trusted reference texts,
one to the raw texts, both smoothed towards the levels of their corpus.  The weight of a
feature is the log ratio (trusted against raw) of its level given its bucket, so what a
text is about doesn't matter, only that it is said again where trusted texts don't.  A
document's score is the sum of its weights over its number of features, with its digits
or without them, whichever recurs more, and every document is held against two scores:
those of documents of which the share SURE, or RECUR, of the features is said again.
Up to the first it is repetitive; between the two the exact share of
repeated letters and digits decides; beyond the second it is not.

Case, blanks, end marks, numbers and markup don't count, and the first statement is
not repeated content.  Defined results: null, empty and blank texts, and texts without
letters, have the share 0; texts with less than GRAM letters have no feature and are
checked exactly.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.sources.shared import spread

GRAM = 8
BUCKETS = 1 << 16
LEVELS = 2
#: Shares of features said again from which a document is repetitive without, or after, the exact check, and the least exact share of a found one.
SURE = 0.7
RECUR = 0.3
REPEATED = 0.5
#: Weight of the corpus's levels against the counts of a bucket, and least odds between the corpora at which the thresholds part the levels.
PRIOR_WEIGHT = 50.0
LEAST_RATIO = 2.0
#: Characters of the texts whose runs are held at a time; a longer text is held alone.
CHUNK_CHARS = 2_000_000
#: Distance, in letters, up to which LOOP_GRAM equal letters are a phrase that follows itself; farther apart it takes a statement's letters.
PERIOD = 80
LOOP_GRAM = 6
#: Least letters of a statement that can be said again inside a longer unit, in alphabets and in syllable or word signs.
SENTENCE, DENSE_SENTENCE = 20, 12

_NOISE = re.compile(r"[\W\d_]+")
_TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>|&\#?\w{1,8};|\\(?:begin|end|cite|ref|label)\{[^{}\n]*\}|\\[A-Za-z]+\*?|\{\{\w+\||\]\([^()\s]*\)", re.S)
_UNIT = re.compile(r"[\n|]+|(?<=[.!?])[\"'”’)\]]*\s+|(?<=[。！？])")


_GAPS = re.compile(r"[\W_]+")
_DIGITS = re.compile(r"\d+")


def signs(text: str) -> str:
    """The letters and digits of text in lower case, markup aside."""
    if "<" in text or "\\" in text or "&" in text or "[" in text or "{{" in text:
        text = _TAG.sub(" ", text)
    return _GAPS.sub("", text).lower()


def _in_loop(s: str) -> int:
    """Letters of s that belong to a phrase that just stood before, or to a statement that stood anywhere before."""
    m = len(s) - LOOP_GRAM + 1
    if m < 3:
        return 0
    grams = [s[i : i + LOOP_GRAM] for i in range(m)]
    if len(set(grams)) > 0.9 * m:
        return 0
    covered = bytearray(len(s))
    last: dict[str, int] = {}
    for i, g in enumerate(grams):
        if i - last.get(g, -PERIOD - 1) <= PERIOD:
            covered[i : i + LOOP_GRAM] = b"\1" * LOOP_GRAM
        last[g] = i
    if len(s) > PERIOD:
        size = SENTENCE if s.isascii() else DENSE_SENTENCE
        seen: set[str] = set()
        for i in range(len(s) - size + 1):
            if (g := s[i : i + size]) in seen:
                covered[i : i + size] = b"\1" * size
            seen.add(g)
    return sum(covered)


class _Said:
    """Statements of a document so far, indexed so that each is compared with few earlier ones."""

    def __init__(self) -> None:
        self.units: set[str] = set()
        self.runs: dict[int, set[str]] = {SENTENCE: set(), DENSE_SENTENCE: set()}
        self.grams: set[str] = set()
        self.ends: dict[tuple, list[str]] = {}

    @staticmethod
    def _half(n: int) -> int:
        """Letters at one end that a unit of n letters shares with a copy in which one run of up to 3 is misread."""
        return 1 << (max(n - 6, 2) // 2).bit_length() - 1

    def add(self, s: str, grams: set[str]) -> None:
        self.units.add(s)
        self.grams |= grams
        for size, runs in self.runs.items():
            runs.update(s[i : i + size] for i in range(len(s) - size + 1))
        for h in {self._half(len(s) + d) for d in (-3, 0, 3)}:
            self.ends.setdefault((s[:h], True), []).append(s)
            self.ends.setdefault((s[-h:], False), []).append(s)

    def inside(self, s: str) -> bool:
        """Whether all runs of a statement's length of s were said before, as when it stood in a longer unit; a few words alone are no statement."""
        size = SENTENCE if s.isascii() else DENSE_SENTENCE
        runs = self.runs[size]
        return len(s) >= size and all(s[i : i + size] in runs for i in range(len(s) - size + 1))

    def near(self, s: str, grams: set[str]) -> bool:
        """Whether an earlier unit equals s but for one misread run of letters."""
        if len(s) < 20 or len(grams - self.grams) > 6:
            return False
        h = self._half(len(s))
        return any(_one_run_apart(s, o) for o in {*self.ends.get((s[:h], True), ()), *self.ends.get((s[-h:], False), ())})


def repeated_share(text: str | None) -> float:
    """Share of the characters of text, markup and blanks aside, that repeat what stood earlier in it."""
    if not text:
        return 0.0
    said = _Said()
    again = total = 0
    for unit in _UNIT.split(_TAG.sub(" ", text)):
        if not unit:
            continue
        full = _GAPS.sub("", unit).lower()
        size = len("".join(unit.split()))
        s = _NOISE.sub("", full) or full  # numbers don't matter but where there is nothing else
        if not s:
            continue
        total += size
        if s in said.units or said.inside(s):
            again += size
            continue
        loop = size * max(_in_loop(full) / len(full), _in_loop(s) / len(s))
        again += loop
        grams = {s[i : i + 5] for i in range(len(s) - 4)}
        if loop * 2 < size and said.near(s, grams):
            again += size - loop
        said.add(s, grams)
    return again / total if total else 0.0


def _one_run_apart(s: str, other: str) -> bool:
    if abs(len(other) - len(s)) > 3:
        return False
    head = next((i for i, (a, b) in enumerate(zip(s, other)) if a != b), min(len(s), len(other)))
    rest, ahead = s[head:][::-1], other[head:][::-1]
    tail = next((i for i, (a, b) in enumerate(zip(rest, ahead)) if a != b), min(len(rest), len(ahead)))
    return head + tail >= len(s) - 3


def _runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, count) of every different run of GRAM signs of each text."""
    return _plain_runs([signs(t) for t in texts])


def _plain_runs(plain: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in plain], np.int64)
    codes = np.frombuffer("".join(plain).encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(codes) - GRAM + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    h = np.zeros(n, np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    doc = np.repeat(np.arange(len(plain), dtype=np.uint64), sizes)[:n]
    last = np.repeat(np.cumsum(sizes), sizes)[:n]
    inside = np.arange(n) + GRAM <= last  # runs that don't cross into the next text
    keys = np.sort((doc[inside] << np.uint64(40)) | (h[inside] >> np.uint64(24)))
    first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0] if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    own = keys[first]
    return (own >> np.uint64(40)).astype(np.int64), (own & np.uint64(BUCKETS - 1)).astype(np.int64), counts


def _by_level(counts: np.ndarray) -> list[np.ndarray]:
    """How often a run that occurs so often is a feature of each level."""
    return [np.ones_like(counts), counts - 1]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(start, end) of the texts that are held at a time."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _counted(texts: Counter[str]) -> np.ndarray:
    """Occurrences of each feature (level * BUCKETS + bucket) in texts, each taken as often as it is counted."""
    total = np.zeros(LEVELS * BUCKETS)
    every = list(texts)
    for start, end in _chunks(every):
        doc, bucket, counts = _runs(every[start:end])
        if len(doc):
            times = np.array([texts[t] for t in every[start:end]], np.int64)[doc]
            for level, share in enumerate(_by_level(counts)):
                total[level * BUCKETS : (level + 1) * BUCKETS] += np.bincount(bucket, share * times, BUCKETS)
    return total.astype(np.int64)


def feature_counts(df: DataFrame, raw: str, trusted: str) -> DataFrame:
    """(feature, raw, trusted) over all texts of both columns; feature = level * BUCKETS + bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(LEVELS * BUCKETS, np.int64) for _ in range(2)]
        for batch in batches:
            for i, total in enumerate(totals):
                total += _counted(Counter(t for t in batch.column(i).to_pylist() if t))
        seen = np.flatnonzero(totals[0] | totals[1])
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), *(pa.array(t[seen]) for t in totals)], ["feature", "raw", "trusted"])

    counted = spread(df.select(df[raw].alias("raw"), df[trusted].alias("trusted"))).mapInArrow(run, "feature int, raw long, trusted long")
    return counted.groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


def weights(trusted: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio (trusted against raw) of the level of each feature given its bucket, and the same over all buckets."""
    logs, whole = [], []
    for counts in (trusted, raw):
        by_level = counts.reshape(LEVELS, BUCKETS).astype(float)
        prior = (by_level.sum(1) + 1) / (by_level.sum() + LEVELS)
        whole.append(np.log(prior))
        logs.append(np.log((by_level + PRIOR_WEIGHT * prior[:, None]) / (by_level.sum(0) + PRIOR_WEIGHT)))
    return (logs[0] - logs[1]).ravel(), whole[0] - whole[1]


def fit(df: DataFrame, raw: str, trusted: str) -> tuple[np.ndarray, float, float]:
    """Feature weights, and the scores of documents of which the shares SURE and RECUR of the features are said again.

    LEVELS * BUCKETS counts of each corpus reach the driver, whatever its size.  A corpus that repeats no more than the
    trusted one tells the levels apart by LEAST_RATIO.
    """
    counts = np.zeros((2, LEVELS * BUCKETS), np.int64)
    for r in feature_counts(df, raw, trusted).collect():
        counts[:, r.feature] = r.trusted, r.raw
    w, (first, again) = weights(*counts)
    lift = min(first - np.log(LEAST_RATIO) - again, 0.0)
    w[BUCKETS:] += lift
    again += lift
    return w, float((1 - SURE) * first + SURE * again), float((1 - RECUR) * first + RECUR * again)


def _scores(plain: list[str], w: np.ndarray) -> np.ndarray:
    out = np.full(len(plain), np.inf)
    for start, end in _chunks(plain):
        doc, bucket, counts = _plain_runs(plain[start:end])
        if len(doc):
            total = np.bincount(doc, counts, end - start)
            value = sum(np.bincount(doc, share * w[level * BUCKETS + bucket], end - start) for level, share in enumerate(_by_level(counts)))
            out[start:end] = np.where(total > 0, value / np.maximum(total, 1), np.inf)
    return out


def scores(texts: list[str], w: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood ratio of each text; infinite for texts without a run of GRAM letters.

    A running number must not hide a repeated statement, and a number that follows itself is repeated too: the lower score counts.
    """
    plain = [signs(t) for t in texts]
    letters = [_DIGITS.sub("", p) for p in plain]
    score = _scores(plain, w)
    fewer = [i for i, (p, q) in enumerate(zip(plain, letters, strict=True)) if len(p) > len(q)]
    score[fewer] = np.minimum(score[fewer], _scores([letters[i] for i in fewer], w))
    return score


def repetition(df: DataFrame, key: str = "result_id", text: str = "prediction", trusted: str = "ground_truth", all_shares: bool = False, least: float = REPEATED) -> DataFrame:
    """(key, score, verdict, share, repetitive): verdict is repetitive, borderline or sound by the score; share is exact for borderline rows, for all rows with all_shares, else null."""
    w, sure, recur = fit(df, text, trusted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            score = scores(texts, w)
            border = (score > sure) & (score <= recur) | np.isinf(score)
            share = [repeated_share(t) if b or all_shares else None for t, b in zip(texts, border.tolist(), strict=True)]
            verdict = np.where(border, "borderline", np.where(score <= sure, "repetitive", "sound"))
            found = [v == "repetitive" or v == "borderline" and s >= least for v, s in zip(verdict.tolist(), share, strict=True)]
            score = np.where(np.isfinite(score), np.round(score, 6), np.nan)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64(), from_pandas=True), pa.array(verdict.tolist(), pa.string()), pa.array(share, pa.float64()), pa.array(found, pa.bool_())],
                ["key", "score", "verdict", "share", "repetitive"],
            )

    kind = df.schema[key].dataType.simpleString()
    out = spread(df.select(df[key].alias("key"), df[text].alias("text"))).mapInArrow(run, f"key {kind}, score double, verdict string, share double, repetitive boolean")
    return out.withColumnRenamed("key", key)


def repetitive(df: DataFrame, key: str = "result_id", text: str = "prediction", trusted: str = "ground_truth", least: float = REPEATED) -> DataFrame:
    """Keys of the texts that the score, or in doubt the exact share of at least ``least``, calls repetitive."""
    return repetition(df, key, text, trusted, least=least).where("repetitive").select(key)
