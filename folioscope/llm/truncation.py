"""Texts cut off by field limits or in transfer (problem 7).

For each source, and for lengths in characters and in bytes, a lognormal length
distribution is fitted by maximum likelihood to the lengths of the different texts, which
may be right-censored at limits where they pile up; a limit's censoring posterior is the
share of the texts of that length that the uncensored distribution doesn't explain.  It is
combined, as log odds, with the evidence of the ending: where the text's last
characters stand in the reference text, and whether that place is inside a word or
sentence or at its end.  Without a reference text (null, or no such column) the ending
itself is the evidence: a text that ends at a stop mark or with a block isn't cut, any other
is cut if its length is a limit.

Defined results: null and blank texts, and rows with a blank reference text, aren't
cut; a text that stops at the end of a sentence or block isn't cut, at whatever
length; a null source is a source of its own; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.canonical import Normaliser
from folioscope.llm.repetition import signs
from folioscope.sources.shared import spread

#: A length is a candidate limit if it is that frequent, and that many times as frequent as the lengths around it.
LEAST_AT_LIMIT = 5
PILE = 6.0
#: Log odds of being cut by the place where the text stops in its reference; open and closed are endings without a place.
EVIDENCE = {"inside": 5.0, "natural": -12.0, "complete": -12.0, "unaligned": -1.5, "elsewhere": -8.0, "none": -12.0, "open": -2.0, "closed": -12.0}

_MARK = re.compile(r"(?:\s|\.\.\.|…|�|\[(?:…|\.\.\.|cut|truncated)\]|[-–—~|\\&<{(\[])+$")
_CLOSERS = re.compile(r"(?:[ \t]|</[A-Za-z][A-Za-z0-9]*>|<br ?/?>|\*{1,3}|_{1,2}|`+|~~|\}+|\]\]|'{2,3}|[\"”’」』)\]]|\||\\\\)*[ \t]*(?=\n|$)")
_STOP = re.compile(r"[.!?…。！？][\"'”’」』)\]*_]*$")
_TAILS = (14, 8, 5)
#: Characters within which the shortest tail must stand where it is expected if the last signs don't fit.
FEW_SIGNS_REACH = 24
#: Marks of a page's end that hold no text, and a stop that is neither an ellipsis nor a decimal point.
_BARE_END = re.compile(r"</?[A-Za-z][^<>]*>|\\(?:end|begin)\{[^{}\n]*\}")
_REAL_STOP = re.compile(r"(?:(?<![.\d])\.|[!?。！？])[\"'”’」』)\]*_]*$")
_SPACE = re.compile(r"\s+")
#: Last characters that are searched with misread ones, those of which a share must stand in the page, and that share.
TAIL = 20
END_CHARS = 240
ALIKE = 0.4
#: A text of whose end less than this share stands in the page is no part of it.
STRANGE = 0.1
#: The end of a block: a row or cell border, a fence, a closing tag or brace.
_BLOCK_END = re.compile(r"(?:\||```|~~~|>|\}|\$\$|\\\])\s*$")


def _place(text: str, page: str) -> int | None:
    """Where in page the end of text stands: the occurrence of its tail nearest to the expected place."""
    for drop in range(4):  # last characters that the reader got wrong
        kept, lost = text[: len(text) - drop], text[len(text) - drop :]
        skip = drop if any(c.isalnum() for c in lost) else 0
        for size in _TAILS:
            if len(kept) < size:
                continue
            tail, near = kept[-size:], None
            reach = 0.35 * len(page) + 60 if size > 5 else 30 + 0.05 * len(page) if not drop else FEW_SIGNS_REACH
            at = page.find(tail)
            while at >= 0:
                end = at + size + skip
                if near is None or abs(end - len(text)) < abs(near - len(text)):
                    near = end
                at = page.find(tail, at + 1)
            if near is not None and abs(near - len(text)) <= reach:
                return min(near, len(page))
    return None


def quoted(text: str, page: str) -> float:
    """Share of the runs of 7 characters of text that stand in page."""
    text, page = _SPACE.sub(" ", text), _SPACE.sub(" ", page)
    runs = [text[i : i + 7] for i in range(0, max(len(text) - 6, 1), 3)]
    return sum(r in page for r in runs) / len(runs)


def standing(text: str, page: str) -> float:
    """Share of the different runs of 7 letters and digits of text that stand in page, markup aside; said again counts once."""
    text, page = signs(fold(text)), signs(fold(page))
    runs = {text[i : i + 7] for i in range(0, max(len(text) - 6, 1), 3)}
    return sum(r in page for r in runs) / len(runs)


def _near_place(text: str, page: str) -> int | None:
    """Where the end of text stands in page with up to a fifth of its last characters misread (bit-parallel edit distance)."""
    tail = text[-TAIL:]
    m, reach = len(tail), int(0.35 * len(page)) + 60
    low = max(0, len(text) - TAIL - reach)
    masks: dict[str, int] = {}
    for i, ch in enumerate(tail):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best: tuple[int, int] | None = None
    for at in range(low, min(len(page), len(text) + reach)):
        eq = masks.get(page[at], 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        score += (ph & top > 0) - (mh & top > 0)
        ph = ph << 1 & full
        mh = mh << 1 & full
        plus = mh | ~(xv | ph) & full
        minus = ph & xv
        rank = (score, abs(at + 1 - len(text)))
        if score * 5 <= m and (best is None or rank < best[:2]):
            best = (*rank, at + 1)
    return best[2] if best else None


def own_ending(text: str) -> str:
    """open or closed: whether text stops without a stop mark or the end of a block; none if nothing stands in it."""
    text = text.rstrip()
    if not any(c.isalnum() for c in text):
        return "none"
    if _BLOCK_END.search(text):
        return "closed"
    return "closed" if _STOP.search(text) and _MARK.sub("", text) == text else "open"


def ending(text: str | None, page: str | None, fold=lambda s: s) -> str:
    """Where text stops in page: none, complete, natural, inside; without such a place closed, unaligned (its end is much like the page) or elsewhere; open or closed without a page."""
    if not text or page == "":
        return "none"
    if page is None:
        return own_ending(fold(text))
    if text == page:
        return "complete"
    text, page = fold(text).rstrip(), fold(page).rstrip()
    if not text or not page:
        return "none"
    if text[-12:] == page[-12:]:
        return "complete"
    bare = _MARK.sub("", text)
    options = [text] if bare == text else [text, bare]
    for option in options:
        if len(option) < 5:
            continue
        at, misread = _place(option, page), False
        if at is None and option is options[-1] and len(option) > TAIL and quoted(option[-END_CHARS:], page) >= ALIKE:
            at, misread = _near_place(option, page), True
        if at is None:
            continue
        rest = page[at:]
        left = _BARE_END.sub("", rest)
        if not any(c.isalpha() for c in left) and sum(c.isalnum() for c in left) <= 2:  # at most a raised digit goes on
            return "complete"
        if misread and _REAL_STOP.search(text):  # the place is known but roughly, the end of the sentence is seen
            return "natural"
        if _CLOSERS.match(rest):
            return "natural"
        before = page[:at]
        line = before[before.rfind("\n") + 1 :]
        if not any(c.isalnum() for c in line):
            return "natural"
        if _STOP.search(before) and (before.rstrip("\"'”’」』)]*_")[-1:] in "。！？" or rest[0].isspace() or rest[0] in "<*_"):
            return "natural"
        end = option[-END_CHARS:]
        return "inside" if quoted(end, page) >= ALIKE or standing(end, page) >= ALIKE else "unaligned"
    if own_ending(text) == "closed":
        return "closed"
    return "unaligned" if quoted(bare[-END_CHARS:] or text, page) >= STRANGE else "elsewhere"


def _tail_mean(z: np.ndarray) -> np.ndarray:
    """Mean excess of the standard normal beyond z (inverse Mills ratio)."""
    from math import erfc, exp, pi, sqrt

    out = []
    for x in z:
        q = 0.5 * erfc(x / sqrt(2))
        out.append(exp(-x * x / 2) / sqrt(2 * pi) / q if q > 1e-12 else x + 1 / max(x, 1.0))
    return np.array(out)


def censoring(lengths: np.ndarray, counts: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Candidate limits among the lengths and the censoring posterior at each, by expectation maximisation."""
    lengths, counts = lengths[lengths > 0], counts[lengths > 0]
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(float), counts[order].astype(float)
    total = np.concatenate([[0], np.cumsum(counts)])
    low, high = np.searchsorted(lengths, lengths * 0.9), np.searchsorted(lengths, lengths * 1.1, "right")
    around = (total[high] - total[low] - counts) / np.maximum(lengths * 0.2, 1)
    limit = (counts >= LEAST_AT_LIMIT) & (counts >= PILE * np.maximum(around, 0.25))
    share = np.where(limit, 1 - np.minimum(around / counts, 1), 0.0)
    if not limit.any():
        return lengths[limit], share[limit]
    logs = np.log(lengths)
    for _ in range(rounds):
        free = counts * (1 - share)
        if free.sum() < 2:
            break
        mu = np.average(logs, weights=np.maximum(free, 1e-9))
        sigma = max(np.sqrt(np.average((logs - mu) ** 2, weights=np.maximum(free, 1e-9))), 0.05)
        for _ in range(5):  # censored values stand for what lies beyond their limit
            z = (logs[limit] - mu) / sigma
            mills = _tail_mean(z)
            held = (counts * share)[limit]
            first = mu + sigma * mills
            second = sigma**2 * (1 + z * mills) + 2 * mu * first - mu**2
            n = free.sum() + held.sum()
            new = (free @ logs + held @ first) / n
            sigma = max(np.sqrt(max((free @ logs**2 + held @ second) / n - new**2, 0)), 0.05)
            mu = new
        density = np.exp(-(((logs - mu) / sigma) ** 2) / 2) / (sigma * np.sqrt(2 * np.pi) * lengths)
        share = np.where(limit, np.clip(1 - density * counts.sum() / np.maximum(counts, 1), 0.0, 0.999), 0.0)
    return lengths[limit], share[limit]


def limits(df: DataFrame, source: str, text: str) -> DataFrame:
    """(source, unit, length, rows, posterior): candidate limits of each source; only length counts are gathered.

    Copies of a text count once: a stock phrase sent a thousand times makes no limit.
    """
    sized = df.where(df[text].isNotNull()).select(df[source].alias("source"), F.char_length(df[text]).alias("chars"), F.octet_length(df[text]).alias("bytes"), F.xxhash64(df[text]).alias("copy"))
    long = sized.distinct().groupBy("source", "chars", "bytes").agg(F.count("*").alias("n"))
    long = long.select("source", F.inline(F.array(*(F.struct(F.lit(u).alias("unit"), F.col(u).alias("length"), "n") for u in ("chars", "bytes")))))
    counts = long.groupBy("source", "unit", "length").agg(F.sum("n").alias("n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        at, share = censoring(pdf["length"].to_numpy(), pdf["n"].to_numpy())
        rows = pdf.set_index("length")["n"].reindex(at.astype(int)).to_numpy()
        return pd.DataFrame({"source": pdf["source"].iloc[0], "unit": pdf["unit"].iloc[0], "length": at.astype("int32"), "rows": rows, "posterior": share})

    return counts.groupBy("source", "unit").applyInPandas(fit, "source string, unit string, length int, rows long, posterior double")


_FOLD: list[Normaliser] = []


@lru_cache(8)  # the rules ask for a pair's texts again
def fold(text: str) -> str:
    """Look-alikes in one form, with this worker's table; kanji and katakana stay apart, which saves a pass over Japanese texts."""
    if not _FOLD:
        _FOLD.append(Normaliser(kana=False))
    return text if text.isascii() else _FOLD[0].classes(text)


def endings(df: DataFrame, key: str, source: str, text: str, page: str | None) -> DataFrame:
    """(key, source, chars, bytes, stops): where each text stops in its reference, or how it stops without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stops = [ending(a, b, fold) for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(stops, pa.string())], ["key", "source", "chars", "bytes", "stops"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(df[key].alias("key"), df[source].alias("source"), F.char_length(df[text]).alias("chars"), F.octet_length(df[text]).alias("bytes"), df[text].alias("text"), (df[page] if page else F.lit(None).cast("string")).alias("page"))
    return spread(rows).mapInArrow(run, f"key {kind}, source string, chars int, bytes int, stops string")


def with_limits(rows: DataFrame, at: DataFrame) -> DataFrame:
    """rows (source, chars, bytes, stops, ...) with the posterior of their length and the log odds of being cut."""
    at = at.groupBy("source", "length").pivot("unit", ["chars", "bytes"]).agg(F.max("posterior"))
    at = at.select(F.col("source").alias("s"), F.col("length").alias("l"), F.col("chars").alias("pc"), F.col("bytes").alias("pb"))
    for unit, p in (("chars", "pc"), ("bytes", "pb")):
        same = F.col("source").eqNullSafe(F.col("s")) & (F.col(unit) == F.col("l"))
        rows = rows.join(at.select("s", "l", p).where(F.col(p).isNotNull()), same, "left").drop("s", "l")
    p = F.greatest(F.coalesce("pc", F.lit(0.0)), F.coalesce("pb", F.lit(0.0)))
    odds = F.create_map(*(F.lit(x) for pair in EVIDENCE.items() for x in pair))[F.col("stops")]
    # A length that is hardly a limit speaks no more against a cut than one that is none.
    odds = odds + F.greatest(F.when(p > 0, F.log(p / (1 - p))).otherwise(0.0), F.lit(0.0))
    return rows.withColumn("posterior", p).withColumn("log_odds", F.round(odds, 6)).drop("pc", "pb")


def truncation(df: DataFrame, key: str = "result_id", source: str = "model_id", text: str = "prediction", page: str | None = "ground_truth") -> DataFrame:
    """(key, source, stops, posterior, log_odds, cut) of every row."""
    rows = with_limits(endings(df, key, source, text, page), limits(df, source, text))
    return rows.select(F.col("key").alias(key), F.col("source").alias(source), "stops", "posterior", "log_odds", (F.col("log_odds") > 0).alias("cut"))


def truncated_share(df: DataFrame, source: str = "model_id", **kw) -> DataFrame:
    """Rows, cut rows and the share of cut rows of each source."""
    rows = truncation(df, source=source, **kw).groupBy(source)
    out = rows.agg(F.count("*").alias("rows"), F.count_if("cut").alias("cut_rows"))
    return out.withColumn("cut_share", F.round(F.col("cut_rows") / F.col("rows"), 6))
