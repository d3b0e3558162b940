"""Evaluation passages inside a training corpus (problem 9).

A positional inverted index of the whole corpus is stored once, for any test set: the
postings (unit, term, uid, position) of its terms.  Terms are runs of SHINGLE words (unit
w) and of GRAM letters and digits (unit c, for ko and ja, where blanks don't part words).  Of
every window of half as many terms as the least run that counts, the term of the least hash
is posted, so a run of the least length posts the same terms wherever it stands, two or
more of them.

Of each test passage every run of the least length is looked up by its two rarest
posted terms: the positions of the rarest, adjusted by its offset, are places where the passage
could begin, and those are kept where the second term stands within ``slack`` of its
offset.  A run with a posted term that the corpus lacks is nowhere.  The documents of these
places are read, and the passage is laid on each place: the longest run of equal
terms is the exact phrase, and terms within ``slack`` of their offset are proximity matches.

Case, blanks, line breaks, punctuation and markup don't count.  Defined results:
null and empty texts and passages match nothing; passages shorter than the least
run match nothing; documents with equal keys are searched each for itself and
reported once per key and item; an item key that repeats is searched with each passage.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.sources.shared import spread, stored

MIN_WORDS = 12
MIN_CHARS = 40
SHINGLE = 3
GRAM = 6
UNSPACED = ("ko", "ja", "zh")
#: Characters of the texts that are indexed at a time; a longer text is indexed alone.
CHUNK_CHARS = 2_000_000
#: Most documents with a place whose hashes are broadcast (67 bytes each, measured near this number); more are joined by a shuffle.
BROADCAST_DOCUMENTS = 2_000_000
#: Bits of the hash that names a document in the postings; documents of one name are told apart when they are read.
UID_BITS = 40

_MARKUP = re.compile(
    r"<!--.*?-->|</?[A-Za-z][^<>]*>|&\#?\w{1,8};|\]\([^()\s]*\)|\[\[[^\[\]|\n]*\||\{\{\w+\||"
    r"\\(?:cite|ref|label|begin|end|href|url)\{[^{}\n]*\}|\\[A-Za-z]+\*?",
    re.S,
)
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Letters and digits of text without markup, in lower case and compatibility form."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", "".join(c for c in text if unicodedata.category(c) != "Cf") if _INVISIBLE.search(text) else text)
    if "<" in text or "\\" in text or "&" in text or "[" in text or "{{" in text:
        text = _MARKUP.sub(" ", text)
    return _WORD.findall(text.lower())


_INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]")


def _least(own: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """For each window inside one of the documents laid end to end, the place of its least term; the first of equals."""
    n = len(own)
    if n < window:
        return np.zeros(0, np.int64)
    low = own.astype(np.uint64) << np.uint64(32) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= window:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if window > span:
        low = np.minimum(low[: n - window + 1], low[window - span : n - span + 1])
    end = np.repeat(np.cumsum(sizes), sizes)[: n - window + 1]
    return (low[np.arange(n - window + 1) + window <= end] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _runs(own: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``length`` signs that don't cross documents, and the runs of each document."""
    n = max(len(own) - length + 1, 0)
    h = np.zeros(n, np.uint64)
    for k in range(length if n else 0):
        h = h * np.uint64(0x9E3779B97F4A7C15) + own[k : k + n].astype(np.uint64)
        h ^= h >> np.uint64(31)
    end = np.repeat(np.cumsum(sizes), sizes)[:n]
    return (h[np.arange(n) + length <= end] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32), np.maximum(sizes - length + 1, 0)


def _terms(parts: list[list[str]], unit: str) -> tuple[np.ndarray, np.ndarray]:
    """Terms of documents given by their words, laid end to end, and their number in each document."""
    if unit == "w":
        signs = [[zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words] for words in parts]
        return _runs(np.fromiter((h for words in signs for h in words), np.uint64), np.array([len(p) for p in parts], np.int64), SHINGLE)
    streams = ["".join(words) for words in parts]
    own = np.frombuffer("".join(streams).encode("utf-32-le", "surrogatepass"), np.uint32)
    return _runs(own, np.array([len(x) for x in streams], np.int64), GRAM)


def _half(unit: str, least: int) -> int:
    """Terms in half a run of ``least`` words or signs."""
    return max((least - (SHINGLE if unit == "w" else GRAM) + 1) // 2, 1)


def posted(parts: list[list[str]], unit: str, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position, term) of the posted terms of documents given by their words; least counts words or signs."""
    terms, counts = _terms(parts, unit)
    at = np.unique(_least(terms, counts, _half(unit, least)))
    first = np.concatenate([[0], np.cumsum(counts)])
    doc = np.searchsorted(first, at, "right") - 1
    return doc, at - first[doc], terms[at].astype(np.uint32).view(np.int32)


def _uid(key, text):
    return F.shiftrightunsigned(F.xxhash64(key, text), 64 - UID_BITS)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(unit, term, uid, pos): the stored postings of all documents, for test runs of at least min_words words or min_chars letters and digits.

    No posting is shuffled: each task writes those of its documents, sorted by term in runs.
    """
    if min_words < SHINGLE or min_chars < GRAM:
        raise ValueError(f"a run holds at least {SHINGLE} words or {GRAM} letters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= CHUNK_CHARS):
                    size += len(texts[end])
                    end += 1
                parts = [words(t) for t in texts[start:end]]
                for unit, least in (("w", min_words), ("c", min_chars)):
                    doc, at, term = posted(parts, unit, least)
                    order = np.argsort(term, kind="stable")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([unit] * len(order), pa.string()), pa.array(term[order]), pa.array(uids[start:end][doc[order]], pa.int64()), pa.array(at[order].astype(np.int32))],
                        ["unit", "term", "uid", "pos"],
                    )
                start = end

    rows = docs.where(F.length(docs[text]) > 0).select(_uid(docs[key], docs[text]).alias("uid"), docs[text].alias("text"))
    return stored(spread(rows).mapInArrow(run, "unit string, term int, uid long, pos int"), "postings")


def _windows(items: DataFrame, min_words: int, min_chars: int) -> DataFrame:
    """(no, unit, window, term, offset): the terms that every different run of the least length of the passages (no, passage, unit) posts wherever it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, unit_of, window, term_of, offsets = [], [], [], [], []
            for row, (passage, unit) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                parts = words(passage)
                least, length = (min_chars, GRAM) if unit == "c" else (min_words, SHINGLE)
                whole = len("".join(parts)) if unit == "c" else len(parts)
                terms, counts = _terms([parts], unit)
                half = _half(unit, least)
                low = _least(terms, counts, half)
                seen = set()
                for start in range(whole - least + 1):
                    at = tuple(np.unique(low[start : start + least - length - half + 2]).tolist())
                    if at not in seen:
                        seen.add(at)
                        source += [row] * len(at)
                        unit_of += [unit] * len(at)
                        window += [start] * len(at)
                        term_of += terms[list(at)].astype(np.uint32).view(np.int32).tolist()
                        offsets += at
            at_row = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at_row), pa.array(unit_of, pa.string()), pa.array(window, pa.int32()), pa.array(term_of, pa.int32()), pa.array(offsets, pa.int32())],
                ["no", "unit", "window", "term", "offset"],
            )

    return items.mapInArrow(run, "no long, unit string, window int, term int, offset int")


@lru_cache(4)
def _parts(text: str) -> list[str]:
    return words(text)


def laid_on(text: str, passage: str, unit: str, starts: list[int], slack: int) -> tuple[int, int, int]:
    """(longest run, near matches, terms of the passage), the best of the places where the passage may begin in text."""
    doc, own = _parts(text), _parts(passage)
    if unit == "c":
        stream, whole = "".join(doc), "".join(own)
        doc, own = ([x[i : i + GRAM] for i in range(len(x) - GRAM + 1)] for x in (stream, whole))
    best = (0, 0)
    for start in starts:
        longest = run = near = 0
        for offset, term in enumerate(own):
            at = start + offset
            run = run + 1 if 0 <= at < len(doc) and doc[at] == term else 0
            longest = max(longest, run)
            near += run > 0 or term in doc[max(at - slack, 0) : max(at + slack + 1, 0)]
        best = max(best, (longest, near))
    return (best[0] + (GRAM - 1 if unit == "c" and best[0] else 0), best[1], len(own))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    passage: str = "passage",
    lang: str = "lang_code",
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
    slack: int = 2,
    index: DataFrame | None = None,
) -> DataFrame:
    """(key, item_key, unit, longest_run, near_matches, passage_terms), one row per document and item that share the two rarest terms of a window in place.

    longest_run counts consecutive words (unit 'w') or letters and digits (unit 'c') of the passage;
    near_matches counts the passage's terms found within ``slack`` places of their offset.
    index: postings of docs by ``build_index`` with the same key, text and least runs; built here if it isn't given.
    """
    index = build_index(docs, key, text, min_words, min_chars) if index is None else index
    unit = F.when(F.substring(F.lower(F.trim(items[lang])), 1, 2).isin(*UNSPACED), "c").otherwise("w")
    wanted = items.where(F.length(items[passage]) > 0).select(items[item_key].alias("item"), items[passage].alias("passage"), unit.alias("unit")).distinct()
    # Passages go by number: a text that is repeated in every row is small in Parquet, by which the planner broadcasts, and large in memory.
    wanted = stored(wanted.withColumn("no", F.monotonically_increasing_id()), "passages")
    windows = stored(_windows(wanted.select("no", "passage", "unit"), min_words, min_chars), "windows")
    terms = windows.select("unit", "term").distinct()
    frequency = index.join(terms, ["unit", "term"], "left_semi").groupBy("unit", "term").agg(F.count("*").alias("df"))
    # The two rarest terms of each run; a run with a term that the corpus lacks is nowhere.
    ranked = windows.join(frequency, ["unit", "term"], "left").groupBy("no", "unit", "window")
    ranked = ranked.agg(F.min(F.coalesce("df", F.lit(0))).alias("least"), F.slice(F.sort_array(F.collect_list(F.struct("df", "offset", "term"))), 1, 2).alias("t")).where("least > 0")
    pairs = ranked.select("no", "unit", F.col("t")[0]["term"].alias("term"), F.col("t")[0]["offset"].alias("offset"), F.try_element_at("t", F.lit(2)).alias("second")).distinct()
    pairs = stored(pairs, "rarest")
    rare = pairs.select("unit", "term").union(pairs.select("unit", F.col("second.term"))).where("term is not null").distinct()
    lists = stored(index.join(rare, ["unit", "term"], "left_semi"), "lists")
    # Offset-adjusted positions of the rarest term, kept where the second stands in place.
    places = lists.join(pairs, ["unit", "term"]).withColumn("start", F.col("pos") - F.col("offset")).drop("pos", "term", "offset")
    # What grows with the corpus is joined by a shuffle, whatever its files' size.
    other = lists.select("unit", F.col("term").alias("term2"), "uid", F.col("pos").alias("pos2")).hint("merge")
    places = places.select("unit", "uid", "no", "start", F.col("second.term").alias("term2"), F.col("second.offset").alias("offset2"))
    alone = places.where("term2 is null").drop("term2", "offset2", "unit")
    both = places.join(other, ["unit", "term2", "uid"]).where(F.abs(F.col("pos2") - F.col("start") - F.col("offset2")) <= slack).select(alone.columns)
    found = alone.union(both).groupBy("uid", "no").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    found = stored(found, "places")
    own = docs.select(_uid(docs[key], docs[text]).alias("uid"), docs[key].alias("key"), docs[text].alias("text"))
    names = found.select("uid").distinct()
    if names.count() <= BROADCAST_DOCUMENTS:
        own = own.join(F.broadcast(names), "uid", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [laid_on(*x, slack) for x in zip(*(batch.column(i).to_pylist() for i in (3, 4, 2, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, pa.int32()) for c in list(zip(*rows, strict=True)) or [()] * 3)], out)

    out = ["key", "item", "unit", "longest_run", "near_matches", "passage_terms"]
    kinds = [docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()]
    laid = own.join(found.join(wanted, "no").hint("merge"), "uid").select("key", "item", "unit", "text", "passage", "starts")
    laid = laid.mapInArrow(run, f"key {kinds[0]}, item {kinds[1]}, unit string, longest_run int, near_matches int, passage_terms int").where("longest_run > 0")
    best = laid.groupBy("key", "item", "unit").agg(F.max(F.struct("longest_run", "near_matches", "passage_terms")).alias("b"))
    return best.select(F.col("key").alias(key), F.col("item").alias(item_key), "unit", "b.*")


def leaked(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS, **kw) -> DataFrame:
    """Documents and the items that leaked into them as a phrase of the least length."""
    found = find_leaks(docs, items, min_words=min_words, min_chars=min_chars, **kw)
    least = F.when(F.col("unit") == "c", min_chars).otherwise(min_words)
    return found.where(F.col("longest_run") >= least).select(kw.get("key", "doc_id"), kw.get("item_key", "item_id")).distinct()
