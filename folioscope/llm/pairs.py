"""Defective prompt and response pairs (problem 6).

The different responses to one page, and the page itself, are sorted by text; a
response that is a prefix of its successor is a shortened version of it.  Length
limits come from the piles in each source's lengths (see truncation).  Rules for
empty answers, service messages, refusals, copied prompts and languages are applied, and
the first defect that fits is given.  The sorted neighbours are needed, and read, only for pages
with a response of which neither a rule nor the page itself tells where it stops.

Defined results: rows without reference content have no defect but a service
message or refusal; null, blank and invisible answers are empty; a null prompt is
never copied; repeated rows give repeated results.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm import truncation
from folioscope.llm.truncation import ALIKE, ending, fold, quoted, standing
from folioscope.sources.shared import spread, stored

DEFECTS = ("empty", "error_text", "refusal", "copied_prompt", "wrong_language", "truncated")

#: A longer text is a message or refusal only if it neither gives the page nor may be a page in another language, or says so in its first line.
MESSAGE_CHARS = 600
#: Share of a message's runs of characters that may also stand in the page.
QUOTED = 0.34

#: Characters of a response by which a page's responses are split before they are sorted.
HEAD = 16
#: Log odds that a longer neighbour adds to a cut.
NEIGHBOUR = 2.0
#: Most pages with undecided responses that are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_PAGES = 4_000_000

#: Words that stand for nothing.
PLACEHOLDERS = set("null none nil nan na n/a empty blank undefined void nothing missing 없음 무 빈칸 なし 無し 空 空白 該当なし 해당없음 notext nocontent notavailable noresponse nooutput noanswer".split())

ERROR = re.compile(
    r"\bHTTP(?:/\d\S*)?\s*\d{3}\b|<title>\s*[45]\d\d|\b[45]\d\d\s+(?:Bad Gateway|Service Unavailable|Internal Server Error|Gateway Time-?out|Too Many Requests|Forbidden|Not Found)"
    r"|\b(?:Service Unavailable|Bad Gateway|Internal server error|Gateway Time-?out|rate limit(?:ed| reached| exceeded)?|too many requests|out of (?:device )?memory|ran out of memory|timed? ?out|connection (?:reset|refused|aborted|error)|worker (?:crashed|lost)|exit code \d+|retry later)\b"
    r"|Traceback \(most recent|\b\w*(?:Error|Exception)\b\s*[:(]|^\s*(?:error|fatal|failed|failure)\b\s*[:\-]|[\"']error[\"']\s*:|^\s*\[(?:backend|server|api|worker|error)\]|request id\b",
    re.I | re.M,
)
REFUSAL = re.compile(
    r"\b(?:can(?:no|['’])?t|cannot|can not|unable to|not able to|not possible|(?:won['’]t|will not) be able|not (?:allowed|permitted) to|(?:must|have to|need to) (?:decline|refuse)|declin(?:e|ing)|refuse to|not comfortable)\b"
    r"|수 없(?:습니다|어|네요|음)|어렵습니다|어려울 것|못합니다|못해|거절|사양하|드리기 어려|불가(?:능)?합니다"
    r"|できません|できかね|かねます|お断り|できない(?:ため|ので)|不可能です|困難です|控えさせて|无法|無法|不能",
    re.I,
)
_LABEL = re.compile(r"^[^\w\s]{0,3}\s*(?:[^\W\d_]{1,12}\s?){1,2}\s*[:：]\s*")
_OUTER = re.compile(r"^\W+|(?<!\W)\W+$")
_SPACE = re.compile(r"\s+")
_UNSEEN = "\\s­͏ᅟᅠ​-‏ -‮⁠-⁤ㅤ︀-️﻿ﾠ"
_INVISIBLE = re.compile(f"[{_UNSEEN}]+")
_SEEN = re.compile(f"[^{_UNSEEN}]").search
_MANY_SEEN = re.compile(f"[{_UNSEEN}]*(?:[^{_UNSEEN}][{_UNSEEN}]*){{25}}").match
_HANGUL, _KANA, _HAN, _LATIN = (re.compile(f"[{x}]") for x in ("가-힣ᄀ-ᇿㄱ-ㆎ", "ぁ-ゖァ-ヺｦ-ﾝ", "一-鿿", "A-Za-zÀ-ɏ"))
_CYRILLIC = re.compile("[Ѐ-ӿ]")


def visible(text: str | None) -> str:
    return _INVISIBLE.sub("", text) if text else ""


def is_empty(text: str | None) -> bool:
    """Null, blank, invisible or a placeholder for nothing."""
    if not text:
        return True
    if _MANY_SEEN(text):
        return False
    shown = visible(text)
    return not shown or ((word := re.sub(r"[^\w/]+", "", shown).casefold()) in PLACEHOLDERS or not word.strip("/_"))


def bare(text: str) -> str:
    """text without case, blanks and outer signs."""
    text = _SPACE.sub("", unicodedata.normalize("NFKC", fold(text)).casefold())
    return _OUTER.sub("", text)


def copies(text: str, prompt: str | None) -> bool:
    """Nothing but the prompt, apart from case, outer signs, a leading label and line breaks."""
    if not prompt:
        return False
    if len(text) > len(prompt) + 60 and len(_OUTER.sub("", "".join(text.split()))) > 3 * len(prompt) + 60:  # composed letters are up to 3 code points
        return False
    whole = bare(prompt)
    return bool(whole) and (bare(text) == whole or bare(_LABEL.sub("", text, count=1)) == whole)


@cache
def _letters() -> np.ndarray:
    """Code point -> 1 to 5 for the letters of _HANGUL, _KANA, _HAN, _LATIN and _CYRILLIC, else 0."""
    plane, out = "".join(map(chr, range(0x10000))), np.zeros(0x10000, np.uint8)
    for i, letters in enumerate((_HANGUL, _KANA, _HAN, _LATIN, _CYRILLIC), 1):
        out[[ord(c) for c in letters.findall(plane)]] = i
    return out


def language(text: str) -> str | None:
    """ko, ja, zh, ru or en by the letters; a syllable or kanji weighs as much as 2.5 letters."""
    if text.isascii():
        return "en" if len(_LATIN.findall(text)) >= 3 else None
    codes = np.frombuffer(unicodedata.normalize("NFKC", text).encode("utf-32-le", "surrogatepass"), np.uint32)
    _, hangul, kana, han, latin, cyrillic = np.bincount(_letters()[np.minimum(codes, 0xFFFF)], minlength=6).tolist()
    east = kana + han
    weights = {"ko": 2.5 * hangul, "ja": 2.5 * east, "en": latin, "ru": cyrillic}
    best = max(weights, key=weights.get)
    if weights[best] < 3:
        return None
    return "zh" if best == "ja" and kana * 20 < han and han >= 8 else best


def foreign(text: str, page: str) -> bool:
    """Whether text is in another language than page; kana alone don't tell Japanese from a Chinese page."""
    one, two = language(text), language(page)
    return bool(one and two and one != two and {one, two} != {"ja", "zh"} or (one, two) == ("zh", "ja"))


def rule(text: str | None, page: str | None, prompt: str | None, stops: str) -> str | None:
    """The first defect that the rules on one pair give, without truncation."""
    content = bool(page and _SEEN(page))
    if is_empty(text):
        return "empty" if content and not is_empty(page) else None
    page = page or ""
    if text == page:
        return None
    # An end as the page has it somewhere may be mere closing markup: the text gives the page if its runs stand there too.
    if stops == "complete" and len(text) <= MESSAGE_CHARS and standing(text, page) >= ALIKE:
        return None
    if len(text) <= MESSAGE_CHARS:
        shown = fold(text)
        message, refusal = ERROR.search(shown), REFUSAL.search(shown)
        if (message or refusal) and quoted(shown, fold(page)) <= QUOTED:
            return "error_text" if message else "refusal"
    elif defect := _long_message(text, page):
        return defect
    if copies(text, prompt) and not copies(page, prompt):
        return "copied_prompt"
    if content and foreign(text, page) and standing(text, page) < ALIKE:
        return "wrong_language"
    return None


def _long_message(text: str, page: str) -> str | None:
    """error_text or refusal for a text that doesn't fit MESSAGE_CHARS and of which little stands in page, said once or again."""
    shown, whole = fold(text), fold(page)
    step = len(shown) // 5
    if sum(shown[i : i + 16] in whole for i in range(0, step * 5, step)) > 2:  # most of it stands in the page
        return None
    # A page in another language may hold such words too, below its head.
    said = shown.lstrip().split("\n", 1)[0] if foreign(text, page) else shown
    message = ERROR.search(said)
    if not message and not REFUSAL.search(said):
        return None
    if standing(text, page) > QUOTED or quoted(shown, whole) > QUOTED:
        return None
    return "error_text" if message else "refusal"


def shortened(df: DataFrame, text: str, page: str, pages: DataFrame | None = None) -> DataFrame:
    """(page_key, text_key, more): responses that are a prefix of another response to the page, or of the page; more is what follows there.

    pages (page_key) narrows the pages.  Copies of a response collapse before they are sorted, and the responses to a page
    are sorted apart by their first HEAD characters; shorter ones are sorted among the heads, whose ``more`` ends with the head.
    """
    rows = df.where(df[text].isNotNull() & df[page].isNotNull() & (F.length(df[text]) > 0)).select(F.xxhash64(df[page]).alias("page_key"), df[text].alias("text"), df[page].alias("page"))
    if pages is not None:
        rows = rows.join(pages, "page_key", "left_semi")
    both = rows.select("page_key", F.explode(F.array(F.rtrim("text"), "page")).alias("text")).where(F.length("text") > 0)
    both = both.withColumn("head", F.substring("text", 1, HEAD)).repartition("page_key", "head").distinct()

    def next_longer(rows: DataFrame, by: list[str]) -> DataFrame:
        after = F.lead("text").over(Window.partitionBy(*by).orderBy("text"))
        out = rows.select("page_key", "text", after.alias("after")).where(F.col("after").startswith(F.col("text")))
        return out.select("page_key", F.xxhash64("text").alias("text_key"), F.substring(F.col("after"), F.length("text") + 1, F.lit(2**31 - 1)).alias("more"))

    heads = both.select("page_key", F.substring("text", 1, HEAD + 2).alias("text")).distinct()
    short = next_longer(heads, ["page_key"]).join(both.where(F.length("text") < HEAD).select("page_key", F.xxhash64("text").alias("text_key")), ["page_key", "text_key"], "left_semi")
    return next_longer(both.where(F.length("text") >= HEAD), ["page_key", "head"]).union(short)


def defects(
    df: DataFrame, key: str = "result_id", source: str = "model_id", text: str = "prediction", page: str = "ground_truth", prompt: str = "prompt"
) -> DataFrame:
    """(key, defect) of every row; defect is null for sound pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, stops = [], []
            for a, b, c in zip(*(batch.column(i).to_pylist() for i in (6, 7, 8)), strict=True):
                stops.append(stop := ending(a, b, fold))
                found.append(rule(a, b, c, stop))
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(stops, pa.string()), pa.array(found, pa.string())], names)

    kind = df.schema[key].dataType.simpleString()
    names = ["key", "source", "chars", "bytes", "page_key", "text_key", "stops", "rule"]
    rows = df.select(
        df[key].alias("key"), df[source].alias("source"), F.char_length(df[text]).alias("chars"), F.octet_length(df[text]).alias("bytes"),
        F.xxhash64(df[page]).alias("page_key"), F.xxhash64(F.rtrim(df[text])).alias("text_key"), df[text].alias("text"), df[page].alias("page"), df[prompt].alias("prompt"),
    )
    judged = stored(spread(rows).mapInArrow(run, f"key {kind}, source string, chars int, bytes int, page_key long, text_key long, stops string, rule string"), "judged")
    open_pages = judged.where("rule is null and stops = 'unaligned'").select("page_key").distinct()
    if open_pages.count() <= BROADCAST_PAGES:
        open_pages = F.broadcast(open_pages)
    short = shortened(df, text, page, open_pages)
    # A shortened version stops inside a word or sentence if what follows goes on with a letter or digit, or a blank and one.
    inside = short.where(F.col("more").rlike(r"^[ ]?[\p{L}\p{N}]")).select("page_key", "text_key").distinct().withColumn("short", F.lit(True))
    judged = judged.join(inside, ["page_key", "text_key"], "left")
    scored = truncation.with_limits(judged, truncation.limits(df, source, text))
    odds = F.col("log_odds") + F.when(F.col("short") & (F.col("stops") == "unaligned"), NEIGHBOUR).otherwise(0.0)
    defect = F.coalesce("rule", F.when(odds > 0, "truncated"))
    return scored.select(F.col("key").alias(key), F.col("source").alias(source), defect.alias("defect"))
