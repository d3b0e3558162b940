"""One consistent form for texts that look the same (problem 1).

A trie holds a vocabulary of trusted tokens under what a reader sees of them, each with
the spelling in which the trusted texts have it most often.  A weighted edit automaton
walks it: look-alike characters (width, script of a letter, composition, kind of
blank) and ignorable ones cost nothing, every visible edit costs 1.  A token that
reaches a word within the budget takes that word's spelling, so a word written in
Cyrillic or in full-width letters stays so and all its look-alikes become it; any other
token is normalised character by character with the table of look-alikes.  With the
budget 0, the default, visible differences stay: case, number of blanks and lines,
markup, raised and encircled digits.

Some kanji and katakana are drawn alike (口 and ロ, 工 and エ): a run of such signs is written in katakana next to another
katakana sign, else in kanji, whichever it was stored in.

Defined results: null stays null and looks like no text; empty and blank texts keep their blanks; repeated
rows give repeated results.  A spelling of the trie shows the same as what it is reached
by, so with budget 0 two texts have equal forms if and only if they look the same.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.sources.shared import spread, stored

#: Bounds of the vocabulary that is broadcast: most frequent tokens, and the longest one kept.
VOCABULARY = 20_000
TOKEN_CHARS = 40
MEMO_ENTRIES = 100_000

#: Cyrillic, Greek and Armenian letters and the Latin letters they look like.
LOOKALIKES = dict(
    zip(
        "АВЕЅІЈКМНОРСТХУҮԌԚԜаеорсухіјѕԁһԛԝѵҽ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳ" "Օօցոս",
        "ABESIJKMHOPCTXYYGQWaeopcyxijsdhqwve" "ABEZHIKMNOPTYXocj" "Oognu",
        strict=True,
    )
)
#: Kanji and hiragana, and the katakana that are drawn like them.
KANJI, KATAKANA = "口二工夕力八卜へべぺ", "ロニエタカハトヘベペ"
LOOKALIKES |= dict(zip(KANJI, KATAKANA, strict=True))
_TO_KANJI = str.maketrans(KATAKANA, KANJI)
_DRAWN_ALIKE = re.compile(f"(?<![ァ-ヺー・])[{KATAKANA}]+(?![ァ-ヺー・])")
#: Hyphens drawn like the keyboard's, and line ends.
_SAME = {"‐": "-", "‑": "-", " ": "\n", " ": "\n", "\u0085": "\n", "\t": " "}
#: Marks without a glyph that aren't in the category of format characters.
_FILLERS = "͏ᅟᅠ឴឵ㅤﾠ"


def visible(ch: str, kana: bool = True) -> str:
    """What a reader sees of one character, as a string in a fixed spelling; without kana kanji and katakana stay apart."""
    if not kana and ch in KANJI:
        return ch
    if ch in _SAME:
        return _SAME[ch]
    if ch in LOOKALIKES:
        return LOOKALIKES[ch]
    kind = unicodedata.category(ch)
    if kind == "Cf" or ch in _FILLERS or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0100 <= ord(ch) <= 0xE01EF:
        return ""
    if kind == "Zs":
        return " "
    tag = unicodedata.decomposition(ch).partition(" ")[0]
    if tag in ("<wide>", "<narrow>", "<noBreak>") or tag == "<compat>" and (kind[0] == "L" or kind == "Nl" or 0x2E80 <= ord(ch) <= 0x2FDF):
        plain = unicodedata.normalize("NFKC", ch)
        return plain if " " in plain or plain == ch else "".join(visible(c, kana) for c in plain)
    return ch


def _table(kana: bool = True) -> dict[int, str]:
    return {cp: v for cp in range(0x80, sys.maxunicode + 1) if not 0xD800 <= cp < 0xE000 and (v := visible(chr(cp), kana)) != chr(cp)} | {9: " "}


def _class(codes: Iterable[int]) -> str:
    out, start, last = [], None, None
    for cp in sorted(codes):
        if start is None or cp != last + 1:
            if start is not None:
                out.append((start, last))
            start = cp
        last = cp
    out.append((start, last))
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out) + "]"


class Normaliser:
    """Canonical forms of tokens and texts for one vocabulary."""

    def __init__(self, vocabulary: Iterable[str] = (), budget: int = 0, kana: bool = True):
        self.table = _table(kana)
        self.special = re.compile(_class(self.table)).search
        self.budget = budget
        self.memo: dict[str, str] = {}
        self.trie: dict = {}
        self.respelt = False
        for word in vocabulary:
            self._add(word)

    def _add(self, word: str) -> None:
        """Enter word under what is seen of it; of words that look the same the first one gives the spelling."""
        seen = self.classes(word)
        spelling = unicodedata.normalize("NFC", "".join(ch for ch in word if self.table.get(ord(ch), ch)))
        if not seen or self._parts(seen)[1:] or self.classes(spelling) != seen:
            return
        node = self.trie
        for ch in unicodedata.normalize("NFD", seen):
            node = node.setdefault(ch, {})
        node.setdefault("", spelling)
        self.respelt |= spelling != seen and seen.isascii()

    def classes(self, text: str) -> str:
        """text with each character as its class of look-alikes."""
        if self.special(text):
            text = text.translate(self.table)
        return text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)

    def by_table(self, text: str) -> str:
        """The same, with classes of kanji and katakana in the script that stands around them."""
        text = self.classes(text)
        return _DRAWN_ALIKE.sub(lambda m: m[0].translate(_TO_KANJI), text)

    def match(self, token: str) -> str | None:
        """The word the automaton reaches at the least cost within the budget; ties go to the smaller word."""
        # Nodes of the trie with the least cost at which the input so far leads there.
        states: dict[int, tuple[int, dict]] = {}

        def put(into: dict, cost: int, node: dict) -> None:
            if cost <= self.budget and (id(node) not in into or into[id(node)][0] > cost):
                into[id(node)] = (cost, node)
                for ch, child in node.items():  # a letter of the word that the token lacks
                    if ch and cost < self.budget:
                        put(into, cost + 1, child)

        put(states, 0, self.trie)
        for ch in unicodedata.normalize("NFD", token):
            same = unicodedata.normalize("NFD", self.table.get(ord(ch), ch))
            ahead: dict[int, tuple[int, dict]] = {}
            for cost, node in states.values():
                walk = node
                for c in same:  # nothing for ignorable characters: the node stays at no cost
                    walk = walk.get(c) if walk else None
                if walk is not None:
                    put(ahead, cost, walk)
                if cost < self.budget and same:
                    put(ahead, cost + 1, node)
                    for c, child in node.items():
                        if c:
                            put(ahead, cost + 1, child)
            states = ahead
            if not states:
                return None
        ends = [(cost, node[""]) for cost, node in states.values() if "" in node]
        return min(ends)[1] if ends else None

    def token(self, token: str) -> str:
        form = self.memo.get(token)
        if form is None:
            form = self.match(token)
            if form is None:
                form = self.by_table(token)
            if len(token) <= TOKEN_CHARS:
                if len(self.memo) >= MEMO_ENTRIES:
                    self.memo.clear()
                self.memo[token] = form
        return form

    _parts = re.compile("([ \n\t\r\u0085   -     　]+)").split

    def text(self, text: str | None) -> str | None:
        if not text:
            return text
        if "\r" in text:
            text = text.replace("\r\n", "\n")
        if text.isascii() and not self.budget and not self.respelt:
            return text.replace("\t", " ")
        get, slow = self.memo.get, self.token
        form = "".join([get(p) or slow(p) for p in self._parts(text) if p])
        # A mark that opens a token can join the character before it.
        return form if unicodedata.is_normalized("NFC", form) else unicodedata.normalize("NFC", form)


def vocabulary(df: DataFrame, text: str, size: int = VOCABULARY) -> list[str]:
    """The most frequent tokens of all texts, at most ``size``, the most frequent first: those above the least count that admits no more.

    The counts stay in the cluster; how many tokens have each count gives the least count, so no more than ``size``
    tokens of TOKEN_CHARS characters reach the driver, whatever the corpus.
    """
    token = F.explode(F.split(df[text], "[ \n\t\u00a0\u3000]+")).alias("token")
    counts = df.select(token).where((F.length("token") > 0) & (F.length("token") <= TOKEN_CHARS)).groupBy("token").agg(F.count("*").alias("n"))
    counts = stored(counts.where("n > 1"), "tokens")
    kept, least = 0, None
    for r in counts.groupBy("n").agg(F.count("*").alias("m")).orderBy(F.desc("n")).limit(size + 1).collect():
        if kept + r.m > size:
            break
        kept, least = kept + r.m, r.n
    return [t for _, t in sorted((-r.n, r.token) for r in counts.where(F.col("n") >= least).collect())] if least else []


_NORMALISERS: dict[tuple[int, int], Normaliser] = {}


def _normaliser(words: list[str], budget: int) -> Normaliser:
    """The normaliser of this Python worker for these words, built once."""
    key = (hash(tuple(words)), budget)
    if key not in _NORMALISERS:
        _NORMALISERS.clear()
        _NORMALISERS[key] = Normaliser(words, budget)
    return _NORMALISERS[key]


def canonical(df: DataFrame, key: str, texts: list[str], trusted: str | None = None, budget: int = 0, size: int = VOCABULARY) -> DataFrame:
    """key and the canonical forms of the columns ``texts``; the vocabulary comes from the column ``trusted`` (the last text by default)."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary(df, trusted or texts[-1], size))
    names = [f"t{i}" for i in range(len(texts))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = _normaliser(shared.value, budget).text
        for batch in batches:
            out = [pa.array([form(x) for x in batch.column(i + 1).to_pylist()], pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], ["key", *names])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(df[key].alias("key"), *(df[t].alias(n) for t, n in zip(texts, names, strict=True)))
    out = spread(out).mapInArrow(run, f"key {kind}, " + ", ".join(f"{n} string" for n in names))
    return out.toDF(key, *texts)


def same_look(df: DataFrame, key: str, left: str, right: str, size: int = VOCABULARY) -> DataFrame:
    """Keys of the rows whose two texts differ as stored and are equal in canonical form; a null text equals none, and blanks are seen."""
    differ = df.where(df[left].isNotNull() & df[right].isNotNull() & (df[left] != df[right]))
    shared = df.sparkSession.sparkContext.broadcast(vocabulary(df, right, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = _normaliser(shared.value, 0).text
        for batch in batches:
            same = [form(a) == form(b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["key"]).filter(pa.array(same, pa.bool_()))

    kind = df.schema[key].dataType.simpleString()
    out = spread(differ.select(differ[key].alias("key"), differ[left].alias("a"), differ[right].alias("b"))).mapInArrow(run, f"key {kind}")
    return out.withColumnRenamed("key", key)
