"""Text expressions: Catalyst columns only.

All of them map null to null unless they say otherwise; empty text is a text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as white space, and the code point blocks of the scripts.
SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SCRIPTS = {
    "hangul": r"\x{1100}-\x{11ff}\x{3130}-\x{318f}\x{a960}-\x{a97f}\x{ac00}-\x{d7a3}\x{d7b0}-\x{d7ff}",
    "hanja": r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}",
    "kana": r"\x{3040}-\x{30ff}\x{31f0}-\x{31ff}",
    "latin": r"A-Za-z\x{c0}-\x{24f}\x{1e00}-\x{1eff}",
}
#: Punctuation that counts as a symbol.
AS_SYMBOL = "※‡†§¶·"
#: Classes in the order in which a character is tested.
CLASSES = ("whitespace", *SCRIPTS, "digit", "symbol", "punctuation")
STATS = ("chars_per_page", "line_count", "mean_line_length", *(f"{c}_share" for c in ("hangul", "hanja", "kana", "latin", "digit", "punctuation", "symbol", "whitespace")))


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def squash(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def count_of(text: Column, pattern: str) -> Column:
    """How many characters of text the one-character pattern matches."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def class_counts(text: Column) -> dict[str, Column]:
    """Characters of each class; a character belongs to the first class of CLASSES that fits, or to none."""
    out = {"whitespace": count_of(text, f"[{SPACE}]")}
    for name, block in SCRIPTS.items():
        out[name] = count_of(text, f"[{block}]")
    rest = F.regexp_replace(text, f"[{SPACE}{''.join(SCRIPTS.values())}]", "")
    out["digit"] = count_of(rest, r"\p{Nd}")
    out["symbol"] = count_of(rest, rf"[{AS_SYMBOL}\p{{S}}\p{{No}}]")
    out["punctuation"] = count_of(F.regexp_replace(rest, f"[{AS_SYMBOL}]", ""), r"\p{P}")
    return out


def text_stats(text: Column) -> list[Column]:
    """The STATS of one page, as doubles; shares are of all characters, 0 for empty text, null for null."""
    size = F.char_length(text)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    total = F.aggregate(lines, F.lit(0), lambda a, x: a + F.char_length(x))
    counts = class_counts(text)
    out = [size.cast("double").alias(STATS[0]), F.size(lines).cast("double").alias(STATS[1])]
    out.append(F.when(F.size(lines) > 0, total / F.size(lines)).when(text.isNotNull(), 0.0).alias(STATS[2]))
    return out + [(counts[name.removesuffix("_share")] / F.greatest(size, F.lit(1))).alias(name) for name in STATS[3:]]


#: Patterns of Markdown and HTML signs with what remains of them, in the order in which they are taken out.
MARKDOWN = (
    (r"(?s)```.*?```", " "), (r"`([^`]*)`", "$1"), (r"!\[[^\]]*\]\([^)]*\)", " "), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"<[^>]+>", " "),
    (r"(?mU)^\s{0,3}#{1,6}\s*", ""), (r"(?mU)^\s{0,3}>\s?", ""), (r"(?mU)^\s{0,3}[-*+]\s+", ""), (r"(?mU)^\s{0,3}\d+[.)]\s+", ""),
    (r"(?mU)^\s*\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?\s*$", ""), (r"\*\*([^*\n]+)\*\*", "$1"), (r"(?<!\*)\*([^*\n]+)\*(?!\*)", "$1"),
    (r"(?<!_)_([^_\n]+)_(?!_)", "$1"), (r"\|", " "),
)


def strip_markdown(text: Column) -> Column:
    """Prose of a Markdown page."""
    return reduce(lambda t, p: F.regexp_replace(t, F.lit(p[0]), F.lit(p[1])), MARKDOWN, text)


def clean_for_score(text: Column) -> Column:
    """Letters, digits and underscores of text: what the text score compares."""
    for sign in ("\\t", "\\n", "\t", "\n", "/t", "/n"):
        text = F.replace(text, F.lit(sign), F.lit(""))
    return F.regexp_replace(text, r"[^\p{L}\p{N}_]", "")


def sentences(text: Column) -> Column:
    """Sentences after . ! ? and their CJK forms."""
    return F.filter(F.split(squash(text), r"(?<=[.!?。！？])\s+"), lambda s: s != "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def model_key(name: Column) -> Column:
    """A model's name without its path, signs and case; '' for null."""
    last = F.substring_index(F.replace(F.trim(F.coalesce(name, F.lit(""))), F.lit("\\"), F.lit("/")), "/", -1)
    return F.regexp_replace(F.lower(last), "[^a-z0-9]+", "")


def language_of(language: Column, dataset: Column) -> Column:
    """The given language, else the end of the data set's name after its last '-', else 'unknown'."""
    own = F.nullif(strip(language), F.lit(""))
    repo = F.substring_index(strip(dataset), "/", -1)
    suffix = F.when(F.contains(repo, F.lit("-")), F.nullif(strip(F.substring_index(repo, "-", -1)), F.lit("")))
    return F.coalesce(own, suffix, F.lit("unknown"))


def language_code(name: Column) -> Column:
    """The primary subtag of a language tag in lower case; null for null and blank."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(name)), "^[a-z]+", 0), F.lit(""))


def is_empty(text: Column) -> Column:
    """Null or white space alone."""
    return text.isNull() | ~text.rlike(f"[^{SPACE}]")


def is_table_line(line: Column) -> Column:
    return count_of(line, r"\|") >= 2


def canonical_type(kind: Column) -> Column:
    return F.translate(F.lower(F.trim(F.coalesce(kind, F.lit("text")))), "- ", "__")


def clip(text: Column, size: int) -> Column:
    """At most size characters: cut at the last blank if that keeps three fifths, then '...'."""
    flat = squash(text)
    cut = F.substring(flat, 1, size)
    space = F.char_length(cut) - F.instr(F.reverse(cut), " ")
    word = F.when((F.instr(cut, " ") > 0) & (space >= int(size * 0.6)), F.substring(cut, F.lit(1), space)).otherwise(cut)
    return F.when(F.char_length(flat) <= size, flat).otherwise(F.concat(F.regexp_replace(word, "[ ,;:]+$", ""), F.lit("...")))


def neutral(text: Column) -> Column:
    """Without block marks at the start, however many."""
    return F.regexp_replace(text, r"^(?:\s*(?:[#>|*+\-]+|\d+[.)])\s+)+", "")


def structure_signature(text: Column) -> Column:
    """One token per line by what opens it, joined by '|'."""
    def token(line: Column) -> Column:
        t = strip(line)
        out = F.when(t == "", "_")
        for kind, pattern in (("h", "^#{1,6} "), ("c", "^(```|~~~)"), ("t", r"^\|"), ("q", "^>"), ("b", r"^[-*+] "), ("n", r"^\d+[.)] "), ("m", r"^(\$\$|\\\[)"), ("i", r"^!\["), ("r", "^(-{3,}|={3,})$"), ("x", "^<")):
            out = out.when(t.rlike(pattern), kind)
        return out.otherwise("p")

    return F.array_join(F.transform(F.split(text, "\n", -1), token), "|")


def wiki_clean(text: Column) -> Column:
    """A line of a wiki dump without list marks, empty brackets and stray blanks.

    Words of marks alone are list marks that lost their line; brackets are left empty, or with a comma before the end, where
    templates were taken out of them.
    """
    marks = "#*:;"
    line = strip(F.ltrim(text, F.lit(marks + "|>-– \t\n")))
    kept = F.filter(F.split(line, r"\s+"), lambda w: F.length(F.btrim(w, F.lit(marks))) > 0)
    words = F.transform(kept, lambda w: F.when(w.rlike(rf"\.[{marks}]+$"), F.rtrim(w, F.lit(marks))).otherwise(w))
    line = F.concat(F.array_join(words, " "), F.regexp_extract(line, rf"\s([{marks}]+)$", 1))  # marks at the end of a line stay
    line = F.regexp_replace(line, r"[(（][\s,;:·、]*[)）]", "")
    line = F.regexp_replace(line, r"\s*[,;]\s*(?=[)）])", "")
    # A Korean sentence that runs into the next one.
    line = F.regexp_replace(line, r"(?<=[다요음함임됨][.!?])(?=[가-힣A-Za-z\"'(])", " ")
    return strip(F.regexp_replace(F.regexp_replace(F.replace(line, F.lit(".."), F.lit(".")), r"\s+(?=[,.;:!?])", ""), r"\s+", " "))


def formula_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\\[a-zA-Z]+|\\.|[A-Za-z0-9]+|[^\s])"), F.lit(1))


def formula_body(text: Column) -> Column:
    """A formula without its delimiters."""
    t = strip(text)
    inner = F.when(t.rlike(r"(?s)^\$\$.*\$\$$") & (F.length(t) >= 4), F.substring(t, F.lit(3), F.length(t) - 4))
    inner = inner.when(t.rlike(r"(?s)^\\[\[(].*\\[\])]$") & (F.length(t) >= 4), F.substring(t, F.lit(3), F.length(t) - 4))
    inner = inner.when(t.rlike(r"(?s)^\$.*\$$") & (F.length(t) >= 2), F.substring(t, F.lit(2), F.length(t) - 2))
    return strip(inner.otherwise(t))


def item_text(line: Column) -> Column:
    """A generated corpus item without its number or bullet."""
    return strip(F.regexp_replace(strip(line), r"^(?:\*{0,2}\d+[.)]\*{0,2}|[-*•])\s*", ""))


def tagged(text: Column, tag: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def page_label(number: Column, total: Column, style: str) -> Column:
    """A page number in one of the styles plain, dashed, of_total, korean, english."""
    forms = {"plain": ("%d",), "dashed": ("- %d -",), "of_total": ("%d / %d", 1), "korean": ("%d쪽",), "english": ("Page %d",)}
    form = forms[style]
    return F.format_string(form[0], number, total) if len(form) > 1 else F.format_string(form[0], number)


def html_cells(table: Column) -> Column:
    """Rows of cell texts of an HTML table."""
    rows = F.regexp_extract_all(table, F.lit("(?is)<tr\\b[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit("(?is)<t[hd]\\b[^>]*>(.*?)</t[hd]>"), F.lit(1)), lambda c: strip(F.regexp_replace(c, "<[^>]+>", ""))))


def fragment(text: Column, words: int, chars: int) -> Column:
    """The first words of text, cut to chars, without signs at its end."""
    body = F.regexp_replace(squash(text), r"[\p{P}\s]+$", "")
    first = F.array_join(F.slice(F.split(body, " "), 1, words), " ")
    return F.regexp_replace(F.substring(first, 1, chars), "[ \\-_:,;]+$", "")


def shorten(text: Column, chars: int) -> Column:
    """Whole words of text up to chars; a first word that is too long is cut."""
    flat = squash(text)
    cut = F.substring(flat, 1, chars + 1)
    whole = F.rtrim(F.substring(cut, F.lit(1), F.char_length(cut) - F.instr(F.reverse(cut), " ")))
    return F.when(F.char_length(flat) <= chars, flat).when(F.instr(cut, " ") > 0, whole).otherwise(F.substring(flat, 1, chars))


def math_aliases(formula: Column) -> Column:
    r"""\ge and \le by their long names."""
    return F.regexp_replace(formula, F.lit(r"\\(g|l)e(?![A-Za-z])"), F.lit(r"\\$1eq"))


def without_grounding(text: Column) -> Column:
    """Without reference and detection tags; runs of blank lines become one."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)<\|det\|>.*?<\|/det\|>", ""), r"<\|/?(?:ref|det|grounding)\|>", "")
    return strip(F.regexp_replace(bare, r"\n{3,}", "\n\n"))


def repository_url(url: Column) -> Column:
    """The https address of a git remote, without .git."""
    https = F.regexp_replace(F.trim(url), r"^(?:ssh://)?git@([^:/]+)[:/]", "https://$1/")
    return F.regexp_replace(https, r"\.git/?$", "")


def local_date(date: Column, lang: str) -> Column:
    """A date as documents of the language print it."""
    return F.date_format(date, {"ko": "yyyy'년' M'월' d'일'", "ja": "yyyy'年'M'月'd'日'"}.get(lang, "MMMM d, yyyy"))


#: The letters kept for each language when a wiki dump is reduced to its script.
WIKI_LETTERS = {
    "ko": r"가-힣A-Za-z0-9", "ja": r"ぁ-んァ-ヶー一-龯A-Za-z0-9", "zh": r"一-龥A-Za-z0-9", "en": "A-Za-z0-9", "de": "A-Za-zÄÖÜäöüß0-9", "fr": "A-Za-zÀ-ÿŒœ0-9", "es": "A-Za-zÁÉÍÓÚÜÑáéíóúüñ0-9",
}


def wiki_prose(text: Column, lang: str) -> Column:
    """Prose of a wiki page: links by their labels, without addresses, quotes, headings and other scripts' letters."""
    for pattern, rest in ((r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1"), (r"https?://\S+", " "), (r"'{2,}|=+", " "), (rf"[^{WIKI_LETTERS.get(lang, r'\p{L}\p{N}')}\s.,!?。！？()-]", " ")):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(rest))
    return squash(text)


#: Patterns by which a chunk of a page is told, all of its lines or its first one.
_CHECK, _NUMBER, _IMAGE = r"^-\s+\[[ xX]\]\s+\S", r"^\d+\.\s+\S", r"^!\[([^\]]*)\]\(([^)]+)\)$"


def chunk_kind(chunk: Column) -> Column:
    """What a chunk between blank lines is: code, formula, table, image, rule, checklist, bullet_list, numbered_list, quote or paragraph; null for a mixture and for nothing."""
    lines = F.filter(F.transform(F.split(chunk, "\n"), strip), lambda x: x != "")
    every = lambda test: F.forall(lines, test)
    size, whole = F.size(lines), F.array_join(lines, "\n")
    fences = F.size(F.filter(lines, lambda x: x.startswith("```")))
    first, last = F.try_element_at(lines, F.lit(1)), F.try_element_at(lines, F.lit(-1))
    dashes = F.exists(lines, lambda x: x.rlike(r"^\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?$"))
    piped = (size >= 2) & every(lambda x: x.contains("|")) & dashes
    opens = lambda x: x.rlike(r"^(#|```|\||\$\$|!\[|> |[-*+] )") | x.rlike(_NUMBER) | x.isin("---", "***")
    return (
        F.when(size == 0, F.lit(None)).when(fences > 0, F.when((fences == 2) & first.startswith("```") & last.startswith("```") & (size > 1), "code"))
        .when(whole.startswith("$$") & whole.endswith("$$"), "formula").when(piped | F.lower(whole).rlike(r"(?s)^<table\b.*</table>$"), "table")
        .when((size == 1) & whole.rlike(_IMAGE), "image").when((size == 1) & whole.isin("---", "***"), "rule").when(every(lambda x: x.rlike(_CHECK)), "checklist")
        .when(every(lambda x: x.startswith("- ")), "bullet_list").when(every(lambda x: x.rlike(_NUMBER)), "numbered_list").when(every(lambda x: x.startswith("> ")), "quote")
        .when(~F.exists(lines, opens), "paragraph")
    )


def chunks(text: Column) -> Column:
    """Parts of a page between blank lines, the empty ones left out."""
    return F.filter(F.split(text, r"\n[ \t]*\n+"), lambda c: c.rlike(f"[^{SPACE}]"))


def image_line(line: Column) -> Column:
    """(alt, path) of a line that is an image; null for other lines."""
    own = strip(line)
    return F.when(own.rlike(_IMAGE), F.struct(F.regexp_extract(own, _IMAGE, 1).alias("alt"), F.regexp_extract(own, _IMAGE, 2).alias("path")))


def tagged_output(text: Column, tag: str = "char") -> Column:
    """The tagged pieces of a model output joined by blanks; of an output without them the last answer, without tags."""
    own = strip(F.replace(text, F.lit("\r\n"), F.lit("\n")))
    pieces = F.filter(F.transform(tagged(own, tag), strip), lambda x: x != "")
    turn = F.when(F.lower(own).contains("assistant\n"), F.regexp_replace(own, r"^[^\n]*\n", "")).otherwise(own)
    answer = strip(F.substring_index(turn, "Assistant:", -1))
    bare = strip(F.regexp_replace(answer, "</?[^>]+>", ""))
    return F.when(F.size(pieces) > 0, F.array_join(pieces, " ")).when(bare != "", bare).otherwise(answer)


def content_lines(output: Column, logs: tuple[str, ...] = ("Evaluating:",)) -> Column:
    """The content of a log after its last line of 21 equals signs: lines with a letter or digit that no log prefix opens."""
    lines = F.transform(F.split(F.replace(output, F.lit("\r\n"), F.lit("\n")), "\n"), strip)
    log = "|".join(rf"\Q{x}\E" for x in logs)
    content = lambda x: x.rlike("[A-Za-z0-9가-힣]") & ~x.rlike(f"^({log}|={{50}})") & (x != "NO PATCHES")
    mark = F.size(lines) - F.array_position(F.reverse(lines), "=" * 21) + 1
    after = F.when(F.array_contains(lines, "=" * 21), F.slice(lines, mark + 1, F.size(lines))).otherwise(lines)
    kept, every = F.filter(after, content), F.filter(lines, content)
    return F.array_join(F.when(F.size(kept) > 0, kept).otherwise(every), "\n")


def template_ref(name: Column) -> Column:
    """A template's name as it is looked up: lower case, with underscores for hyphens and blanks."""
    return F.translate(F.lower(F.trim(name)), "- ", "__")


def tidy_formula(formula: Column) -> Column:
    """A formula without dollar signs at its ends, with the long names of its relations and single blanks."""
    return squash(math_aliases(F.btrim(strip(formula), F.lit("$"))))


def ratio(value: Column, default: float) -> Column:
    """A number from 0 to 1; the default for what is no number."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.nanvl(value.try_cast("double"), F.lit(None).cast("double")), F.lit(float(default)))))


#: Types of blocks of a generated page.
BLOCK_TYPES = ("paragraph", "bullet_list", "numbered_list", "checklist", "table", "formula", "quote", "code", "command", "image", "rule")


def block_types(names: Column, fallback: bool = True) -> Column:
    """Known block types of an array in their order, each once, text as paragraph; all types if none is known."""
    tidy = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.replace(F.lower(strip(n)), F.lit("-"), F.lit("_")))
    known = F.array_distinct(F.filter(F.transform(tidy, lambda n: F.when(n == "text", "paragraph").otherwise(n)), lambda n: n.isin(*BLOCK_TYPES)))
    return F.when(F.size(known) > 0, known).otherwise(F.array(*map(F.lit, BLOCK_TYPES)) if fallback else known)


def header_candidates(text: Column, count: int) -> Column:
    """The first ``count`` different pairs of words that open the sentences of a text; case doesn't tell them apart."""
    pairs = F.transform(sentences(text), lambda s: fragment(s, 2, 40))
    numbered = F.transform(F.filter(pairs, lambda p: p != ""), lambda p, i: F.struct(F.lower(p).alias("k"), i.alias("i"), p.alias("p")))
    first = F.filter(numbered, lambda x: ~F.exists(numbered, lambda y: (y["k"] == x["k"]) & (y["i"] < x["i"])))
    return F.slice(F.transform(first, lambda x: x["p"]), 1, count)
