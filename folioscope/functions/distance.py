"""Edit distances and accuracies as Catalyst columns.  Null counts as the empty text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import SPACE, strip


def _text(c: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    c = F.coalesce(c, F.lit(""))
    return normalise(c) if normalise else c


def cer(reference: Column, hypothesis: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    """Edits per character of the reference; may exceed 1; for an empty reference 1, or 0 if both are empty."""
    r, h = _text(reference, normalise), _text(hypothesis, normalise)
    return F.when(r == h, 0.0).when(F.char_length(r) == 0, 1.0).otherwise(F.levenshtein(r, h) / F.char_length(r))


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _as_letters(own: Column, vocabulary: Column) -> Column:
    """Each word as one character beyond the basic plane, by its place in the vocabulary (up to a million different words)."""
    letter = lambda w: F.decode(F.unhex(F.lpad(F.hex(F.array_position(vocabulary, w) + 0x10000), 8, "0")), "UTF-32")
    return F.array_join(F.transform(own, letter), "")


def wer(reference: Column, hypothesis: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    """Edits per word of the reference, like cer over words."""
    r, h = words(_text(reference, normalise)), words(_text(hypothesis, normalise))
    both = F.array_distinct(F.concat(r, h))
    edits = F.levenshtein(_as_letters(r, both), _as_letters(h, both))
    return F.when(F.size(r) == 0, F.when(F.size(h) == 0, 0.0).otherwise(1.0)).otherwise(edits / F.size(r))


def exact(reference: Column, hypothesis: Column) -> Column:
    return (strip(_text(reference)) == strip(_text(hypothesis))).cast("double")


def word_accuracy(reference: Column, hypothesis: Column) -> Column:
    """Share of the reference's different words that the hypothesis has."""
    r, h = F.array_distinct(words(_text(reference))), F.array_distinct(words(_text(hypothesis)))
    return F.when(F.size(r) == 0, (F.size(h) == 0).cast("double")).otherwise(F.size(F.array_intersect(r, h)) / F.size(r))


def character_accuracy(reference: Column, hypothesis: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - cer(reference, hypothesis))


def ned(prediction: Column, target: Column) -> Column:
    """Normalised edit distance: 1 if just one of the texts is empty, else the error rate against the target."""
    p, t = _text(prediction), _text(target)
    return F.when((p == "") & (t == ""), 0.0).when((p == "") | (t == ""), 1.0).otherwise(cer(t, p))


def iou(a: Column, b: Column) -> Column:
    """Overlap of two boxes (x1, y1, x2, y2) as arrays; 0 for a null box or an empty union."""
    wide = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    high = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - wide * high
    return F.coalesce(F.when(both > 0, wide * high / both), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def detected(guess: Column, truth: Column) -> dict[str, Column]:
    """Precision, recall and F1 of counted things: as many as both sides have are right; 0 where a side has none."""
    both = F.least(guess, truth).cast("double")
    precision, recall = F.coalesce(F.try_divide(both, guess), F.lit(0.0)), F.coalesce(F.try_divide(both, truth), F.lit(0.0))
    return {"precision": precision, "recall": recall, "f1": f1(precision, recall)}


def same_direction(a: Column, b: Column) -> Column:
    """Share of the steps of two arrays of numbers in which both rise or both fall; null for less than two places."""
    steps = lambda x: F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda p, q: q - p)
    both = F.zip_with(steps(a), steps(b), lambda p, q: F.coalesce((p * q > 0).cast("int"), F.lit(0)))
    return F.when(F.least(F.size(a), F.size(b)) > 1, F.aggregate(both, F.lit(0), lambda s, v: s + v) / F.size(both))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; 0 if one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, v: s + v)
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
