"""Scores of predicted page elements: dicts with type, text, bounding_box, reading_order, metadata and html."""

from __future__ import annotations

import json

from folioscope.kernels.blocks import cer
from folioscope.kernels.tables import teds

FORMULA_WORDS = ("formula", "equation", "latex", "math")


def kind_of(element: dict) -> str:
    name = str(element.get("type") or "text").strip().lower().replace("-", "_").replace(" ", "_")
    return "formula" if any(w in name for w in FORMULA_WORDS) else "table" if "table" in name else "text"


def iou(a, b) -> float:
    if a is None or b is None:
        return 0.0
    wide, high = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(0, wide) * max(0, high)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return both / union if union > 0 else 0.0


def greedy(left: list, right: list, value, least: float, floor: float = 0.0) -> list[tuple[int, int]]:
    """Each left item in turn takes the free right one of the greatest value above floor, the first of equals, if it reaches least."""
    free, out = list(range(len(right))), []
    for i, x in enumerate(left):
        top, at = floor, None
        for j in free:
            if (v := value(x, right[j])) > top:
                top, at = v, j
        if at is not None and top >= least:
            free.remove(at)
            out.append((i, at))
    return out


def pairs_by_place(guess: list[dict], truth: list[dict], least: float) -> list[tuple[int, int]]:
    """Pairs by overlap; those of both sides without a box follow in order."""
    out = greedy(guess, truth, lambda a, b: iou(a.get("bounding_box"), b.get("bounding_box")), least)
    taken = [{p[s] for p in out} for s in (0, 1)]
    bare = [[i for i, e in enumerate(side) if e.get("bounding_box") is None and i not in taken[s]] for s, side in enumerate((guess, truth))]
    return out + list(zip(*bare))


def table_html(element: dict) -> str:
    """The first HTML given in the element, its metadata, their table entries, or its text."""
    meta = element.get("metadata") if isinstance(element.get("metadata"), dict) else {}
    for holder in (element, meta):
        for value in (holder.get("html"), holder.get("table_html"), (holder.get("table") or {}).get("html") if isinstance(holder.get("table"), dict) else None):
            if value and str(value).strip():
                return str(value).strip()
    text = str(element.get("text") or "").strip()
    return text if "<table" in text.lower() else ""


def _pair_mean(guess: list[dict], truth: list[dict], least: float, score) -> float:
    if not guess and not truth:
        return 1.0
    pairs = pairs_by_place(guess, truth, least)
    return sum(score(guess[i], truth[j]) for i, j in pairs) / (len(guess) + len(truth) - len(pairs))


def _text(a: dict, b: dict) -> float:
    x, y = (str(e.get("text") or "").strip() for e in (a, b))
    return 1.0 if not x and not y else max(0.0, 1 - cer(y, x))


def _table(a: dict, b: dict) -> float:
    x, y = table_html(a), table_html(b)
    return teds(x, y) if x and y else float(not x and not y)


def _ratio(a: float, b: float) -> float:
    return a / b if b else 0.0


def _f1(p: float, r: float) -> float:
    return _ratio(2 * p * r, p + r)


def detection(guess: list[dict], truth: list[dict], least: float = 0.5) -> dict[str, float]:
    """Mean F1 over the types that both sides have, and the pooled precision, recall and F1."""
    values, hit, n_guess, n_true = [], 0, 0, 0
    for kind in {e.get("type", "unknown") for e in truth}:
        a = [e for e in guess if e.get("type", "unknown") == kind]
        b = [e for e in truth if e.get("type", "unknown") == kind]
        if a:
            tp = len(greedy(a, b, lambda x, y: iou(x.get("bounding_box"), y.get("bounding_box")), least))
            values.append(_f1(tp / len(a), tp / len(b)))
            hit, n_guess, n_true = hit + tp, n_guess + len(a), n_true + len(b)
    p, r = _ratio(hit, n_guess), _ratio(hit, n_true)
    return {"map": _ratio(sum(values), len(values)), "precision": p, "recall": r, "f1": _f1(p, r)}


def ranks(values: list[float]) -> list[float]:
    """1-based ranks, ties at the mean of their places."""
    spots: dict[float, list[int]] = {}
    for place, v in enumerate(sorted(values), 1):
        spots.setdefault(v, []).append(place)
    return [sum(spots[v]) / len(spots[v]) for v in values]


def correlation(a: list[float], b: list[float]) -> float:
    n = len(a)
    ma, mb = sum(a) / n, sum(b) / n
    sa, sb = sum((x - ma) ** 2 for x in a), sum((y - mb) ** 2 for y in b)
    return _ratio(sum((x - ma) * (y - mb) for x, y in zip(a, b)), (sa * sb) ** 0.5)


def tau_b(a: list[float], b: list[float]) -> float:
    """Kendall's tau with ties on either side."""
    sign = lambda x: (x > 0) - (x < 0)
    both = left = right = 0
    for i in range(len(a)):
        for j in range(i):
            p, q = sign(a[i] - a[j]), sign(b[i] - b[j])
            both, left, right = both + p * q, left + p * p, right + q * q
    return _ratio(both, (left * right) ** 0.5)


def reading_order(guess: list[dict], truth: list[dict]) -> dict[str, float]:
    """Rank correlations of the reading orders and the share of steps in the same direction."""
    if not guess or not truth:
        return {"kendall_tau": 0.0, "spearman_rho": 0.0, "order_accuracy": 0.0}
    a, b = ([e.get("reading_order", i) for i, e in enumerate(side)] for side in (guess, truth))
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if n < 2:
        return {"kendall_tau": 1.0, "spearman_rho": 1.0, "order_accuracy": 1.0}
    same = sum((a[i + 1] - a[i]) * (b[i + 1] - b[i]) > 0 for i in range(n - 1))
    return {"kendall_tau": tau_b(a, b), "spearman_rho": correlation(ranks(a), ranks(b)), "order_accuracy": same / (n - 1)}


def key_values(guess: list[dict], truth: list[dict], least: float = 0.7) -> dict[str, float]:
    """F1 of key and value pairs matched by mean likeness."""

    def entry(e: dict) -> tuple[str, str]:
        meta = e.get("metadata") if e.get("metadata") is not None else {}
        if isinstance(meta, str):
            try:
                meta = json.loads(meta)
            except ValueError:
                meta = {}
        meta = meta if isinstance(meta, dict) else {}
        return str(meta.get("key", e.get("text", "")) or ""), str(meta.get("value", "") or "")

    a, b = [entry(e) for e in guess], [entry(e) for e in truth]
    if not b:
        return {"precision": float(not a), "recall": 1.0, "f1": float(not a)}
    off = lambda x, y: cer(x, y) if x and y else 1.0
    tp = len(greedy(a, b, lambda x, y: 1 - (off(x[0], y[0]) + off(x[1], y[1])) / 2, least))
    p, r = _ratio(tp, len(a)), tp / len(b)
    return {"precision": p, "recall": r, "f1": _f1(p, r)}


def document_scores(guess: list[dict], truth: list[dict], least: float = 0.5) -> dict[str, float]:
    """Text and table scores, weighted by their elements on both sides; formulas aren't scored."""
    sides = [[[e for e in side if kind_of(e) == kind] for kind in ("text", "table")] for side in (guess, truth)]
    text = _pair_mean(sides[0][0], sides[1][0], least, _text)
    table = _pair_mean(sides[0][1], sides[1][1], least, _table)
    n_text, n_table = (len(sides[0][k]) + len(sides[1][k]) for k in (0, 1))
    whole = (text * n_text + table * n_table) / (n_text + n_table) if n_text + n_table else 1.0
    a, b = sides[0][0] + sides[0][1], sides[1][0] + sides[1][1]
    out = {"text_score": text, "table_teds": table, "overall_score": whole}
    out |= {f"layout_{k}": v for k, v in detection(a, b, least).items()}
    out |= reading_order(a, b)
    return out | {f"key_value_{k}": v for k, v in key_values(a, b).items()}


def ned(guess: str, truth: str) -> float:
    """Normalised edit distance: 1 if one side alone is empty."""
    return float(bool(guess or truth)) if not guess or not truth else cer(truth, guess)


def entity_scores(guess: dict[str, str] | None, truth: dict[str, str] | None, most: float = 0.3) -> dict[str, float]:
    """Precision, recall and F1 of fields whose values differ by at most ``most``, and the mean distance over the true fields."""
    guess, truth = guess or {}, truth or {}
    if not truth:
        return {"precision": float(not guess), "recall": 1.0, "f1": float(not guess), "avg_ned": 0.0}
    off = {f: ned(str(guess.get(f) or ""), str(v or "")) for f, v in truth.items()}
    hit = sum(d <= most for d in off.values())
    p = _ratio(sum(f in off and off[f] <= most for f in guess), len(guess))
    r = hit / len(truth)
    return {"precision": p, "recall": r, "f1": _f1(p, r), "avg_ned": sum(off.values()) / len(truth)}


def item_scores(guess: list[dict] | None, truth: list[dict] | None, most: float = 0.3) -> dict[str, float]:
    """Line items matched by name; an item whose quantity or price differs counts half."""
    guess, truth = guess or [], truth or []
    if not truth:
        return {"precision": float(not guess), "recall": 1.0, "f1": float(not guess), "item_accuracy": float(not guess)}
    near = lambda a, b: 1 - ned(str(a.get("name", "")), str(b.get("name", "")))
    pairs = greedy(guess, truth, near, 1 - most)
    cost = 0.0
    for i, j in pairs:
        d = 1 - near(guess[i], truth[j])
        same = all(guess[i].get(k) == truth[j].get(k) for k in ("quantity", "total_price"))
        cost += d if same else 0.5 + d / 2
    p, r = _ratio(len(pairs), len(guess)), len(pairs) / len(truth)
    return {"precision": p, "recall": r, "f1": _f1(p, r), "item_accuracy": 1 - cost / len(truth) if pairs else 0.0}
