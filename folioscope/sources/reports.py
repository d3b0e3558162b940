"""Reports from aggregated rows: leaderboards, gaps, comparisons, rank correlations and dataset cards as Markdown or JSON."""

from __future__ import annotations

import html
import json
import os
import platform
import tempfile
from datetime import datetime, timezone
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a leaderboard or comparison, a row per model and language, that are written by the driver; more raise an error.
MAX_ROWS = 1_000_000
#: Rows that the report of a distribution or a data set shows, the most telling first; it says how many there are.
SHOWN = 1000


def markdown(rows: list[dict], columns: list[str], titles: dict[str, str] | None = None) -> str:
    """A pipe table; floats with four digits, null as an empty cell."""
    show = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|")
    line = lambda cells: "| " + " | ".join(cells) + " |"
    head = [line([(titles or {}).get(c, c) for c in columns]), line(["---"] * len(columns))]
    return "\n".join(head + [line([show(r.get(c)) for c in columns]) for r in rows]) + "\n"


def top(df: DataFrame, order: list, shown: int = SHOWN) -> list[dict]:
    """The first rows by order."""
    return [r.asDict(recursive=True) for r in df.orderBy(*order).limit(shown).collect()]


def every(df: DataFrame, order: list) -> list[dict]:
    """All rows by order; a table that isn't of a report's size raises."""
    rows = top(df, order, MAX_ROWS + 1)
    if len(rows) > MAX_ROWS:
        raise ValueError(f"a report of more than {MAX_ROWS} rows")
    return rows


def leaderboard(ranked: DataFrame, metric: str, lower_is_better: bool = False) -> tuple[str, str]:
    """(JSON, Markdown) of a ranked leaderboard (language, model_id, rank, score, ...), a table for each language."""
    rows = every(ranked.select("language", "rank", "model_id", "score", *(c for c in ("success_rate", "avg_latency_ms") if c in ranked.columns)), ["language", "rank"])
    groups: dict[str, list[dict]] = {}
    for r in rows:
        groups.setdefault(r["language"], []).append(r)
    payload = [{"language": k, "metric_key": metric, "metric_direction": "ascending" if lower_is_better else "descending", "count": len(v), "rows": v} for k, v in groups.items()]
    text = "\n".join(f"## {k}\n\n{markdown(v, [c for c in v[0] if c != 'language'])}" for k, v in groups.items())
    return json.dumps(payload, ensure_ascii=False, indent=1, default=str), f"# Leaderboard: {metric}\n\n{text}"


def gap(rows: DataFrame, reference: str, candidate: str) -> str:
    """A gap report, the largest first; is_* metrics show means, others medians."""
    flag = F.col("metric").startswith("is_")
    value = lambda side: F.when(flag, F.col(f"{side}_mean")).otherwise(F.col(f"{side}_median")).alias(side)
    out = top(rows.select("metric", value("reference"), value("candidate"), "w1_norm", "candidate_is", "verdict"), [F.desc("w1_norm"), "metric"])
    return f"# Gap of {candidate} to {reference}\n\n{markdown(out, ['metric', 'reference', 'candidate', 'w1_norm', 'candidate_is', 'verdict'])}"


def rank_correlation(statistics: dict, interval: tuple[float, float] | None, confidence: float, matched: list[dict]) -> str:
    """A rank correlation report; it names the confidence that was used."""
    lines = [f"Models matched: {statistics['n']}", f"Spearman: {statistics['spearman']:.4f}", f"Kendall tau-b: {statistics['kendall_tau_b']:.4f}"]
    lines += [f"{name} p-value (permutations): {statistics[k]:.4f}" for name, k in (("Spearman", "spearman_p"), ("Kendall", "kendall_p")) if statistics.get(k) is not None]
    if interval:
        lines.append(f"{confidence:.0%} interval of Spearman: {interval[0]:.4f} to {interval[1]:.4f}")
    lone = [r["synthetic_model"] or r["real_model"] for r in matched if not (r["synthetic_model"] and r["real_model"])]
    return "# Rank correlation\n\n" + "\n".join(f"- {x}" for x in lines) + (f"\n\nUnmatched: {', '.join(sorted(lone))}\n" if lone else "\n")


def comparison(runs: DataFrame) -> tuple[str, str]:
    """(JSON, Markdown) of runs beside each other: model, backend, data set, samples, success rate, latency and every metric."""
    rows = every(runs.select("model_id", "backend", "dataset_id", "language", "total_samples", "success_rate", "avg_latency_ms", "metrics"), ["model_id", "language"])
    names = sorted({m for r in rows for m in r["metrics"] or {}})
    flat = [{k: v for k, v in r.items() if k != "metrics"} | {m: (r["metrics"] or {}).get(m) for m in names} for r in rows]
    columns = list(flat[0]) if flat else ["model_id"]
    return json.dumps(flat, ensure_ascii=False, indent=1, default=str), "# Comparison\n\n" + markdown(flat, columns)


#: The lines of a run's summary.
SUMMARY = {"total_samples": "Total Samples", "successful": "Successful", "failed": "Failed", "empty_rate": "Empty Rate", "avg_latency_ms": "Average Latency (ms)"}


def run_report(config: dict, metrics: dict[str, float], summary: dict, errors: list[dict] = ()) -> dict[str, str]:
    """A run's report as json, md and html: configuration, metrics, summary, and the first errors."""
    parts = [
        ("Configuration", [{"parameter": k, "value": v} for k, v in config.items()]), ("Metrics", [{"metric": k, "value": v} for k, v in metrics.items()]),
        ("Execution Summary", [{"figure": title, "value": summary.get(k)} for k, title in SUMMARY.items()]), ("Errors", list(errors)),
    ]
    parts = [(title, rows) for title, rows in parts if rows]
    text = "# Evaluation Report\n\n" + "\n".join(f"## {title}\n\n{markdown(rows, list(rows[0]))}" for title, rows in parts)
    show = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else html.escape(str(v))
    cells = lambda tag, values: "<tr>" + "".join(f"<{tag}>{show(v)}</{tag}>" for v in values) + "</tr>"
    body = "".join(f"<h2>{title}</h2><table>{cells('th', rows[0])}{''.join(cells('td', r.values()) for r in rows)}</table>" for title, rows in parts)
    page = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>Evaluation Report</title></head><body><h1>Evaluation Report</h1>{body}</body></html>'
    payload = {"config": config, "metrics": metrics, "summary": summary, "errors": list(errors)}
    return {"json": json.dumps(payload, ensure_ascii=False, indent=2, default=str), "md": text, "html": page}


def protocol(command: str, config: dict, summary: dict) -> str:
    """What was run, when and in which environment, as JSON."""
    versions = {"python": platform.python_version(), "platform": platform.platform(), "pyspark": pyspark.__version__}
    at = datetime.now(timezone.utc).isoformat(timespec="seconds").replace("+00:00", "Z")
    return json.dumps({"timestamp": at, "command": command, "config": config, "summary": summary, "environment": versions}, ensure_ascii=False, indent=2, default=str)


def discriminator(folds: list[dict], weights: list[dict], candidates: list[dict], reference: str, candidate: str) -> str:
    """How well two sources are told apart: the folds, their mean, the features that tell most, and the rows told most surely."""
    known = [f["auc"] for f in folds if f["auc"] is not None]
    mean = sum(known) / len(known) if known else 0.5
    spread = (sum((a - mean) ** 2 for a in known) / len(known)) ** 0.5 if known else 0.0
    head = f"# Discriminator: {candidate} against {reference}\n\nMean AUC {mean:.4f}, deviation {spread:.4f}; 0.5 means that they can't be told apart.\n\n"
    return head + markdown(folds, ["fold", "auc", "accuracy"]) + "\n" + markdown(weights, ["feature", "coefficient"]) + "\n" + markdown(candidates, list(candidates[0]) if candidates else ["row"])


def size_category(rows: int) -> str:
    """The size class of a data set's card."""
    for most, name in ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"), (100_000_000, "10M<n<100M"), (1_000_000_000, "100M<n<1B")):
        if rows < most:
            return name
    return "n>1B"


def dataset_card(name: str, splits: dict[str, int], shares: list[dict]) -> str:
    """Front matter, the rows of each split and the shares of each field."""
    total = sum(splits.values())
    front = f"---\nsize_categories:\n- {size_category(total)}\n---\n\n# {name}\n\n"
    return front + markdown([{"split": k, "rows": v} for k, v in splits.items()], ["split", "rows"]) + "\n" + markdown(shares, ["field", "value", "count", "share"])


def save(path: str | Path, text: str) -> None:
    """Write a small driver-side file in one step: readers see the old one or the new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent)
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(name, path)


class Manifest:
    """State of a sharded run: its settings, and each shard as pending, running, completed or failed."""

    FIXED = ("size", "shard_size", "lang", "seed")

    def __init__(self, path: str | Path, **settings):
        self.path, self.data = Path(path), {"status": "pending", **settings, "shards": {}}

    @classmethod
    def open(cls, path: str | Path, resume: bool = False, **settings) -> "Manifest":
        """A new manifest, or with resume the one at path: other settings, or a run that exists without resume, raise."""
        out = cls(path, **settings)
        if out.path.exists():
            if not resume:
                raise FileExistsError(f"{path} exists: resume it or choose another folder")
            try:
                old = json.loads(out.path.read_text(encoding="utf-8"))
            except ValueError:
                out.path.rename(out.path.with_suffix(".broken"))
                return out
            wrong = [k for k in cls.FIXED if k in settings and old.get(k) != settings[k]]
            if wrong:
                raise ValueError(f"the run at {path} has other settings: {', '.join(wrong)}")
            out.data = old
        return out

    def mark(self, shard: int, status: str, **details) -> None:
        self.data["shards"][str(shard)] = {"status": status, **details}
        states = {s["status"] for s in self.data["shards"].values()}
        self.data["status"] = "failed" if "failed" in states else "running" if states & {"running", "pending"} else "completed"
        save(self.path, json.dumps(self.data, ensure_ascii=False, indent=1))

    def done(self, shard: int) -> bool:
        return self.data["shards"].get(str(shard), {}).get("status") == "completed"
