import random

import pytest

from folioscope.kernels.tables import span_grid, to_cells
from folioscope.operators import tables_generation as tg
from folioscope.sources import reports

WORDS = ["alpha", "beta", "gamma", "delta"]


@pytest.mark.parametrize("seed", range(15))
def test_row_invariants(seed):
    rng = random.Random(seed)
    for r in tg.rows_of("financial", 6, rng, WORDS):
        assert r["change"] == r["current"] - r["prior"] and abs(r["rate"] - 100 * r["change"] / abs(r["prior"])) < 0.05
    for r in tg.rows_of("budget", 6, rng, WORDS):
        assert r["left"] == r["budget"] - r["spent"] >= 0
    order = tg.rows_of("order", 5, rng, WORDS)
    assert all(r["amount"] == r["quantity"] * r["price"] for r in order[:-1]) and order[-1]["amount"] == sum(r["amount"] for r in order[:-1])
    assert all(r[f"y{k}"] >= 0 for r in tg.rows_of("statistics", 5, rng, WORDS) for k in range(1, 5))
    for kind in tg.SCHEMAS:
        rows, columns = tg.rows_of(kind, 6, rng, WORDS), tg.columns_of(kind, 4)
        assert len(tg.markdown_table(kind, rows, columns).split("\n")) == len(rows) + 2
        merged = tg.merged_table(kind, rows, columns)
        if merged:
            span_grid(merged, len(columns))
            assert to_cells(tg.html_table(merged))["num_rows"] == len(merged)
        grouped = tg.grouped_table(kind, rows, tg.columns_of(kind, 5), rng)
        assert (grouped is not None) == (kind in ("financial", "budget", "statistics"))
        if grouped:
            made, heads = grouped
            assert heads == 2 and tg.html_table(made, heads).count("</th>") == sum(map(len, made[:2]))
            if kind == "statistics":
                number = lambda t: int(t.replace(",", ""))
                assert [number(a[1][0]) + number(a[2][0]) for a in made[2:]] == [r["y1"] for r in rows]


def test_formats():
    assert (tg.amount(-1200, "ko"), tg.amount(-1200, "en"), tg.amount(-1200, "ja"), tg.percent(-3.25, "en")) == ("△1,200", "(1,200)", "-1,200", "(3.2%)")
    assert tg.head("item", "ko") == "항목" and tg.head("item", "fr") == "Item" and tg.head("y1", "ko") == "y1"
    assert [tg.heading_mark(s, 4) for s in ("arabic", "dotted", "roman", "korean")] == ["4.", "4.0", "IV.", "라."] and tg.heading_mark("korean", 99) == "99."
    assert tg.compatible((1, 3), (1, 2)) == ["roster", "statistics"]


PAGE = "# T\n\n## A\n\nOne. Two. Three.\n\n```\n## not\n\nx\n```\n\n## B\n\n- a\n- b"


@pytest.mark.parametrize("seed", range(20))
def test_continuations(seed):
    out = tg.continuation(PAGE, random.Random(seed), cut=1)
    assert "# T" not in out.split("\n") and PAGE.endswith(out[-5:])
    assert tg.continuation("no sections", random.Random(seed)) == "no sections"


def test_pages():
    assert tg.number_headings(PAGE, "roman").count("## I") == 2 and "## not" in tg.number_headings(PAGE, "roman")
    assert tg.fit(PAGE, 0.5) == PAGE.replace("\n\nx", "\n\nx") and tg.fit(PAGE, 3.0).startswith("# T") and not tg.fit(PAGE, 2.0).rstrip().endswith("## B")
    text, n = tg.mutate("ball # bell", 0.5, lambda c: [("1", 1.0)] if c == "l" else [], random.Random(1))
    assert n == 2 and text.count("1") == 2 and tg.mutate("abc", 0.5, lambda c: [], random.Random(1)) == ("abc", 0)
    assert set(tg.furniture(random.Random(2), WORDS, 3, 9)) == {"header", "footer", "page_number"}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("ko", 1, "a", 0.9), ("ko", 2, "b", None), ("en", 1, "c", 0.5)], "language string, rank int, model_id string, score double")
    payload, text = reports.leaderboard(df, "avg_x")
    assert text.count("## ") == 2 and '"metric_direction": "descending"' in payload and "| 1 | a | 0.9000 |" in text
    assert reports.size_category(999) == "n<1K" and reports.size_category(10**10) == "n>1B"
    assert "90% interval" in reports.rank_correlation({"n": 3, "spearman": 1.0, "kendall_tau_b": 1.0}, (0.5, 1.0), 0.9, [{"synthetic_model": None, "real_model": "z"}])
    assert "| train | 900 |" in reports.dataset_card("d", {"train": 900, "test": 100}, [])


def test_manifest(tmp_path):
    path = tmp_path / "run.json"
    m = reports.Manifest.open(path, size=10, seed=1)
    m.mark(0, "completed", generated=5)
    m.mark(1, "running")
    assert m.data["status"] == "running"
    with pytest.raises(FileExistsError):
        reports.Manifest.open(path, size=10)
    with pytest.raises(ValueError, match="size"):
        reports.Manifest.open(path, resume=True, size=11)
    again = reports.Manifest.open(path, resume=True, size=10, seed=1)
    assert again.done(0) and not again.done(1)
    path.write_text("{broken")
    assert not reports.Manifest.open(path, resume=True, size=10).done(0) and path.with_suffix(".broken").exists()
