import itertools
import random

import numpy as np

from folioscope.llm import quota_sample

PLAN = "plan_row long, plan_id long, batch_id long, capture_channel string, capture_scenario string, visual_difficulty string, available string, request string"
TARGET = "request_id long, target_no int, batch_id long, capture_channel string, capture_scenario string, visual_difficulty string, target_percent int, sample_size int, min_rows int, l0 string"


def plans(spark):
    rows = []
    for i in range(60):
        rows.append((i, i, 1, ["scanned", " Scanned", "SCANNED"][i % 3] if i < 40 else "born-digital", "", "easy" if i % 4 else None, "", ""))
    rows += [(100 + i, i, 1, *rows[i][3:]) for i in range(5)] + [(200, None, 1, "scanned", "", "easy", "", ""), (201, 300, 1, None, None, None, None, None)]
    return spark.createDataFrame(rows, PLAN).repartition(3)


def targets(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1, "scanned", None, None, 50, 20, 0, ""), (1, 2, 1, "Born Digital", None, None, 50, 20, 0, ""),
            (2, 1, 1, "scanned", "", "easy", 90, 40, 0, ""), (2, 2, 1, "born_digital", None, "hard", 10, 40, 3, ""),
            (3, 1, 9, None, None, None, 100, 5, 0, ""), (4, 1, 1, None, None, None, 100, 61, 0, ""), (5, 1, 1, "scanned", None, None, None, None, None, ""), (None, 1, 1, None, None, None, 100, 5, 0, ""),
        ],
        TARGET,
    )


def test_report(spark):
    got = {(r.request_id, r.target_no): r for r in quota_sample.quota_report(plans(spark), targets(spark)).collect()}
    assert len(got) == 7
    assert (got[1, 1].quota, got[1, 2].quota, got[1, 1].slack) == (10, 10, 0)
    assert (got[2, 1].available, got[2, 1].quota, got[2, 1].slack, got[2, 1].short, got[2, 1].met) == (30, 30, 6, 6, False)
    assert (got[2, 2].available, got[2, 2].quota, got[2, 2].met) == (0, 0, False)
    assert (got[3, 1].available, got[3, 1].met) == (0, False)
    assert (got[4, 1].available, got[4, 1].quota, got[4, 1].met) == (61, 61, True)
    assert (got[5, 1].needed, got[5, 1].quota, got[5, 1].met) == (0.0, 0, True)


def test_sample(spark):
    drawn = quota_sample.draw(plans(spark), targets(spark))
    rows = drawn.collect()
    assert sorted(rows) == sorted(quota_sample.draw(plans(spark).repartition(5), targets(spark)).collect())
    assert len({(r.request_id, r.plan_id) for r in rows}) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r.request_id, r.target_no] = sizes.get((r.request_id, r.target_no), 0) + 1
        if r.request_id == 1:
            assert (r.plan_id < 40) == (r.target_no == 1)
    assert sizes == {(1, 1): 10, (1, 2): 10, (2, 1): 30, (4, 1): 61}


def test_empty_tables(spark):
    assert quota_sample.quota_report(plans(spark).limit(0), targets(spark)).where("available > 0").count() == 0
    assert quota_sample.draw(plans(spark), targets(spark).limit(0)).count() == 0


def test_targets_that_share_a_cell(spark):
    rows = [(i, i, 1, "scanned", "", "easy", "", "") for i in range(50)]
    asked = [(1, n, 1, "scanned", None, None, 50, 100, 0, "") for n in (1, 2)]
    own, wanted = spark.createDataFrame(rows, PLAN), spark.createDataFrame(asked, TARGET)
    got = quota_sample.quota_report(own, wanted).orderBy("target_no").collect()
    assert all(r.met for r in got)  # each category is large enough
    assert sum(r.quota for r in got) == 50 and sum(r.slack for r in got) == 50
    assert sum(not r.drawn_in_full for r in got) >= 1  # but both can't be drawn in full
    assert len({r.plan_id for r in quota_sample.draw(own, wanted).collect()}) == 50


def test_a_plan_with_two_labels_counts_once_for_each_target_and_is_drawn_once(spark):
    rows = [(1, 7, 1, "scanned", "", "easy", "", ""), (2, 7, 1, "photo", "", "easy", "", ""), (3, 8, 1, "photo", "", "easy", "", "")]
    asked = [(1, 1, 1, "scanned", None, None, 50, 2, 0, ""), (1, 2, 1, "photo", None, None, 50, 2, 0, ""), (2, 1, 1, None, None, None, 100, 2, 0, "")]
    own, wanted = spark.createDataFrame(rows, PLAN), spark.createDataFrame(asked, TARGET)
    got = {(r.request_id, r.target_no): r.available for r in quota_sample.quota_report(own, wanted).collect()}
    assert got == {(1, 1): 1, (1, 2): 2, (2, 1): 2}
    assert sorted((r.request_id, r.target_no, r.plan_id) for r in quota_sample.draw(own, wanted).collect()) == [(1, 1, 7), (1, 2, 8), (2, 1, 7), (2, 1, 8)]


def test_cells_are_drawn_in_proportion(spark):
    """One open target over ten cells of 50 rows, 400 requests: the counts of the cells, and those of the rows, pass a chi-square test."""
    rows = [(i, i, 1, f"c{i % 10}", "", "easy", "", "") for i in range(500)]
    asked = [(r, 1, 1, None, None, None, 100, 33, 0, "") for r in range(400)]
    drawn = quota_sample.draw(spark.createDataFrame(rows, PLAN), spark.createDataFrame(asked, TARGET)).collect()
    assert len(drawn) == 400 * 33
    by_cell = np.bincount([r.plan_id % 10 for r in drawn], minlength=10)
    by_row = np.bincount([r.plan_id for r in drawn], minlength=500)
    assert ((by_cell - 1320) ** 2 / 1320).sum() < 27.9  # 99.9 % of chi-square with 9 degrees
    assert ((by_row - 26.4) ** 2 / 26.4).sum() < 606  # the same with 499 degrees
    quotas = {}
    for r in drawn:
        quotas.setdefault(r.request_id, [0] * 10)[r.plan_id % 10] += 1
    assert all(set(q) <= {3, 4} for q in quotas.values()) and len({tuple(q) for q in quotas.values()}) > 50


def test_without_the_flow_shared_rows_would_be_drawn_twice():
    quota, slack = quota_sample.target_quotas(100, [50, 50], [0, 40], [60], [(0, 0), (1, 0)])
    assert sum(quota) == 60 and quota[1] >= 40 and sum(slack) == 40
    assert quota_sample.shortfalls([50, 70], [60], [(0, 0), (1, 0)]) == [0, 10]


def test_flow_against_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        caps = [rng.randint(0, 3) for _ in range(4)]
        costs = [rng.randint(0, 5) for _ in range(4)]
        arcs = [(0, 2, caps[0], costs[0]), (0, 3, caps[1], costs[1]), (2, 1, caps[2], costs[2]), (3, 1, caps[3], costs[3]), (2, 3, 2, 1)]
        flow = quota_sample.min_cost_flow(4, arcs, 0, 1)
        best = None
        for f in itertools.product(*(range(c + 1) for _, _, c, _ in arcs)):
            if f[0] == f[2] + f[4] and f[1] + f[4] == f[3]:
                rank = (-(f[2] + f[3]), sum(x * a[3] for x, a in zip(f, arcs)))
                best = rank if best is None else min(best, rank)
        assert (-(flow[2] + flow[3]), sum(x * a[3] for x, a in zip(flow, arcs))) == best
