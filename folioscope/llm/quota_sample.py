"""Samples that match target shares of categories (problem 5).

Rows are counted by cell.  A row id belongs to one cell: the set of the different label
combinations under which it was delivered, nearly always a single one.  For each request
three min-cost flows run over the cells:

1. Each target alone, against the availability of its cells; what its slack arc takes is
   ``short``: rows that the batch doesn't hold.  ``p5_found`` lists the targets with such a slack.
2. All targets of the request together, cells shared: margins (the shares) and floors are
   arcs, slack arcs at a price take what can't be met, floors before shares.  The flow
   fixes the ``quota`` and the ``slack`` of each target.
3. The quotas over the cells.  The expected share of a cell is in proportion to its rows; it is rounded
   to an integer by seeded systematic rounding, so that each row has the same chance, and
   the flow keeps to the rounded numbers unless two targets ask for the same rows.

The rows of a cell are put in a seeded random order once, and a request takes a circular
run of that order from a seeded place: every row has the same chance, the rows drawn are
as many as the quotas say, and only drawn rows are joined.

Labels are equal if they differ in case, outer blanks, or ``_``, ``-`` and blanks between
words alone.  Defined results: a null label belongs only to targets that ask for any
value; an empty label is a label; a null id counts for nothing; repeated rows count once;
a request for a batch without rows has availability 0; targets without a request or a
number are left out; targets with nothing to draw get quota 0; null sizes, shares and
floors are 0; tables may be empty.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABELS = ("capture_channel", "capture_scenario", "visual_difficulty")
#: Prices of a row short of a floor, of a row short of a share, and of a row of a cell beyond its rounded number.
FLOOR_PRICE, SHARE_PRICE, CELL_PRICE = 1000, 10, 1
#: Parts of the random order of a cell that are ranked apart, against cells that hold most rows.
SPLIT = 256


def label(column: Column | str) -> Column:
    """The form in which labels are compared."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.col(column) if isinstance(column, str) else column, r"^\s+|\s+$", "")), r"[_\-\s]+", "_")


def assigned(rows: DataFrame, batch: str = "batch_id", row_id: str = "plan_id", labels: tuple[str, ...] = LABELS) -> DataFrame:
    """(batch, id, cell): every row id of a batch once; cell is the sorted array of its label combinations."""
    own = rows.where(rows[row_id].isNotNull()).select(
        rows[batch].alias("batch"), rows[row_id].alias("id"), F.struct(*(label(rows[c]).alias(f"l{i}") for i, c in enumerate(labels))).alias("combo")
    )
    return own.groupBy("batch", "id").agg(F.sort_array(F.collect_set("combo")).alias("cell"))


def cells(rows: DataFrame, batch: str = "batch_id", row_id: str = "plan_id", labels: tuple[str, ...] = LABELS) -> DataFrame:
    """(batch, cell, available): row ids of each cell."""
    return assigned(rows, batch, row_id, labels).groupBy("batch", "cell").agg(F.count("*").alias("available"))


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost) of a maximum flow of least cost; costs aren't negative."""
    head: list[list[int]] = [[] for _ in range(n)]
    to, room, price = [], [], []
    for a, b, capacity, cost in arcs:
        for x, y, c, p in ((a, b, capacity, cost), (b, a, 0, -cost)):
            head[x].append(len(to))
            to.append(y)
            room.append(c)
            price.append(p)
    potential = [0] * n
    while True:
        # Shortest path under reduced prices; the potentials keep them from being negative.
        far: list[float] = [float("inf")] * n
        far[source], via, queue = 0, [-1] * n, [(0, source)]
        while queue:
            d, x = heapq.heappop(queue)
            if d > far[x]:
                continue
            for e in head[x]:
                if room[e] > 0 and (new := d + price[e] + potential[x] - potential[to[e]]) < far[to[e]]:
                    far[to[e]], via[to[e]] = new, e
                    heapq.heappush(queue, (new, to[e]))
        if via[sink] < 0:
            return [room[2 * i + 1] for i in range(len(arcs))]
        for x in range(n):
            if far[x] < float("inf"):
                potential[x] += int(far[x])
        push, x = None, sink
        while x != source:
            push = room[via[x]] if push is None else min(push, room[via[x]])
            x = to[via[x] ^ 1]
        x = sink
        while x != source:
            room[via[x]] -= push
            room[via[x] ^ 1] += push
            x = to[via[x] ^ 1]


def _shares(size: int, percents: list[int]) -> list[int]:
    """Integer parts of size by largest remainder; ties go to the earlier target."""
    exact = [size * p for p in percents]
    parts = [x // 100 for x in exact]
    want = round(sum(exact) / 100)
    for i in sorted(range(len(parts)), key=lambda i: (-(exact[i] % 100), i))[: max(want - sum(parts), 0)]:
        parts[i] += 1
    return parts


def shortfalls(needed: list[int], left: list[int], links: list[tuple[int, int]]) -> list[int]:
    """Rows short of each target taken alone: the flow on its slack arc, every target with its own copy of the cells."""
    sink = len(needed) + 1
    arcs = [(0, 1 + t, n, 0) for t, n in enumerate(needed)] + [(1 + t, sink, n, SHARE_PRICE) for t, n in enumerate(needed)]
    arcs += [(1 + t, sink, left[c], 0) for t, c in links]
    return min_cost_flow(sink + 1, arcs, 0, sink)[len(needed) : 2 * len(needed)]


def target_quotas(size: int, shares: list[int], floors: list[int], left: list[int], links: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(quota, slack) of each target when all draw from the same cells: floors first, then shares."""
    many = len(shares)
    pool = 2 + many + len(left)  # nodes: source, sink, targets, cells, and the rows beyond the floors
    over = [max(s - f, 0) for s, f in zip(shares, floors, strict=True)]
    arcs = [(0, pool, max(size - sum(floors), 0), 0)]
    arcs += [(0, 2 + t, f, 0) for t, f in enumerate(floors)] + [(pool, 2 + t, o, 0) for t, o in enumerate(over)]
    slack = len(arcs)
    arcs += [(2 + t, 1, f, FLOOR_PRICE) for t, f in enumerate(floors)] + [(2 + t, 1, o, SHARE_PRICE) for t, o in enumerate(over)]
    first = len(arcs)
    arcs += [(2 + t, 2 + many + c, left[c], 0) for t, c in links] + [(2 + many + c, 1, n, 0) for c, n in enumerate(left)]
    flow = min_cost_flow(pool + 1, arcs, 0, 1)
    quota = [0] * many
    for (t, _), f in zip(links, flow[first:], strict=False):
        quota[t] += f
    return quota, [flow[slack + t] + flow[slack + many + t] for t in range(many)]


def rounded(expected: list[float], total: int, rng: np.random.Generator) -> list[int]:
    """Integers with the sum ``total`` next to the expected values, each with its expected value as mean (systematic rounding in random order)."""
    order = rng.permutation(len(expected))
    edges = np.concatenate([[0.0], np.cumsum(np.asarray(expected, float)[order])])
    edges[-1] = total
    marks = np.floor(edges + rng.random()).astype(np.int64)
    marks[0], marks[-1] = 0, total
    out = np.empty(len(expected), np.int64)
    out[order] = np.diff(marks)
    return out.tolist()


def cell_quotas(quota: list[int], left: list[int], links: list[tuple[int, int]], rng: np.random.Generator) -> list[int]:
    """Rows of each link (target, cell): the rounded shares of the cells, moved only where two targets ask for the same rows."""
    many = len(quota)
    asked = [0] * len(links)
    for t, q in enumerate(quota):
        mine = [i for i, (x, _) in enumerate(links) if x == t]
        whole = sum(left[links[i][1]] for i in mine)
        if q and whole:
            for i, n in zip(mine, rounded([q * left[links[i][1]] / whole for i in mine], q, rng), strict=True):
                asked[i] = n
    arcs = [(0, 2 + t, q, 0) for t, q in enumerate(quota)]
    arcs += [(2 + t, 2 + many + c, min(n, left[c]), 0) for (t, c), n in zip(links, asked, strict=True)]
    arcs += [(2 + t, 2 + many + c, max(left[c] - n, 0), CELL_PRICE) for (t, c), n in zip(links, asked, strict=True)]
    arcs += [(2 + many + c, 1, n, 0) for c, n in enumerate(left)]
    flow = min_cost_flow(2 + many + len(left), arcs, 0, 1)[many:]
    return [a + b for a, b in zip(flow[: len(links)], flow[len(links) : 2 * len(links)], strict=True)]


def _solve(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Quota, slack and shortfall of the targets of one request, with the quota of each of their cells."""
    targets = pdf.drop_duplicates("target").sort_values("target")
    size = int(targets["size"].fillna(0).max())
    percents = [int(x) for x in targets["percent"].fillna(0)]
    floors = [int(x) for x in targets["floor"].fillna(0)]
    numbers = {t: i for i, t in enumerate(targets["target"])}
    has = pdf[pdf["available"].notna()]
    cell_at: dict[int, int] = {}
    left: list[int] = []
    links = []
    for t, c, n in zip(has["target"], has["cell_id"], has["available"], strict=True):
        if c not in cell_at:
            cell_at[c] = len(left)
            left.append(int(n))
        links.append((numbers[t], cell_at[c]))
    needed = [max(-(-size * p // 100), f) for p, f in zip(percents, floors, strict=True)]
    short = shortfalls(needed, left, links)
    quota, slack = target_quotas(size, _shares(size, percents), floors, left, links)
    drawn = cell_quotas(quota, left, links, np.random.default_rng([seed, int(pdf["chance"].iloc[0]) & 0x7FFFFFFFFFFFFFFF]))
    ids = list(cell_at)
    out = []
    for target, i in numbers.items():
        mine = [(c, f) for (t, c), f in zip(links, drawn, strict=True) if t == i]
        row = {
            "target": target, "needed": max(size * percents[i] / 100, floors[i]), "available": sum(left[c] for c, _ in mine), "short": short[i], "quota": quota[i], "slack": slack[i],
        }
        out += [row | {"cell_id": ids[c], "cell_quota": f} for c, f in mine if f] or [row | {"cell_id": 0, "cell_quota": 0}]
    return pd.DataFrame(out)


def plan_quotas(
    rows: DataFrame, targets: DataFrame, request: str = "request_id", target: str = "target_no", batch: str = "batch_id", row_id: str = "plan_id", labels: tuple[str, ...] = LABELS,
    percent: str = "target_percent", size: str = "sample_size", floor: str = "min_rows", seed: int = 42,
) -> DataFrame:
    """(request, target, batch, needed, available, short, quota, slack, cell_id, cell_quota), a row per target and cell drawn from."""
    asked = targets.where(targets[request].isNotNull() & targets[target].isNotNull()).select(
        targets[request].alias("request"), targets[target].alias("target"), targets[batch].alias("batch"), targets[percent].alias("percent"),
        targets[size].alias("size"), targets[floor].alias("floor"), *(label(targets[c]).alias(f"t{i}") for i, c in enumerate(labels)),
    )
    supply = cells(rows, batch, row_id, labels).select(F.col("batch").alias("b"), "cell", F.xxhash64("cell").alias("cell_id"), "available")

    def fits(combo: Column) -> Column:
        match = F.lit(True)
        for i in range(len(labels)):
            match &= F.col(f"t{i}").isNull() | F.coalesce(F.col(f"t{i}") == combo[f"l{i}"], F.lit(False))
        return match

    joined = asked.join(supply, (F.col("batch") == F.col("b")) & F.exists("cell", fits), "left")
    joined = joined.select("request", "target", "batch", "percent", "size", "floor", F.coalesce("cell_id", F.lit(0)).alias("cell_id"), "available", F.xxhash64("request").alias("chance"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _solve(pdf, seed)
        out.insert(0, "request", pdf["request"].iloc[0])
        out.insert(2, "batch", out["target"].map(dict(zip(pdf["target"], pdf["batch"], strict=True))))
        return out[columns]

    columns = ["request", "target", "batch", "needed", "available", "short", "quota", "slack", "cell_id", "cell_quota"]
    kinds = {c: asked.schema[c].dataType.simpleString() for c in ("request", "target", "batch")}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", needed double, available long, short long, quota long, slack long, cell_id long, cell_quota long"
    # The rows are few and the flows are work: a stated number of partitions keeps them from being merged into one task.
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    return joined.repartition(parts, "request").groupBy("request").applyInPandas(run, schema)


def quota_report(rows: DataFrame, targets: DataFrame, request: str = "request_id", target: str = "target_no", **kw) -> DataFrame:
    """(request, target, needed, available, short, quota, slack, met, drawn_in_full), a row per target.

    met: the batch holds the needed rows of the category.  drawn_in_full: the sample has the target's share and floor
    as well, which other targets of the request may prevent by taking the same rows.
    """
    plan = plan_quotas(rows, targets, request, target, **kw)
    names = ("needed", "available", "short", "quota", "slack")
    out = plan.groupBy(F.col("request").alias(request), F.col("target").alias(target)).agg(*(F.first(c).alias(c) for c in names))
    return out.withColumn("met", F.col("short") == 0).withColumn("drawn_in_full", F.col("slack") == 0)


def _ordered(pool: DataFrame, seed: int) -> DataFrame:
    """(batch, cell_id, id, place): the place of each row, from 0, in the random order of its cell.

    The order is that of a seeded hash; its upper bits name one of SPLIT parts, so that no task ranks a whole cell.
    """
    chance = F.xxhash64(F.lit(seed), "id")
    own = pool.select("batch", F.xxhash64("cell").alias("cell_id"), "id", chance.alias("chance"), F.pmod(F.shiftrightunsigned(chance, 40), F.lit(SPLIT)).alias("part"))
    keys = ["batch", "cell_id"]
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.groupBy(*keys, "part").agg(F.count("*").alias("n")).select(*keys, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = own.withColumn("r", F.row_number().over(Window.partitionBy(*keys, "part").orderBy("chance", "id")))
    starts = starts.select(F.col("batch").alias("b"), F.col("cell_id").alias("c"), F.col("part").alias("p"), "start")
    ranked = ranked.join(starts, ranked["batch"].eqNullSafe(F.col("b")) & (F.col("cell_id") == F.col("c")) & (F.col("part") == F.col("p")))
    return ranked.select("batch", "cell_id", "id", (F.col("start") + F.col("r") - 1).alias("place"))


def draw(
    rows: DataFrame, targets: DataFrame, request: str = "request_id", target: str = "target_no", batch: str = "batch_id", row_id: str = "plan_id", labels: tuple[str, ...] = LABELS, seed: int = 42, **kw
) -> DataFrame:
    """(request, target, row_id): the sample of each request; a row is drawn at most once for a request."""
    plan = plan_quotas(rows, targets, request, target, batch, row_id, labels, seed=seed, **kw).where("cell_quota > 0")
    pool = assigned(rows, batch, row_id, labels)
    size = pool.groupBy(F.col("batch").alias("b"), F.xxhash64("cell").alias("c")).agg(F.count("*").alias("whole"))
    taken = Window.partitionBy("request", "batch", "cell_id").orderBy("target")
    quota = plan.select("request", "target", "batch", "cell_id", "cell_quota", (F.sum("cell_quota").over(taken) - F.col("cell_quota")).alias("skip"))
    quota = quota.join(size, (F.col("batch") == F.col("b")) & (F.col("cell_id") == F.col("c")))
    first = F.pmod(F.xxhash64(F.lit(seed), "request", "cell_id"), F.col("whole")) + F.col("skip")
    place = F.explode(F.sequence(first, first + F.col("cell_quota") - 1))
    wanted = quota.select("request", "target", F.col("batch").alias("b"), F.col("cell_id").alias("c"), "whole", place.alias("at"))
    wanted = wanted.withColumn("at", F.pmod("at", "whole"))
    order = _ordered(pool, seed)
    out = wanted.join(order, (F.col("batch") == F.col("b")) & (F.col("cell_id") == F.col("c")) & (F.col("place") == F.col("at")))
    return out.select(F.col("request").alias(request), F.col("target").alias(target), F.col("id").alias(row_id))
