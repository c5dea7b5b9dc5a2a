"""Queries over all boxes, against plain comparisons of all pairs."""

from collections import defaultdict

import pandas as pd

from collatio.plans.catalog import QUERIES


def _tables(sf_dir):
    return (pd.read_parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))


def _boxes(sf_dir):
    li, orders = _tables(sf_dir)
    lines, boxes = defaultdict(list), defaultdict(list)
    for o, p, s, n in li[["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]].itertuples(index=False):
        x, y = p % 400, s * 7 % 700
        lines[o % 500].append((((o * 100003 + p) * 1009 + s) * 10 + n, x, y, x + 30 + n * 9, y + 12))
    for o, c in orders[["o_orderkey", "o_custkey"]].itertuples(index=False):
        x, y = c % 350, o * 13 % 650
        boxes[o % 500].append((o, x, y, x + 60, y + 25))
    return lines, boxes


def test_all_boxes(spark, sf_dir):
    lines, boxes = _boxes(sf_dir)
    over, owner, within = set(), set(), set()
    for page, rows in lines.items():
        for i, *a in rows:
            scores = []
            for k, *b in boxes[page]:
                common = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
                scores.append((-common / min((a[2] - a[0]) * (a[3] - a[1]), 1500), k))
                if a[0] >= b[0] - 2 and a[1] >= b[1] - 2 and a[2] <= b[2] + 2 and a[3] <= b[3] + 2:
                    within.add((page, i))
            over |= {(page, i, k) for s, k in scores if -s > 0.6}
            if scores and -min(scores)[0] > 0.5:
                owner.add((page, i, min(scores)[1]))
    got = lambda name, *c: {tuple(r) for r in QUERIES[name](spark, sf_dir).select(*c).collect()}
    assert got("spatial_overlap_join", "page", "id", "box") == over and any(k % 20 for _, _, k in over)
    assert got("box_owner", "page", "id", "box") == owner
    assert got("box_containment", "page", "id") == within


def test_all_columns(spark, sf_dir):
    li, orders = _tables(sf_dir)
    centres = defaultdict(list)
    for o, c in orders[["o_orderkey", "o_custkey"]].itertuples(index=False):
        centres[o % 500].append((c % 350, o))
    best = {}
    for o, p, n in li[["l_orderkey", "l_partkey", "l_linenumber"]].itertuples(index=False):
        near = min(((abs(p % 400 - x), k) for x, k in centres[o % 500]), default=(26, 0))
        if near[0] < 26:
            best[o % 500, o * 10 + n] = min(near, best.get((o % 500, o * 10 + n), near))
    want = {(page, i, k) for (page, i), (_, k) in best.items()}
    assert {tuple(r) for r in QUERIES["nearest_column"](spark, sf_dir).select("page", "id", "column").collect()} == want
    assert any(k % 300 for _, _, k in want)
