import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing

SCHEMA = "doc_id long, text string, source string, __n long, place int"


def slow_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return {**target, **{s: level * w[s] for s in open_}}
        target.update({s: most * sizes[s] for s in over})
        open_ -= over


def documents():
    out = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else f"s{i % 7}" if i % 50 else None
        out.append((i, " ".join(["w"] * (1 + (i * 7919) % 90)), source))
    out += [(5000 + i, "one two three", "tiny") for i in range(2)] + [(6000, None, "hot"), (6001, "", "void"), (None, "a b", "hot"), (7, out[7][1], out[7][2])]
    out += [(7000, "word " * 5000, "s1")]
    return out


def test_targets_and_copies(spark):
    data = documents()
    df = spark.createDataFrame([(*r, 0, 0) for r in data], SCHEMA)
    rows = mixing.copies(df).collect()
    assert len(rows) == len(data)
    sizes = Counter()
    for _, t, s in data:
        sizes[s] += len(re.findall(r"\S+", t or ""))
    want = slow_targets(dict(sizes))
    taken, most = Counter(), 0
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.n_copies <= 3
        taken[r.source] += r.n_copies * r.size
    for s, t in want.items():
        largest = max(len((x or "").split()) for _, x, y in data if y == s)
        assert abs(taken[s] - t) <= 2 * largest, s
    again = mixing.copies(df.repartition(5)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_repeats_rows(spark):
    data = documents()
    df = spark.createDataFrame([(*r, 0, 0) for r in data], SCHEMA)
    n = Counter()
    for r in mixing.copies(df).collect():
        n[r.id] += r.n_copies
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    got = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert got == Counter({k: v for k, v in n.items() if v})


def test_empty_and_sizeless(spark):
    assert mixing.copies(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a", 0, 0), (2, "", None, 0, 0)], SCHEMA)
    assert [r.n_copies for r in mixing.copies(nothing).collect()] == [0, 0]


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a", "s", 0, 0)], SCHEMA)
    plan = mixing.mix(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and F
