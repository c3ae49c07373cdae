import numpy as np
from pyspark.sql import functions as F

from tessera.llm import line_dedup

SCHEMA = "doc_id long, text string, __id long, lines string, th int"


def documents():
    rng = np.random.default_rng(5)
    long = [" ".join(f"w{rng.integers(99)}" for _ in range(25)) for _ in range(4)]
    pool = [f"line {i}" for i in range(14)] + long + ["", "  ", "line 1  "]
    out = [(i, "\n".join(rng.choice(pool, int(rng.integers(1, 12))))) for i in range(120)]
    out += [(i + 500, out[3][1]) for i in range(30)]
    out += [(600, None), (601, ""), (602, "\n\n"), (603, "A\nA\nA\nA"), (None, out[3][1]), (None, "line 0\nline 1"), (4, out[4][1]), (4, "line 2\nline 3\n")]
    out += [(700, "\n".join(f"u{i}" for i in range(3000)) + "\nline 0\nline 1")]
    return out


def slow(data, hashes, run=2, long_line=20):
    """Every text after the deletion of all runs that occur earlier."""
    seen = {}
    for (i, t) in set(data):
        if t is None:
            continue
        lines = [(k, " ".join(["", x.strip(" \t\n\x0b\f\r"), ""])) for k, x in enumerate(t.split("\n")) if x.strip()]
        windows = [lines[k:k + run] for k in range(len(lines) - run + 1)] + [[x] for x in lines if len(x[1].split()) >= long_line]
        for w in windows:
            place = (i is None, i or 0, hashes[t], w[0][0])
            seen.setdefault(tuple(x for _, x in w), []).append((place, (i, t), [k for k, _ in w]))
    gone = {}
    for places in seen.values():
        places.sort(key=lambda x: x[0])
        for place, doc, lines in places:
            if place > places[0][0]:
                gone.setdefault(doc, set()).update(lines)
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((i, t), ())) for i, t in data]


def test_against_brute_force(spark):
    data = documents()
    df = spark.createDataFrame([(i, t, k, "x", 1) for k, (i, t) in enumerate(data)], SCHEMA)
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    done = line_dedup.line_dedup(df)
    assert done.columns == df.columns
    got = {r["__id"]: r.text for r in done.collect()}
    assert [got[k] for k in range(len(data))] == slow(data, hashes)


def test_a_run_of_three(spark):
    data = [(1, "a\nb\nc\nd"), (2, "x\na\nb\ny"), (3, "z\nb\nc\nd\na")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(df, run=3).collect()}
    assert got == {1: data[0][1], 2: data[1][1], 3: "z\na"}


def test_empty(spark):
    assert line_dedup.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_winnowing_selects_in_every_window():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, 400, np.uint64)
    for w in (1, 2, 5):
        at = set(line_dedup.winnow(h, w).tolist())
        assert all(at & set(range(i, i + w)) for i in range(len(h) - w + 1))
