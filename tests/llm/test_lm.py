"""The language model against plain counts, exact seating probabilities and held-out text."""

import math
import pathlib
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tessera.llm import lm, queries

SCHEMA = "doc_id long, text string"


def tokens_of(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [""]


def base(rows):
    """doc_id → (held_out, n_tokens, n_known, train_tokens, base_score)."""
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    count = Counter(t for i, text in rows if not held[i] for t in tokens_of(text))
    n, v = sum(count.values()), len(count)
    return {i: (held[i], len(ts), sum(count[t] > 0 for t in ts), n, sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts))
            for i, text in rows for ts in [tokens_of(text)]}


def test_query_on_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want, got = base(rows), queries.op11_lm_scores(spark, sf_dir).collect()
    assert len(got) == len(rows) and {r["doc_id"] for r in got} == set(want)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9)
    for held in (True, False):  # the model predicts learned and held-out texts better than the word shares do
        some = [r for r in got if r["held_out"] == held]
        assert sum(r["score"] for r in some) > sum(r["base_score"] for r in some) + 0.02 * sum(r["n_tokens"] for r in some)
    again = {r["doc_id"]: r["score"] for r in queries.op11_lm_scores(spark, sf_dir).collect()}
    assert all(r["score"] == pytest.approx(again[r["doc_id"]], rel=1e-9) for r in got)


def test_scores_equal_the_averaged_predictive_of_the_samples(spark):
    rows = [(i, t) for i, t in enumerate(["the cat sat on the mat", "the dog sat on the cat", "A cat, a dog", "the the the mat", None, "new words only", "mat on the cat sat"] * 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    held = F.col("doc_id") % 7 == 5
    contexts = 4
    learn = [(i, t) for i, t in rows if i % 7 != 5]
    got = {r["doc_id"]: r["score"] for r in lm.lm_scores(df, held, contexts=contexts, samples=2).collect()}
    key = df.select(F.col("doc_id").cast("string").alias("key"), "text", held.alias("held"))
    blocks = lm.written(key.mapInArrow(lambda b: lm._blocks(b, contexts), lm.BLOCKS), "b")
    state, kept = lm.learned(blocks, contexts, 2)
    words = {}
    for r in state.collect():
        arrays = [np.frombuffer(r[k], kind) for k, kind in (("ctx", np.uint16), ("n", np.int64), ("t_sum", np.int64), ("roots", np.int64))]
        words[bytes(r["w"])] = arrays
    cells = Counter()
    for _, t in learn:
        last = contexts
        for w in tokens_of(t):
            cells[last, w.encode()] += 1
            last = zlib.crc32(w.encode()) % contexts
    assert {(int(c), w): int(n) for w, (ctx, ns, _, _) in words.items() for c, n in zip(ctx, ns)} == cells

    def p(ctx, w):
        where, n, t, roots = words.get(w, ([], [], [], [0, 0, 0, 0]))
        total = 0.0
        for s, k in enumerate(kept):
            total += (1 + k.discount * k.tables[ctx]) / (1 + k.customers[ctx]) * k.parent(roots[2 * s], roots[2 * s + 1])
        at = list(where).index(ctx) if ctx in list(where) else None
        if at is not None:
            total += (2 * n[at] - kept[0].discount * t[at]) / (1 + kept[0].customers[ctx])
        return total / 2

    for ctx in range(contexts + 1):  # a distribution over the learned words and one that is not
        assert sum(p(ctx, w) for w in words) + p(ctx, b"?") == pytest.approx(1)
    for i, t in rows:
        last, want = contexts, 0.0
        for w in tokens_of(t):
            want += math.log10(p(last, w.encode()))
            last = zlib.crc32(w.encode()) % contexts
        assert got[i] == pytest.approx(want, rel=1e-9)


def partitions(n):
    """Every way to seat n customers: lists of table numbers, each table opened in turn."""
    for seats in product(range(n), repeat=n):
        if all(s <= max((-1, *seats[:i])) + 1 for i, s in enumerate(seats)):
            yield seats


def rising(start, step, n):
    return math.prod(start + step * k for k in range(n))


def exact_tables(every, ns, others):
    """The joint posterior of the numbers of tables of a word's cells, by enumeration of both levels."""
    weight, d, d0 = Counter(), every.discount, every.parent_discount
    for cells in product(*[list(partitions(n)) for n in ns]):
        tables = [list(Counter(seats).values()) for seats in cells]
        low = math.prod(rising(1 + d * o, d, len(t)) * math.prod(rising(1 - d, 1, s - 1) for s in t) for t, o in zip(tables, others))
        n_root, high = sum(map(len, tables)), 0.0
        for up in partitions(n_root):
            tops = Counter(up).values()
            high += rising(1 + d0 * every.parent_tables, d0, len(tops)) * (1 / (every.vocabulary + 1)) ** len(tops) * math.prod(rising(1 - d0, 1, s - 1) for s in tops)
        weight[tuple(map(len, tables))] += low * high / rising(1 + every.parent_customers, 1, n_root)
    return {t: w / sum(weight.values()) for t, w in weight.items()}


@pytest.mark.parametrize("ns, tables, parent", [((3,), (500,), 300), ((5,), (900,), 100), ((2, 3), (700, 500), 600), ((1, 4), (300, 700), 200)])
def test_rounds_sample_the_posterior(ns, tables, parent):
    """Many rounds over one word, the seats of all others fixed; copies of the word are independent chains."""
    chains, rounds = 400, 120
    every = lm.Restaurants([0] * len(ns), list(tables), 900, parent, 0.6, 0.3, 2000, 30)
    every.ways, every.parent_ways = lm.log_ways(lm.BIG, 0.6), lm.log_ways(lm.BIG_PARENT, 0.3)
    n, ctx, words = np.tile(np.array(ns, np.int64), chains), np.tile(np.arange(len(ns)), chains), [str(i).encode() for i in range(chains)]
    t, roots, seen = np.ones(len(n), np.int64), [[1]] * chains, Counter()
    for k in range(rounds):
        s = lm.Seats(every, 1000 + k, words, np.full(chains, len(ns)), ctx, n, t, {}, roots)
        s.others = np.tile(np.array(tables), chains)
        s.round(False)
        t, roots = s.t, s.roots
        if k >= 20:
            seen.update(map(tuple, t.reshape(chains, len(ns)).tolist()))
    total = sum(seen.values())
    want = exact_tables(every, ns, tables)
    assert 0.02 < max(want.values()) < 0.98
    for key, share in want.items():
        assert seen[key] / total == pytest.approx(share, abs=0.02)


def test_moves_of_single_customers_agree_with_the_drawn_number():
    """The same cell by table sizes and by the weights of its numbers of tables."""
    rnd, n, d, others, p = random.Random(3), 9, 0.6, 4, 0.07
    ways = lm.log_ways(n, d)
    weight = np.exp(ways[n, 1:]) * np.cumprod([1.0] + [(1 + d * (others + t)) * p for t in range(1, n)])
    want = weight / weight.sum()
    sizes, seen, runs = lm.seat(rnd, n, d, others, lambda t: p), Counter(), 200_000
    for _ in range(runs):
        lm.leave(rnd, sizes, n)
        lm.enter(rnd, sizes, n - 1, d, others, lambda t: p)
        assert sum(sizes) == n
        seen[len(sizes)] += 1
    for t in range(1, n + 1):
        assert seen[t] / runs == pytest.approx(want[t - 1], abs=0.015)


def test_ways_count_partitions():
    ways = np.exp(lm.log_ways(5, 0.6))
    for n in range(1, 6):
        want = Counter()
        for seats in partitions(n):
            sizes = Counter(seats).values()
            want[len(sizes)] += math.prod(rising(0.4, 1, s - 1) for s in sizes)
        assert all(ways[n, t] == pytest.approx(want[t]) for t in range(1, n + 1))


def test_first_seating_follows_the_sequential_draws():
    """The jumps between new tables give the same tables as one customer after another."""
    n, others = 12, 5

    def p(t):
        return 0.1 / t

    def one_by_one(rnd):
        sizes = [1]
        for j in range(1, n):
            lm.enter(rnd, sizes, j, 0.6, others, p)
        return sizes

    runs, found = 20_000, []
    for f in (one_by_one, lambda rnd: lm.seat(rnd, n, 0.6, others, p)):
        rnd = random.Random(5)
        rows = [f(rnd) for _ in range(runs)]
        assert all(sum(r) == n for r in rows)
        found.append((sum(len(r) for r in rows) / runs, sum(r[0] for r in rows) / runs, sum(max(r) for r in rows) / runs))
    assert found[0] == pytest.approx(found[1], abs=0.08)


def test_words_of_many_customers_keep_their_sizes(spark, monkeypatch):
    """Cells and parents beyond the bounds, and such that cross them between rounds."""
    monkeypatch.setattr(lm, "BIG", 16)
    monkeypatch.setattr(lm, "BIG_PARENT", 20)
    rnd, contexts = random.Random(1), 40
    every = lm.Restaurants([900] * 41, [60] * 41, 500, 20, 0.7, 0.5, 50, 900)
    cells = [(f"w{i}".encode(), {c: rnd.choice([1, 2, 3, 10, 30, 200]) for c in range(0, contexts, i + 1)}) for i in range(12)] + [(b"once", {3: 1})]
    rows = [(w, sum(c.values()), np.array(list(c), np.uint16).tobytes(), np.array(list(c.values()), np.int64).tobytes()) for w, c in cells]
    batch = lm._rows(rows, lm.CELLS)
    for k in range(4):
        out = list(lm._sampled(iter([batch] if k == 0 else out), every, 7 + k, k == 0))
        got = {r["w"]: r for b in out for r in b.to_pylist()}
        assert set(got) == {w for w, _ in cells}
        for w, c in cells:
            t = np.frombuffer(got[w]["t"], np.int64)
            n = np.array(list(c.values()))
            assert (t >= 1).all() and (t <= n).all()
            sizes, at = np.frombuffer(got[w]["sizes"], np.int64), 0
            for a, b in zip(n, t):
                if a > 16:
                    assert sizes[at:at + b].sum() == a
                    at += b
            assert at == len(sizes)
            root = np.frombuffer(got[w]["root"], np.int64)
            assert root.sum() == t.sum() if t.sum() > 20 else len(root) == 1 and 1 <= root[0] <= t.sum()
            pairs = np.frombuffer(got[w]["roots"], np.int64)
            assert len(pairs) == 2 * k + 2 and (tuple(pairs[-2:]) == (t.sum(), len(root) if t.sum() > 20 else root[0]))


def test_nulls_repeats_empty_and_blocks(spark, monkeypatch):
    rows = [(None, "a b"), (None, None), (3, "a b"), (3, "a b"), (4, ""), (5, " \t\n"), (6, "Ä ä A"), (7, "x" * 100_000)]
    df = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], SCHEMA + ", w string, block int, held int").repartition(2)
    one = lambda d: sorted(((str(r[0]), *r[1:4], round(r["base_score"], 9)) for r in d.collect()))
    got = one(lm.lm_scores(df, F.lit(None).cast("boolean")))
    assert len(got) == 8 and all(not r[1] and r[2] == r[3] for r in got)
    assert [r[2] for r in got] == [2 if i == 7 else 4 if i == 6 else 1 if not (t or "").strip() else 3 for i, t in sorted(rows, key=lambda r: (str(r[0]), len(tokens_of(r[1]))))]
    monkeypatch.setattr(lm, "BLOCK", 3)
    monkeypatch.setattr(lm, "PLACES", 2)
    assert one(lm.lm_scores(df, F.lit(False))) == got
    nothing = lm.lm_scores(df, F.lit(True)).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in nothing} == {(0, 0, 0.0, 0.0)}
    assert lm.lm_scores(df.limit(0), F.lit(False)).count() == 0


def test_blocks_hold_every_place(monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 500)
    monkeypatch.setattr(lm, "PIECE", 700)
    monkeypatch.setattr(lm, "BLOCK_DOCS", 40)
    monkeypatch.setattr(lm.TaskContext, "get", staticmethod(lambda: type("At", (), {"partitionId": lambda self: 3})()))
    rnd, contexts = random.Random(4), 11
    texts = [None, "", " \t\x0b\x0c\r\n", "\x1cA\x1f \u00a0b", "Ää É"] + [" ".join(rnd.choices("a B c dd e \n f".split(" "), k=rnd.choice([0, 1, 5, 90, 700]))) for _ in range(120)]
    held = [rnd.random() < 0.3 for _ in texts]
    batches = [pa.record_batch({"key": pa.array([str(i) for i in range(a, b)], pa.string()), "text": pa.array(texts[a:b], pa.string()),
                                "held": pa.array(held[a:b], pa.bool_())}) for a, b in ((0, 50), (50, 50), (50, len(texts)))]
    got, heads, learned = Counter(), {}, Counter()
    for batch in lm._blocks(iter(batches), contexts):
        rows = batch.filter(pc.is_valid(batch["w"]))
        for r in batch.filter(pc.is_null(batch["w"])).to_pylist():
            heads[r["block"], r["doc"]] = int(r["key"])
            assert r["n_tokens"] == len(tokens_of(texts[int(r["key"])])) and r["held"] == held[int(r["key"])]
        if len(rows):
            raw, size = lm._flat(rows["places"], np.uint8)
            ctx, cells = lm._flat(rows["ctxs"], np.uint16)
            per = (size - cells) // 2
            count, low, high = lm._layout(cells, per)
            n = raw[count].astype(np.int64)
            docs = lm._unstepped(raw[low] | raw[high].astype(np.uint16) << 8, n)
            word = np.repeat(np.arange(len(rows)), per)
            for w, c, d in zip(word.tolist(), np.repeat(ctx, n).tolist(), docs.tolist()):
                got[rows["block"][w].as_py(), d, rows["w"][w].as_py(), c] += 1
            for one in lm._context_counts(iter([rows.filter(pc.greater(rows["n_train"], 0))])):
                for r in one.to_pylist():
                    for c, k in zip(np.frombuffer(r["ctx"], np.uint16).tolist(), np.frombuffer(r["n"], np.uint32).tolist()):
                        learned[r["w"], c] += k
    assert len({b for b, _ in heads}) > 5 and sorted(heads.values()) == list(range(len(texts)))
    want, want_learned = Counter(), Counter()
    for i, t in enumerate(texts):
        last = contexts
        for w in tokens_of(t):
            want[i, w.encode(), last] += 1
            if not held[i]:
                want_learned[w.encode(), last] += 1
            last = zlib.crc32(w.encode()) % contexts
    assert Counter({(heads[b, d], w, c): k for (b, d, w, c), k in got.items()}) == want
    assert learned == want_learned


def test_a_context_of_more_places_than_a_byte_counts(spark):
    df = spark.createDataFrame([(1, "x " * 1000), (2, "x x y"), (3, "x " * 300)], SCHEMA)
    got = {r["doc_id"]: r for r in lm.lm_scores(df, F.col("doc_id") == 3).collect()}
    assert got[1]["train_tokens"] == 1005 and got[3]["n_known"] == 301
    assert got[1]["base_score"] == pytest.approx(1000 * math.log10(1002.5 / 1007) + math.log10(2.5 / 1007))
    assert -6 < got[3]["score"] < -3  # all but the first word and the end are nearly sure


def test_every_word_is_a_context_of_its_own(spark):
    """Two words that any hash to 4,096 contexts took for one are told apart."""
    first, seen = None, {}
    for i in range(100_000):
        other = seen.setdefault(zlib.crc32(f"w{i}".encode()) % 4096, f"w{i}")
        if other != f"w{i}":
            first, second = other, f"w{i}"
            break
    rows = [(i, f"{first} left" if i % 2 else f"{second} right") for i in range(400)] + [(1000, f"{first} left"), (1001, f"{first} right")]
    got = {r["doc_id"]: r["score"] for r in lm.lm_scores(spark.createDataFrame(rows, SCHEMA), F.col("doc_id") >= 1000).collect()}
    assert got[1000] > got[1001] + 1


def test_scores_equal_the_averaged_predictive_with_every_word_as_context(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choices(["the", "cat", "Dog", "sat", "on", f"x{i % 9}"], weights=[9, 4, 4, 3, 2, 1], k=rnd.choice([0, 1, 7, 60])))) for i in range(120)] + [(999, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    held = F.col("doc_id") % 7 == 5
    monkeypatch.setattr(lm, "BLOCK", 600)
    got = {r["doc_id"]: r for r in lm.lm_scores(df, held).collect()}
    key = df.select(F.col("doc_id").cast("string").alias("key"), "text", held.alias("held"))
    blocks = lm.written(key.mapInArrow(lambda b: lm._blocks(b, None), lm.BLOCKS), "b")
    words, kept = lm.learned_words(blocks, 2)
    number = lambda w: int(lm._ids(pa.array([w.encode()], pa.binary()))[0])
    cells, customers = Counter(), Counter()
    for i, t in rows:
        for last, w in zip(["", *tokens_of(t)], tokens_of(t)):
            if i % 7 != 5:
                cells[number(last), number(w)] += 1
                customers[number(last)] += 1
    learned, n_cells = {}, 0
    for r in words.collect():
        vals, ctx, h = (np.frombuffer(r[k], kind) for k, kind in (("vals", np.float64), ("ctx", np.uint64), ("h", np.float64)))
        w = r["id"] % (1 << 64)
        learned[w] = (vals, dict(zip(ctx.tolist(), h.tolist())))
        n_cells += len(ctx)
        assert vals[0] == customers[w] and r["c"] == sum(n for (_, b), n in cells.items() if b == w)
    assert n_cells == len(cells) and all(c in learned[w][1] for c, w in cells)
    d = kept[0].discount
    for (c, w), n in cells.items():  # between one table and as many as customers in each of the two samples
        assert 2 * n * (1 - d) - 1e-9 <= learned[w][1][c] <= 2 * (n - d) + 1e-9
    for w in learned:  # the tables of a context are those of its cells
        own = sum((2 * n - learned[b][1][c]) / d for (c, b), n in cells.items() if c == w)
        assert own == pytest.approx(learned[w][0][1] + learned[w][0][2])
    unknown = (np.array([0, 0, 0, *[k.parent(0, 0) for k in kept]]), {})

    def p(c, w):
        (n, *tables), (vals, hits) = learned.get(c, unknown)[0][:3], learned.get(w, unknown)
        return (sum((1 + d * t) * up for t, up in zip(tables, vals[3:])) + hits.get(c, 0)) / 2 / (1 + n)

    for c in learned:
        assert sum(p(c, w) for w in learned) + p(c, -1) == pytest.approx(1)
    for i, t in rows:
        want = sum(math.log10(p(number(a), number(b))) for a, b in zip(["", *tokens_of(t)], tokens_of(t)))
        assert got[i]["score"] == pytest.approx(want, rel=1e-9) and got[i]["n_tokens"] == len(tokens_of(t))


def _texts(n, words, seed=5):
    rnd = random.Random(seed)
    common = [f"w{i}" for i in range(2000)]
    return [(i, " ".join(rnd.choice(common) if rnd.random() < 0.9 else f"x{rnd.randrange(1 << 40):x}" for _ in range(words))) for i in range(n)]


def test_blocks_take_no_more_disk_than_the_documents(spark, tmp_path, monkeypatch):
    """All that is written stays under a bound in sizes of the input; blocks alone took more than twice the documents."""
    df = spark.createDataFrame(_texts(3000, 120), SCHEMA).repartition(2)
    size = lambda path: sum(f.stat().st_size for f in path.rglob("*.parquet"))
    df.write.option("compression", "zstd").parquet(str(tmp_path / "in"))
    sizes, write = {}, lm.written

    def written(table, name):
        out = write(table, name)
        sizes[name] = size(pathlib.Path(out.scratch_path.removeprefix("file://").removeprefix("file:")))
        return out

    monkeypatch.setattr(lm, "written", written)
    lm.lm_scores(spark.read.parquet(str(tmp_path / "in")), F.col("doc_id") % 5 == 1).count()
    whole = size(tmp_path / "in")
    assert 0 < sizes["lm-blocks"] < 1.1 * whole
    assert 0 < sizes["lm-seats"] < 0.6 * whole  # words read once have no seats to keep


def test_shares_of_buckets_give_the_same_scores(spark, monkeypatch):
    rows = [*_texts(200, 40), (900, None), (901, "w1 w1 w1 w1"), (902, "w1 unseen w2")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    held = F.col("doc_id") % 5 == 2
    found = lambda: {r["doc_id"]: tuple(r) for r in lm.lm_scores(df, held).collect()}
    want = found()
    assert len(want) == len(rows)
    monkeypatch.setattr(lm, "TURNS", 3)
    got = found()
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert got[i][:5] == r[:5] and got[i][5:] == pytest.approx(r[5:], rel=1e-9)


def test_packed_counts_and_answers_hold_every_cell(monkeypatch):
    for k, v in (("PACKED", 50), ("CHUNK", 7), ("CHUNK_CELLS", 5), ("PLACES", 40), ("BLOCK", 900)):
        monkeypatch.setattr(lm, k, v)
    monkeypatch.setattr(lm.TaskContext, "get", staticmethod(lambda: type("At", (), {"partitionId": lambda self: 3})()))
    rows, bits = [*_texts(150, 30), (900, None), (901, "w1 w1 w1 w1")], 3
    batch = pa.record_batch({"key": pa.array([str(i) for i, _ in rows]), "text": pa.array([t for _, t in rows]), "held": pa.array([i % 5 == 2 for i, _ in rows])})
    blocks = [b for b in lm._blocks(iter([batch]), None) if not b["w"].null_count]
    number = lambda w: int(lm._ids(pa.array([w], pa.binary()))[0])
    cells, held_out = Counter(), set()
    for i, t in rows:
        for last, w in zip(["", *tokens_of(t)], tokens_of(t)):
            if i % 5 != 2:
                cells[number(last.encode()), w.encode()] += 1
            else:
                held_out.add((number(last.encode()), w.encode()))
    counts = sorted((c for b in blocks for c in lm._pair_counts(iter([b]), bits)), key=lambda c: c["bucket"][0].as_py())
    merged, got = list(lm._parted(iter(counts))), Counter()
    assert len(blocks) > 5 and len({r["chunk"] for b in merged for r in b.to_pylist()}) > 2
    for r in (r for b in merged for r in b.to_pylist()):
        got.update({(int(c), r["w"]): 1 for c in np.frombuffer(r["once"], np.uint64)})
        got.update({(int(c), r["w"]): int(n) for c, n in zip(np.frombuffer(r["ctx"], np.uint64), np.frombuffer(r["n"], np.int64))})
        assert r["c"] == sum(n for (_, w), n in cells.items() if w == r["w"]) and r["bucket"] == number(r["w"]) >> 64 - bits
    assert got == cells
    known = [b.select(["w", "c"]).append_column("ctx", b["once"]) for b in merged]
    seated = [pa.record_batch({"w": b["w"], "ctx": b["ctx"], "n": b["n"], "t_sum": b["n"], "roots": lm._packed(np.full(4 * len(b), 5), np.full(len(b), 4))}) for b in merged]
    parts = [*lm._cell_parts(iter(known), bits), *lm._seat_parts(iter(seated), bits), *(a for k in range(2) for a in lm._wanted(iter(blocks), bits, (k, 2)))]
    table = pa.Table.from_batches(parts).sort_by([("bucket", "ascending"), ("number", "ascending")])
    answers = [r for b in lm._answered(iter(table.to_batches(max_chunksize=7)), 2) for r in b.to_pylist()]
    for b in blocks:
        words, pairs = lm._opened(b.to_pylist()[0])
        pairs = np.unique(pairs)
        per = np.bincount(pairs >> 32, minlength=len(words))
        ids, seen = lm._ids(words), 0
        for r in (r for r in answers if r["block"] == b["block"][0].as_py()):
            said, n = lm._loosened(r["words"], np.int64).reshape(9, -1), lm._loosened(r["cells"], np.int64).reshape(2, -1)[0]
            at = 0
            for w, c in zip(said[0].tolist(), said[1].tolist()):
                ctxs = ids[pairs[pairs >> 32 == w] & 0xFFFFFFFF].tolist()
                text = words[w].as_py()
                assert n[at:at + per[w]].tolist() == [cells[x, text] for x in ctxs]
                assert all((x, text) in cells or (x, text) in held_out for x in ctxs) and c == sum(k for (_, x), k in cells.items() if x == text)
                at, seen = at + int(per[w]), seen + 1
            assert at == len(n)
        assert seen == len(words)
