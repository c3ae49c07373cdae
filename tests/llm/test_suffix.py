import numpy as np
import pytest

from tessera.llm import suffix

SCHEMA = "doc_id long, text string, th int, start string"


def documents():
    rng = np.random.default_rng(8)
    say = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    passages = [say(n) for n in (50, 55, 64, 120)]
    docs = {i: say(int(rng.integers(1, 150))) for i in range(60)}
    for i in range(60, 110):
        p = passages[i % 4]
        docs[i] = say(int(rng.integers(0, 60))) + p + say(int(rng.integers(0, 60)))
    for i in range(110, 120):
        docs[i] = docs[i - 100]
    docs[120] = docs[70][:-1] + ["changed"]
    docs[121] = say(30) + passages[3][:49] + say(30)
    docs[122] = passages[3] + say(5) + passages[3]
    docs[123] = ["again"] * 300
    docs[124] = say(20_000) + passages[1]
    return {i: " ".join(w) for i, w in docs.items()} | {200: None, 201: "", 202: " \n"}, passages


def earlier_windows(docs, size):
    """Word numbers of every document that lie in a window of ``size`` words found earlier, by comparing all windows."""
    seen, out = set(), {}
    for i in sorted(docs):
        words = (docs[i] or "").split()
        marked = set()
        for k in range(len(words) - size + 1):
            w = tuple(words[k:k + size])
            if w in seen:
                marked |= set(range(k, k + size))
            seen.add(w)
        out[i] = marked
    return out


def test_against_brute_force(spark):
    docs, passages = documents()
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs.items()], SCHEMA).repartition(4)
    spans = suffix.repeated_passages(df).collect()
    found = {i: set() for i in docs}
    for r in spans:
        assert r.n_words == r.end_word - r.start_word >= 50
        assert not found[r.doc_id] & set(range(r.start_word, r.end_word))
        found[r.doc_id] |= set(range(r.start_word, r.end_word))
        assert all(s <= r.doc_id for s in r.source_ids)
    whole = earlier_windows(docs, 50)
    assert found == whole
    assert sum(map(len, whole.values())) > 3000
    assert not found[121] and not any(found[i] for i in range(60))


def test_every_earlier_place_counts(spark):
    rng = np.random.default_rng(12)
    say = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    docs = {}
    for j in range(12):  # each block of the passage first stands in a document of its own
        p = say(50 if j < 8 else 70)
        whole = say(10) + p + say(10)
        at = suffix.suffixes(suffix.word_hashes(" ".join(whole)), 25)
        pieces = [p[k - 10:k + 15] for k in at if 10 <= k <= len(p) - 15]
        for piece in [*pieces, p[:35], p[-35:]]:
            docs[len(docs)] = say(int(rng.integers(0, 9))) + piece + say(int(rng.integers(0, 9)))
        for _ in range(3):
            docs[len(docs)] = say(int(rng.integers(1, 30))) + p + say(int(rng.integers(1, 30)))
    docs = {i: " ".join(w) for i, w in docs.items()}
    found = {i: set() for i in docs}
    for r in suffix.repeated_passages(spark.createDataFrame([(i, t, 0, "x") for i, t in docs.items()], SCHEMA).repartition(4)).collect():
        found[r.doc_id] |= set(range(r.start_word, r.end_word))
    whole = earlier_windows(docs, 50)
    assert sum(map(len, whole.values())) >= 12 * 2 * 50
    assert found == whole


def test_cutting(spark):
    docs, _ = documents()
    rows = [(i, t, 0, "x") for i, t in docs.items()] + [(5, docs[5], 0, "x"), (None, docs[70], 0, "x"), (None, "short", 0, "x")]
    done = suffix.suffix_dedup(spark.createDataFrame(rows, SCHEMA))
    assert done.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    got = {}
    for r in done.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[5] == [docs[5]] * 2 and got[200] == [None] and got[201] == [""] and sorted(got[None]) == ["", "short"]
    assert len(got[123][0].split()) < 25 and got[113] == [""]
    assert not any(earlier_windows({i: t[0] for i, t in got.items() if i is not None}, 50).values())


def test_empty_and_parameters(spark):
    assert suffix.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0
    assert suffix.suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        suffix.repeated_passages(spark.createDataFrame([], SCHEMA), min_words=10)


@pytest.mark.parametrize("seed", range(4))
def test_small_vocabularies_and_shared_pieces(spark, seed):
    """Texts glued from common pieces of all lengths, few words, repeats inside a document, many partitions with borders inside groups."""
    rng = np.random.default_rng(seed)
    pieces = [[f"w{x}" for x in rng.integers(0, 3 + 40 * (seed % 2), int(rng.integers(5, 90)))] for _ in range(15)]
    docs = {}
    for i in range(80):
        words = [w for _ in range(int(rng.integers(0, 7))) for w in pieces[int(rng.integers(0, 15))][:int(rng.integers(1, 90))]]
        docs[i] = " ".join(words)
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs.items()] + [(3, docs[3], 1, "y")], SCHEMA)
    found = {i: set() for i in docs}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for r in suffix.repeated_passages(df).collect():
            found[r.doc_id] |= set(range(r.start_word, r.end_word))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == earlier_windows(docs, 50)
