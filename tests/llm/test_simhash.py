import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components

SCHEMA = "doc_id long, text string, key string, __id long, fingerprint string"


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.translate(str.maketrans("\t\n\x0b\f\r", "     ")).split(" ") if w]
    if not words:
        return 0
    shingles = [words] if len(words) < k else [words[i:i + k] for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_golay_keys_meet_within_two_errors():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 23, 3000)
    for _ in range(3):
        b = a ^ (1 << rng.integers(0, 23, len(a))) ^ (1 << rng.integers(0, 23, len(a)))
        ka, kb = simhash.golay_keys(a), simhash.golay_keys(b)
        assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(ka, kb, strict=True))
    sizes = (simhash.golay_keys(a) >= 0).sum(axis=1)
    assert set(sizes.tolist()) == {1, 6}


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("bucket", [2, 64])
def test_links_connect_what_is_near(spark, monkeypatch, distance, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(2)
    fps = set(rng.integers(0, 1 << 64, 150, np.uint64).tolist()) | {0, (1 << 64) - 1}
    for centre in list(fps)[:30]:  # chains and clouds
        for _ in range(6):
            centre ^= 1 << int(rng.integers(64))
            fps.add(centre ^ (1 << int(rng.integers(64))))
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.node: r.root for r in components(simhash.links(df, distance)).collect()}
    want = slow_components(sorted(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
    assert {n: found.get(n, n) for n in signed} == want


def rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(50)] + ["Ärger", "É", "日本"]
    out = []
    for i in range(60):
        out.append((i, " ".join(rng.choice(words, int(rng.integers(1, 40))))))
    out += [(100 + i, out[7][1].upper() if i % 2 else out[7][1]) for i in range(20)]  # copies but for case
    out += [(200, None), (201, ""), (202, " \t\n"), (203, "one"), (204, "one two"), (None, out[7][1]), (None, "nobody else"), (5, out[5][1])]
    out += [(300, "a b c " * 40_000), (301, "a b c " * 40_000 + "d")]  # longer than a block
    return out


def test_operator_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame([(i, t, "k", 1, "f") for i, t in data], SCHEMA)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.simhash_near_dedup(df).collect())
    fps = [slow_fingerprint(t) for _, t in data]
    root = slow_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), f in zip(data, fps, strict=True):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((str(i), f"{f:016x}", least.get(root[f])) for (i, _), f in zip(data, fps, strict=True))
    assert got == want


def test_keep_one(spark):
    df = spark.createDataFrame([(i, t, "k", 1, "f") for i, t in rows()], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    components_ = {r.component_id for r in simhash.simhash_near_dedup(df).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(c for c in components_ if c is not None)
    assert ids.count(None) == 1  # the one whose component has no id


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_near_dedup(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.simhash_near_dedup(empty, max_distance=3)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (129, 128)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
