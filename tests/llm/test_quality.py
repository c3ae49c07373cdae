import math
import random
import re
from collections import Counter

import pytest
import xxhash

from tessera.llm import quality

SCHEMA = "doc_id long, text string, n_words string, _q int, row string"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked))


def documents():
    rng = random.Random(12)
    out = [(i, " ".join(f"word{rng.randrange(300)}" for _ in range(80))) for i in range(30)]
    out += [(100 + i, " ".join(f"x{i}y{k}!!" for k in range(80))) for i in range(10)]
    out += [(200, None), (201, ""), (202, "a a a a " * 50), (203, "one\n\ntwo\none\n  \none #*$ <b>|&%"), (204, "Ä Ö Ü\x0bx\x0cy\r\n日本 日本"),
            (205, "very long " * 60_000), (None, out[0][1]), (3, out[3][1])]
    out += [(300, " ".join(f"{a}" for a in list(range(70)) * 2)), (301, " ".join(str(k % 200) for k in range(1000)))]
    return out


def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(0, 30, 2)] + [(0, 1, 0), (100, 0, 0), (1, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")


def test_against_brute_force(spark):
    data = documents()
    df = spark.createDataFrame([(i, t) for i, t in data], "doc_id long, text string")
    got = quality.quality_rules(df, labels(spark)).collect()
    bucket = lambda w: xxhash.xxh64(w.encode(), seed=42).intdigest()
    signed = lambda h: (h - (1 << 64) if h >> 63 else h) % quality.BUCKETS
    grams = {t: [signed(bucket(w)) for w in WORD.findall(t or "")] for _, t in data}
    raw, target = Counter(), Counter()
    for i, t in data:
        raw.update(grams[t])
        if i is not None and i < 30 and i % 2 == 0:
            target.update(grams[t])
    r, n = raw.total(), target.total()
    llr = lambda t: sum(math.log((target[b] / n + raw[b] / r) / 2) - math.log(raw[b] / r) for b in grams[t]) / max(1, len(grams[t]))
    want = Counter()
    for i, t in data:
        base = slow_base(t)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        want[(i, *base, failed, not failed and llr(t) >= quality.THRESHOLD, round(llr(t), 6) + 0.0)] += 1
    assert Counter((x.doc_id, *[x[c] for c in BASE], x.base_failed, x.kept, round(x.llr, 6) + 0.0) for x in got) == want
    assert any(k[-2] for k in want) and any(not k[-2] and not k[-3] for k in want)


def test_keep_good_with_clashing_columns(spark):
    df = spark.createDataFrame([(i, t, "x", 1, "r") for i, t in documents()], SCHEMA)
    kept = quality.keep_good(df, labels(spark))
    assert kept.columns == df.columns
    plain = quality.quality_rules(df.select("doc_id", "text"), labels(spark)).filter("kept")
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in plain.collect())


def test_no_labels_and_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(i, t) for i, t in documents()], "doc_id long, text string")
    assert {r.llr for r in quality.quality_rules(df, none).collect()} == {0.0}
    assert quality.quality_rules(df.limit(0), labels(spark)).count() == 0


@pytest.mark.parametrize("sizes", [(2,), (1, 2)])
def test_other_sizes(spark, sizes):
    df = spark.createDataFrame([(i, t) for i, t in documents()], "doc_id long, text string")
    rows = {r.doc_id: r.llr for r in quality.quality_rules(df, labels(spark), sizes=sizes).collect()}
    assert rows[2] > rows[105]


def test_clean_documents_stay(spark, sf_dir):
    """Of the labelled documents, good ones stay and bad ones go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.quality_rules(docs, marks).join(marks, "doc_id").filter("toxic = 0 and not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    assert good and sum(good) >= 0.99 * len(good)
