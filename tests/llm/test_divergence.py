"""Source divergence against a plain count, and its edge cases (SQL: tests/test_oracle.py)."""

import re
from collections import Counter

from tessera.llm import divergence

SCHEMA = "lang string, source string, text string"


def brute(rows, min_docs=3, most=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = [(lang, source, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for a, _, ts in terms if a == lang for t in set(ts))
        kept = {t for t, n in docs.items() if n >= min_docs}
        count = {s: Counter() for a, s, _ in rows if a == lang}
        for a, s, ts in terms:
            if a == lang:
                count[s].update(t for t in ts if t in kept)
        whole = sum(count.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def ranked(source, part, found):
            for k, (item, value) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0].encode())), 1):
                if part == "pair" or k <= most:
                    out.append((lang, source, part, item, value, k))

        for s, c in count.items():
            p = {t: share(c, t) for t in kept}
            pairs = {}
            for o, d in count.items():
                if o != s:
                    pairs[o] = sum((p[t] - share(d, t)) ** 2 // share(d, t) for t in kept)
            ranked(s, "pair", pairs)
            q = {t: share(whole, t) for t in kept}
            ranked(s, "term", {t: (p[t] - q[t]) ** 2 // q[t] for t in kept if c[t] and p[t] > q[t]})
    return sorted(out)


ROWS = [("en", "a", "Apple apple pear, plum_x 3fig"), ("en", "a", "apple PEAR"), ("en", "b", "apple pear kiwi kiwi"), ("en", "b", "kiwi plum kiwi x"),
        ("en", "c", ""), ("en", "d", None), ("en", None, "Kiwi plum"), (None, "a", "été Été ÉTÉ"), (None, None, "été"), (None, "b", "été eté"),
        ("de", "z", "1 2 3"), ("de", "y", None), ("en", "a", "apple PEAR")]


def test_equals_a_plain_count(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for least, most in ((3, 200), (1, 2), (2, 1)):
        got = sorted(tuple(r) for r in divergence.source_divergence(df, min_docs=least, most=most).collect())
        assert got == brute(ROWS, least, most)


def test_equal_values_beyond_the_last_rank(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [("en", "a", " ".join(words))] * 3 + [("en", "b", "other " * 50)] * 3 + [("en", "c", words[5] + " " + words[5])]
    got = sorted(tuple(r) for r in divergence.source_divergence(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)
    assert sum(r[2] == "term" and r[1] == "a" for r in got) == 200


def test_no_rows_other_columns_and_flushes(spark, monkeypatch):
    df = spark.createDataFrame([(*r, 1, 2) for r in ROWS], SCHEMA + ", term int, n int")
    assert divergence.source_divergence(df.limit(0)).count() == 0
    monkeypatch.setattr(divergence, "HELD", 2)
    assert sorted(tuple(r) for r in divergence.source_divergence(df).collect()) == brute(ROWS)


def test_counts_beyond_a_long_product(spark):
    """1e9 times a count of 1e13 does not fit a long; shares are still exact."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(10**13, 3 * 10**13, 7)], "n long, total long, terms long")
    got = df.select(divergence.share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 10**9 * (10**13 + 1) // (3 * 10**13 + 7)
