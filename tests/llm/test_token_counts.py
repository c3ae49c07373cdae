import numpy as np
import pytest

from tessera.llm import token_counts as tc

TEXTS = {1: "Hello world\nsecond line, naïve café\n\n日本語 🙂 text\nlast", 2: "", 3: None, 4: "\n", 5: "one line", 6: "trailing\n", 7: "word " * 60_000 + "\nend", 8: "🙂🙂\n🙂"}
SCHEMA = "doc_id long, text string, section int, spans array<struct<start:long,end:long>>"


def tokens(encoder, text):
    """(start, end) in bytes of every token, by decoding."""
    at, out = 0, []
    back = {v: k for k, v in encoder.ranks.items()}
    for i in encoder.ids(text).tolist():
        out.append((at, at + len(back[i])))
        at += len(back[i])
    assert at == len(text.encode())
    return out


def slow(encoder, text, spans, rule):
    edge = lambda c: len(text[:c].encode())
    spans = [(edge(s), edge(e)) for s, e in spans]
    n = [0] * len(spans)
    for a, b in tokens(encoder, text):
        if rule == "most":
            meet = [max(0, min(e, b) - max(s, a)) for s, e in spans]
            if any(meet):
                n[meet.index(max(meet))] += 1
        else:
            at = a if rule == "first" else b - 1
            for k, (s, e) in enumerate(spans):
                n[k] += s <= at < e
    return n


def lines(text):
    out, at = [], 0
    for x in (text or "").split("\n"):
        out.append((at, min(at + len(x) + 1, len(text or ""))))
        at += len(x) + 1
    return [x for x in out if x[1] > x[0]]


def test_lines(spark):
    encoder = tc.Encoder(tc.ranks_path())
    df = spark.createDataFrame([(i, t, 0, None) for i, t in TEXTS.items()] + [(5, TEXTS[5], 0, None), (None, "x", 0, None)], SCHEMA)
    got = {}
    for r in tc.token_counts(df).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.end_char, r.n_tokens))
    assert sorted(got.pop(5)) == [(0, 0, 8, 2)] * 2 and got.pop(None) == [(0, 0, 1, 1)]
    for i, t in TEXTS.items():
        if i != 5:
            spans = lines(t)
            counts = slow(encoder, t, spans, "first") if t else []
            assert sorted(got.get(i, [])) == [(k, s, e, n) for k, ((s, e), n) in enumerate(zip(spans, counts, strict=True))]
            assert sum(counts) == len(encoder.ids(t or ""))


@pytest.mark.parametrize("rule", tc.RULES)
def test_given_spans(spark, rule):
    rng, encoder = np.random.default_rng(6), tc.Encoder(tc.ranks_path())
    data = []
    for k in range(60):
        text = "".join(rng.choice(list("ab é日🙂,\n"), 40)) + "international understanding"
        cuts = np.sort(rng.choice(len(text) + 1, 8, replace=False)).tolist()
        data.append((k, text, [(cuts[j], cuts[j + 1]) for j in range(0, 7, int(rng.integers(1, 3)))]))
    df = spark.createDataFrame([(i, t, 0, [{"start": a, "end": b} for a, b in s]) for i, t, s in data] + [(99, "x", 0, None), (98, None, 0, [{"start": 0, "end": 3}])], SCHEMA)
    got = {}
    for r in tc.token_counts(df, spans_col="spans", rule=rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    assert got.pop(98) == {0: 0} and 99 not in got
    for i, t, s in data:
        assert [got[i][k] for k in range(len(s))] == slow(encoder, t, s, rule)


def test_empty(spark):
    assert tc.token_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        tc.token_counts(spark.createDataFrame([], SCHEMA), rule="half")
