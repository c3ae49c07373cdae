import math
import random

import pytest

from tessera.llm import sentencepiece_viterbi as sv

SCHEMA = "doc_id long, text string, ids string, n_tokens int"
TEXTS = [None, "", " ", "  two  spaces ", "one", "Hello world, hello words!", "naïve café 日本語 🙂 \x00\x07", "tabs\tand\nlines\r\n", "aaaaaaaaaaaaaaaaaaaaaaaa",
         "!!!---===###", "antidisestablishmentarianism " * 300, "x" * 50_000, "    indented\n        more"]


def test_against_the_library(spark, sf_dir):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=sv.model_path())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    data = [(r.doc_id, r.text) for r in docs] + [(10_000 + i, t) for i, t in enumerate(TEXTS)] + [(10_005, TEXTS[5]), (None, "no id")]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in data], SCHEMA)
    encoded = sv.encode(df)
    got = sorted((str(r.doc_id), r.ids, r.n_tokens, r.round_trip) for r in encoded.collect())
    ids = [None if t is None else lib.encode(t) for _, t in data]
    assert got == sorted((str(i), x, len(x or ()), None if t is None else True) for (i, t), x in zip(data, ids, strict=True))
    back = {r.doc_id: r.text for r in sv.decode(encoded).collect()}
    assert all(back[i] == t for i, t in data if i != 10_005)


def test_mark_in_the_text_becomes_a_space(spark):
    row = sv.encode(spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")).first()
    assert row.round_trip is False and sv.Pieces(sv.model_path()).decode(row.ids) == "a b"


def test_unigram_against_all_segmentations():
    rng = random.Random(4)
    scores = {w: math.log(rng.random()) for w in ["▁", "a", "b", "c", "▁a", "ab", "bc", "abc", "▁ab", "ca", "cab", "▁b"]}
    pieces = sv.Pieces.of(scores, "unigram")

    def best(word):
        if not word:
            return 0.0
        return max(scores[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in scores)

    words = sorted({"▁" + "".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(300)})
    for word, found in zip(words, pieces.segment(words), strict=True):
        assert "".join(found) == word
        assert sum(scores[p] for p in found) == pytest.approx(best(word))
    assert list(pieces.segment(["▁xa"])) == [["▁", "x", "a"]]
    names = [pieces.names[i] for i in pieces.encode(["abcab cab"])[0]]
    assert sum(scores[p] for p in names) == pytest.approx(best("▁abcab") + best("▁cab"))


def test_small_cache_gives_the_same(monkeypatch):
    pieces = sv.Pieces(sv.model_path())
    texts = [f"word{i} other{i % 7} again" for i in range(300)]
    want = [x.tolist() for x in pieces.encode(texts)]
    monkeypatch.setattr(sv, "CACHE", 50)
    assert [x.tolist() for x in sv.Pieces(sv.model_path()).encode(texts)] == want


def test_vocabularies_with_other_scores_share_nothing(monkeypatch):
    monkeypatch.setattr(sv, "_WARM", {})
    names = ["▁", "▁a", "a", "b", "ab", "▁ab"]
    one = sv.Pieces.of(dict.fromkeys(names, -1.0), "unigram").warm()
    assert [one.names[i] for i in one.encode(["ab"])[0]] == ["▁ab"]
    two = sv.Pieces.of({**dict.fromkeys(names, -1.0), "▁ab": -9.0}, "unigram").warm()
    assert [two.names[i] for i in two.encode(["ab"])[0]] != ["▁ab"] and two is not one
    assert sv.Pieces.of(dict.fromkeys(names, -1.0), "unigram").warm() is one
    assert sv.Pieces.of(dict.fromkeys(names, -1.0), "bpe").warm() is not one


def test_decode_keeps_a_text_column_apart(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in sv.decode(rows).collect()} == {1: None, 2: ""}
    with pytest.raises(ValueError):
        sv.decode(rows.selectExpr("*", "'x' AS text"))


def test_empty(spark):
    assert sv.encode(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        sv.Pieces(sv.model_path(), "wordpiece")


def test_texts_are_encoded_in_runs_of_bounded_size(spark, monkeypatch):
    import pyarrow as pa

    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    monkeypatch.setattr(type(df), "withColumnRenamed", lambda self, a, b: self, raising=False)
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: type("Held", (), {"f": staticmethod(f), "withColumnRenamed": lambda s, a, b: s})(), raising=False)
    work = sv.encode(df).f
    texts = [f"word {i} and more " * 12_000 for i in range(40)]
    out = list(work(iter([pa.record_batch({"id": pa.array(range(40), pa.int64()), "text": pa.array(texts)})])))
    assert sum(len(b) for b in out) == 40 and max(b.nbytes for b in out) < 6_000_000
    assert all(x for b in out for x in b.column(3).to_pylist())


def test_words_in_use_outlast_a_full_cache(monkeypatch):
    monkeypatch.setattr(sv, "CACHE", 60)
    pieces, seen = sv.Pieces(sv.model_path()), []
    segment = pieces.segment
    monkeypatch.setattr(pieces, "segment", lambda words: seen.extend(words) or segment(words))
    usual = " ".join(f"usual{i}" for i in range(20))
    for i in range(30):
        pieces.encode([usual + "".join(f" rare{i}x{j}" for j in range(10))])
    assert len(seen) == len(set(seen)) == 20 + 30 * 10  # each word is walked once, however often the cache was full
    assert len(pieces.known) <= 60 and len(pieces.older) <= 60
