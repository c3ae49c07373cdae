from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm import line_dedup, mixing, quality, sentencepiece_viterbi, simhash
from tests.llm.test_line_dedup import slow as slow_lines
from tests.llm.test_simhash import slow_components, slow_fingerprint


def test_every_stage_on_its_own_input(spark, sf_dir, tmp_path):
    """Each stage against brute force, or the operator that its own tests check."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    inputs = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, inputs[-1], sf_dir)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        inputs.append(spark.read.parquet(str(tmp_path / str(k))))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    verdict = quality.quality_rules(docs.select("doc_id", "text"), labels).filter("kept")
    assert Counter(r.doc_id for r in inputs[1].collect()) == Counter(r.doc_id for r in verdict.collect())
    rows = inputs[1].select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    want = slow_lines([(r.doc_id, r.text) for r in rows], {r.text: r.h for r in rows}, line_dedup.RUN, line_dedup.LONG_LINE)
    assert {r.doc_id: r.text for r in inputs[2].collect()} == {r.doc_id: t for r, t in zip(rows, want, strict=True)}
    fps = {r.doc_id: slow_fingerprint(r.text) for r in inputs[2].collect()}
    root = slow_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i, f in sorted(fps.items()):
        first.setdefault(root[f], i)
    assert sorted(r.doc_id for r in inputs[3].collect()) == sorted(first.values())
    copies = Counter({r.id: r.n_copies for r in mixing.copies(inputs[3]).collect() if r.n_copies})
    assert Counter(r.doc_id for r in inputs[4].collect()) == copies
    mixed = {r.doc_id: r.text for r in inputs[4].collect()}
    pieces = sentencepiece_viterbi.Pieces(sentencepiece_viterbi.model_path())
    assert all(pieces.decode(r.ids) == mixed[r.doc_id] and r.round_trip for r in inputs[5].collect())
    assert Counter(r.doc_id for r in entry.queries()["pipeline"](spark, sf_dir).collect()) == copies


def test_stages_survive_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    assert all(stage(spark, docs, sf_dir).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_all_ten_are_registered():
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names >= {f"op{n}" for n in range(1, 11)} and simhash
