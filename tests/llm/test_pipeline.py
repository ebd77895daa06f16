import hashlib

import corpus_pipeline
import pytest
from postlake.llm import mixing, quality
from pyspark.sql import functions as F

from tests.llm.brute import fingerprint, near_groups, ranks_encoding


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality rules", "SimHash near-dedup", "mixing sources to target weights", "byte-level BPE encoding and decoding",
    ]


def test_run_equals_the_plain_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = [row for row in docs.collect() if any(c.isalpha() for c in row["text"] or "")]
    judged = {row["doc_id"] for row in docs.where(quality.first_rejection(F.col("text"), quality.RULES[::-1]).isNull()).collect()}
    left = sorted((row for row in left if row["doc_id"] in judged), key=lambda row: row["doc_id"])
    groups = near_groups([fingerprint(row["text"]) for row in left])
    left = [row for at, row in enumerate(left) if groups[at] == at]
    mixed = mixing.mix(spark.createDataFrame(left, docs.schema)).where("kept").collect()
    encoding = ranks_encoding()
    want = {row["doc_id"]: (encoding.encode_ordinary(row["text"]), hashlib.sha256(row["text"].encode()).hexdigest()) for row in mixed}
    got = {row["doc_id"]: (row["ids"], row["decoded_sha256"]) for row in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want and 20 < len(got) < len(left)


@pytest.mark.parametrize("rows", [None, []])
def test_stages_take_awkward_documents(spark, sf_dir, documents, rows):
    for name, stage in corpus_pipeline.STAGES:
        docs = documents(rows)
        out = stage(spark, docs, sf_dir)
        assert name.startswith("byte") or out.columns == docs.columns
        assert out.count() <= docs.count()


def test_filters_keep_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1"), "doc_id", "left_semi")
    good = clean.where((quality.n_words(F.col("text")) >= 50) & (quality.n_repeat_words(F.col("text")) * 2 <= quality.n_words(F.col("text"))))
    for _, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, docs, sf_dir)
        assert good.join(kept.select("doc_id"), "doc_id", "left_anti").isEmpty()


CLASHING = ["_id", "_hash", "_rejected_by", "_mix_topic", "_mix_n_tokens", "_mix_probability", "_mix_kept", "_row", "kept", "component", "fp", "row", "own"]


def test_stages_keep_columns_of_any_name(spark, sf_dir, documents):
    docs = documents().withColumns({name: F.concat(F.lit(f"{name} of "), F.coalesce(F.substring("text", 1, 3), F.lit("-"))) for name in CLASHING})
    plain = documents()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        want = stage(spark, plain, sf_dir)
        assert sorted(map(str, out.select(*plain.columns).collect())) == sorted(map(str, want.collect())), name
        own = out.where(F.exists(F.array(*(F.col(f"`{c}`") != F.concat(F.lit(f"{c} of "), F.coalesce(F.substring("text", 1, 3), F.lit("-"))) for c in CLASHING)), lambda x: x))
        assert own.isEmpty(), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
