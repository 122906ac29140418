"""The pipeline's stages one after another, against what each operator says of its own input."""

from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import mixing, pii, quality_rules, simhash
from quern.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_hand_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "mix_sources", "sentencepiece"]
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    given, outs = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, given, SF), name)
        if name != "sentencepiece":
            assert out.dtypes == docs.dtypes
        outs.append(out)
        given = out
    rules, near, clean, mixed, pieces = outs
    assert ids(rules) == ids(quality_rules.quality_rules(docs).filter("kept"))
    groups = simhash.simhash_groups(rules)
    assert ids(near) == sorted({r["component_id"] for r in groups.select("component_id").collect()})
    assert ids(clean) == ids(near)
    assert all(not any(k < 4 for _, k, _, _ in pii.spans_of(r["text"])) for r in clean.collect())
    want = sorted(i for r in mixing.mix_sources(clean).collect() for i in [r["doc_id"]] * r["copies"])
    assert ids(mixed) == want == ids(pieces)


def test_stages_of_odd_rows_with_clashing_columns(spark):
    words = " ".join(f"word{i} other{i * 7}" for i in range(60))
    rows = [(1, words, "en", "s", 9), (1, words, "en", "s", 9), (None, words + " more here", None, None, None), (3, None, None, "s", None), (4, "", "en", None, 0),
            (5, " ".join(f"x{i}" for i in range(90_000)), "en", "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in ("kept", "size", "copies", "fingerprint", "n_words", "spans", "ids", "shard", "pii_spans")}
    given = written(df.withColumns(extra), "odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, given, SF), name)
        assert out.dtypes == given.dtypes
        assert all(r["kept"] == f"kept{'-' if r['doc_id'] is None else r['doc_id']}" for r in out.collect())
        given = out
    assert corpus_pipeline.STAGES[-1][1](spark, given, SF).count() == given.count() > 0


def test_run_equals_its_stages_and_takes_an_empty_table(spark):
    from quern.session import scratch_dir

    assert corpus_pipeline.run(spark, SF).count() > 0
    folder = scratch_dir(spark, "empty")
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
