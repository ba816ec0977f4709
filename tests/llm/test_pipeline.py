"""The pipeline's stages on small tables, against the operators' brute-force meaning."""

from pyspark.sql import functions as F

import corpus_pipeline
from placewise.llm import decontaminate, mixing, quality, simhash
from tests.conftest import SF_DIR
from tests.llm.test_operators import brute_components, brute_fingerprint, brute_hits


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    columns, kept = docs.columns, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if number + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns
        out.write.parquet(path := f"{tmp_path}/{number}")
        docs = spark.read.parquet(path)
        kept[name] = {r[0] for r in docs.select("doc_id").collect()}
    texts = {r[0]: r for r in rows}
    good = sorted(kept["quality rules"])
    prints = [brute_fingerprint(texts[d][1]) for d in good]
    firsts = {}
    for d, root in zip(good, brute_components(prints, 4)):
        firsts[root] = min(d, firsts.get(root, d))
    assert kept["simhash near-dedup"] == set(firsts.values())
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {key[0] for key in brute_hits([texts[d] for d in sorted(kept["simhash near-dedup"])], items, 10) if not key[2]}
    assert kept["benchmark decontamination"] == clean
    assert kept["source mixing"] <= clean and len(kept["source mixing"]) > 0.5 * len(clean)
    assert kept["token output"] == kept["source mixing"]


def test_stages_on_odd_rows_and_empty_tables(spark, odd, none):
    """Each stage on nulls, ties, repeated rows and clashing columns keeps what its operator says."""
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    expected = {"quality rules": quality.judge(odd).where("kept").count(),
                "simhash near-dedup": simhash.near_duplicates(odd).select("component_id").distinct().count(),
                "benchmark decontamination": decontaminate.contamination(odd, items).where("n_hit = 0").count(),
                "source mixing": mixing.mix(odd).agg(F.sum("copies")).first()[0], "token output": odd.count()}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF_DIR).count() == expected[name]
        assert stage(spark, none, SF_DIR).count() == 0


def test_mixing_stage_draws_as_the_operator(spark, odd):
    drawn = corpus_pipeline.STAGES[3][1](spark, odd, SF_DIR)
    assert drawn.columns == odd.columns and drawn.count() == mixing.mix(odd).agg(F.sum("copies")).first()[0]


def test_drawn_tokens_meet_the_targets(spark):
    """Token shares of what the stage writes, within one per cent of all tokens of every target."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    drawn = corpus_pipeline.STAGES[3][1](spark, docs, SF_DIR)
    before, after = mixing.described(docs), mixing.described(drawn)
    for margin in mixing.MARGINS:
        target = {r[0]: r[1] for r in mixing.powered_targets(before, margin, mixing.POWERS[margin]).collect()}
        got = {r[0]: r[1] for r in after.groupBy(margin).agg(F.sum("tokens")).collect()}
        assert max(abs(got.get(v, 0) / sum(got.values()) - share) for v, share in target.items()) < 0.01
