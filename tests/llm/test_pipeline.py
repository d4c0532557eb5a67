import corpus_pipeline
from pyspark.sql import functions as F

from aerolith.llm import decontaminate, secrets
from aerolith.llm.tokens import VOCABULARY, WordEncoder
from test_decontaminate import brute as brute_leaks
from test_secrets import brute_base
from test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, documents):
    docs, columns = documents, documents.columns
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, SF)
    assert kept.columns == columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}

    docs = kept.cache()
    kept = stages["simhash_near_dedup"](spark, docs, SF)
    assert kept.columns == columns
    pairs = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_components(pairs)})

    docs = kept.cache()
    kept = stages["benchmark_decontamination"](spark, docs, SF)
    assert kept.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_leaks([(r.doc_id, r.text) for r in docs.collect()], items)}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - leaks

    docs = kept.cache()
    kept = stages["secret_scan"](spark, docs, SF)
    assert kept.columns == columns
    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (docs, kept))
    assert before.keys() == after.keys()
    for doc_id, text in before.items():
        assert not brute_base(after[doc_id])
        assert brute_base(text) or text == after[doc_id]

    packed = stages["best_fit_packing"](spark, kept, SF).collect()
    encoder = WordEncoder(VOCABULARY)
    assert sum(r.length for r in packed) == sum(len(encoder.encode(t)) // 4 + 1 for t in after.values())
    assert {r.doc_id for r in packed} == set(after)


def test_run_gives_the_last_stage_s_rows(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 50


def test_stages_on_odd_rows_and_nothing(spark, made, nothing):
    model_of_secrets = secrets.fit(nothing)
    assert model_of_secrets.ratio(b"the_name_of_a_function") < model_of_secrets.threshold
    assert decontaminate.words_of(None) == []
    for df in (made, nothing):
        docs = df.withColumn("lang", F.when(F.col("doc_id") < 3, "en").otherwise("de"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns
            docs = kept.cache()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_no_stage_loses_clean_rows_of_null_or_repeated_ids(spark):
    """Leaks and clean texts under one id, and under no id: only the leaks go, and no other row."""
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(3).collect()]
    clean = [f"clean text number {w} about rivers, hills and towns of the north" for w in ("one", "two", "three")]
    rows = [(None, items[0]), (None, clean[0]), (7, items[1]), (7, clean[1]), (8, clean[2]), (9, None), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "web", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    kept = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, docs, SF)
    assert kept.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert left == sorted(((d, t) for d, t in rows if t not in items), key=str)
    secrets_kept = dict(corpus_pipeline.STAGES)["secret_scan"](spark, docs, SF)
    assert sorted(((r.doc_id, r.text) for r in secrets_kept.collect()), key=str) == sorted(rows, key=str)
    packed = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, docs, SF).collect()
    assert sorted((str(r.doc_id) for r in packed)) == sorted(str(d) for d, _ in rows)
