import corpus_pipeline


def test_texts_in_a_script_that_no_label_taught_go(spark):
    rows = [(i, f"the sun and the moon {i}", "en", "s", 20) for i in range(40)]
    rows += [(100, "ภาษาไทย สวัสดี", None, "s", 14), (101, "ภาษา the", None, "s", 8), (102, "123", None, "s", 3), (103, "zzz tune", None, "s", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, "").collect()}
    assert kept == {*range(40), 101, 103}
