import corpus_pipeline as cp

PASSAGE = "seven grey wolves watch the quick brown fox jump over a lazy dog near cold water under old trees"


def test_stages_and_run(spark, tmp_path):
    body = [" ".join(f"w{d}x{i}" for i in range(120)) for d in range(40)]
    rows = [(d, f"{body[d]}\nan idiot speaks" if d % 5 == 0 else body[d], "en", "s", 0) for d in range(30)]
    rows += [(40, body[31], "en", "s", 0), (41, body[31].replace("w31x60", "changed").replace("w31x61", "again"), "en", "s", 0), (42, body[32] + "\n" + PASSAGE, "en", "s", 0)]
    rows += [(43, body[1], "en", "s", 0), (44, "new text here\n" + body[2], "en", "s", 0), (45, None, "en", "s", None), (46, "", "en", "s", 0), (47, body[33], "en", "s", 0), (47, body[33], "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1, int(d % 5 == 0)) for d in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        ids.append(sorted(r.doc_id for r in docs.collect()))
    toxic = {d for d in range(30) if d % 5 == 0}
    start = [r[0] for r in rows if r[0] not in toxic]
    assert ids[0] == sorted(start)
    assert ids[1] == sorted(i for i in start if i != 43)  # all its lines stand before
    assert {r.doc_id: r.text for r in docs.collect()}[44] == "new text here"
    assert ids[2] == sorted([i for i in start if i not in (41, 43, 47)] + [47])
    assert ids[3] == [i for i in ids[2] if i != 42]
    got = cp.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == ids[3] and all(r.restored for r in got)


def test_clashing_names_and_odd_rows(spark):
    """Columns of any name come back as they were; null and empty texts, a null doc_id and repeated rows stay in line dedup."""
    rows = [(1, "one line\ntwo", 7), (2, "one line\nthree", 7), (3, None, None), (4, "", 0), (None, "four", 4), (None, "four", 4), (5, "one line", 8)]
    schema = "doc_id long, text string, n_chars long"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'own' AS n_lines", "'own' AS removed_lines", "'own' AS h", "'own' AS lines", "'own' AS text_hash", "'own' AS rank")
    got = cp.line_dedup_stage(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, "one line\ntwo", 7), (2, "three", 5), (3, None, None), (4, "", 0), (None, "four", 4), (None, "four", 4)]
    assert sorted(map(str, got.select("doc_id", "text", "n_chars").collect())) == sorted(map(str, spark.createDataFrame(want, schema).collect()))
    assert {tuple(r) for r in got.drop("doc_id", "text", "n_chars").collect()} == {("own",) * 6}
    one = cp.ngram_join_stage(spark, docs, "")
    assert one.columns == docs.columns and sorted(str(r.doc_id) for r in one.collect()) == ["1", "2", "3", "4", "5", "None"]
