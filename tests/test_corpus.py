from pyspark.sql import functions as F

from chunkloom.sources import corpus


def test_chunks_carry_the_metadata_of_their_root(spark, tmp_path):
    """Also where ids are negative, null or come twice, and texts are shuffled by their own id only."""
    ids = [-21, -20, -11, -7, -1, 0, 0, 1, 9, 10, 15, 20, 20, 23, 23, 39, None]
    rows = [(n, f"text {i}", f"l{i}", f"s{i}", i) for i, n in enumerate(ids)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    embedded = [(n, [1.0, float(i)], i) for i, n in enumerate([0, 15, 16, 23, -7, 44])]
    spark.createDataFrame(embedded, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    labels = spark.createDataFrame([(15, 1, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    chunks = corpus.chunks(spark, str(tmp_path))
    found = sorted((str(r["chunk_id"]), str(r["content"]), str(r["l"])) for r in chunks.select("chunk_id", "content", F.col("document_metadata.language").alias("l")).collect())
    root_of = lambda n: n - (abs(n) % 10) * (1 if n > 0 else -1)
    stored = [(r[0], r[1]) for r in rows] + [(n, None) for n in (16, 44)]
    wanted = []
    for n, text in stored:
        roots = [r[2] for r in rows if n is not None and r[0] == root_of(n)] or [None]
        wanted += [(str(n), str(text), str(md)) for md in roots]
    assert found == sorted(wanted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = corpus.chunks(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # of each table, and of the ids that either of two tables holds; none by the id of the root
    assert plan.count("Exchange hashpartitioning") == 5


def test_chunks_of_a_tenant_are_made_from_its_rows_alone(spark, tmp_path):
    """The same rows as picked from all chunks, and no text of another tenant is shuffled."""
    ids = [*range(-31, 64), 7, 7, 30, None, None]
    rows = [(n, f"text {i}", f"l{i}", f"s{i}", i) for i, n in enumerate(ids)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    embedded = [(n, [1.0, float(i)], i) for i, n in enumerate([0, 15, 16, 16, 30, -7, 70, 85, None])]
    spark.createDataFrame(embedded, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    graded = [(15, 1, 0), (15, 2, 0), (30, None, 1), (-7, 0, 0), (70, 1, 1), (None, 1, 1), (7, 4, 0)]
    spark.createDataFrame(graded, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    turns = [(c, t, f"turn {t}") for c in (*range(7), None) for t in (0, 1, None)]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    folder = str(tmp_path)

    def values(frame):
        return sorted(r[0] for r in frame.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect())

    batch = corpus.upsert_batch(spark, folder).where("chunk_id NOT LIKE 'talk_%'")
    every = corpus.chunks(spark, folder)
    assert values(batch.select("chunk_id", "custom_properties")) == values(
        every.where("custom_properties.quality IS NOT NULL").select("chunk_id", "custom_properties")
    )
    for tenant in ("tenant_0", "tenant_1", "tenant_2", "tenant_-1"):
        mine = F.col("tenant") == tenant
        assert values(corpus.chunks(spark, folder, tenant)) == values(every.where(mine))
        assert values(corpus.upsert_batch(spark, folder, tenant)) == values(corpus.upsert_batch(spark, folder).where(mine))
        sized = lambda d: d.select("filename", "document_metadata", F.size("chunks").alias("n"))
        assert values(sized(corpus.documents(spark, folder, tenant))) == values(sized(corpus.documents(spark, folder).where(mine)))
