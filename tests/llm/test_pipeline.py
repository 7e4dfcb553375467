import corpus_pipeline
from candlewick.llm.queries import ORACLES, QUERIES


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns, name
        n = docs.count()
        assert (n <= before) if name != "mixing" else (n <= 3 * before)
        if name == "language":
            assert n >= 0.98 * before
        if name == "near_duplicates":
            assert docs.select("text").distinct().count() == n
        if name == "decontamination":
            assert not any(b in " ".join(r.text.split()) for r in docs.collect() for b in bench)
        before = n
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == before


def test_odd_documents(spark, sf_dir, make_docs, odd_docs):
    for rows in (odd_docs, []):
        docs = make_docs(rows)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_registered():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{i}" for i in range(1, 11)} and set(ORACLES) <= set(QUERIES)


def test_queries_with_sql_agree(spark, sf_dir):
    import duckdb

    import verify

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name, sql in ORACLES.items():
        assert ": ok" in (said := verify.compare(spark, con, sf_dir, name, QUERIES[name], sql)), said
