import corpus_pipeline
from meterlake.llm import line_dedup, quality_rules, simhash, toxicity
from meterlake.llm.common import materialise, read_table


def test_stages_one_by_one(spark, sf):
    docs = read_table(spark, sf, "documents")
    columns, last = docs.columns, [n for n, _ in corpus_pipeline.STAGES][-1]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "line_dedup", "simhash_near_dedup", "packing"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialise(stage(spark, tables[-1], sf), "test-stage"))
        assert (tables[-1].columns == columns) == (name != last)
    start, clean, good, lines, single, packed = tables

    def ids(table):
        return {r.doc_id for r in table.select("doc_id").collect()}

    model = toxicity.train(start, read_table(spark, sf, "labels"))
    assert ids(clean) == {r.doc_id for r in toxicity.score(start, model).collect() if r.predicted == 0}
    toxic = {r.doc_id for r in read_table(spark, sf, "labels").collect() if r.toxic == 1}
    assert len(ids(clean) & toxic) <= 0.1 * len(toxic)
    assert ids(good) == {r.doc_id for r in quality_rules.quality(clean).collect() if r.kept}
    assert ids(lines) == ids(good)
    again = line_dedup.line_classes(lines).collect()
    assert all(r.kept for r in again)  # nothing is left to take out
    groups = simhash.near_duplicates(lines).collect()
    assert ids(single) == {r.doc_id for r in groups if r.doc_id == r.component_id}
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids(single)


def test_run_gives_the_packed_batches(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and all(0 <= r.padding < r.bucket_len for r in rows)
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)


def test_odd_rows_and_clashing_columns_go_through(spark, sf, odd):
    """Columns named like the operators' results keep their values and types; nulls,
    repeats and long texts are decided like other rows."""
    from pyspark.sql import functions as F

    good = read_table(spark, sf, "documents").limit(40)
    clash = [c for c in odd.columns if c not in good.columns] + ["n_words", "char_distance", "base_failed", "others"]
    for name in clash:
        good = good.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
        if name not in odd.columns:
            odd = odd.withColumn(name, F.lit("clash"))
    docs = materialise(good.unionByName(odd), "test-odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, sf), "test-stage")
        assert out.dtypes == docs.dtypes, name
        rows = out.select("doc_id", *clash).collect()
        assert all(r[c] in ("clash", f"{c}{r.doc_id}") for r in rows for c in clash)
        docs = out
    assert docs.count() > 0 and docs.filter("text is null").count() == 0
    assert corpus_pipeline.packing_stage(spark, docs, sf).count() > 0


def test_an_empty_table_goes_through(spark, sf, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf), "test-empty")
        assert docs.count() == 0 and docs.dtypes == empty.dtypes
    assert corpus_pipeline.packing_stage(spark, docs, sf).count() == 0
