"""The pipeline's stages, each against the operator's brute force or its definition."""

import corpus_pipeline
from ludometry.llm import contamination, pieces, queries, simhash
from ludometry.llm.base import table, written

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        made[name] = docs
        if name != "pieces":
            assert docs.columns == names
    language, lines, one, clean, last = made.values()
    assert language.count() >= 0.99 * table(spark, SF, "documents").count()
    assert lines.count() == language.count()
    assert lines.filter("n_chars <> length(text)").count() == 0
    groups = simhash.near_duplicates(lines)
    assert one.count() == groups.select("component_id").distinct().count()
    items = table(spark, SF, "benchmark")
    assert contamination.contained(clean, items).count() == 0
    dirty = contamination.contained(one, items).select("doc_id").distinct().count()
    assert clean.count() == one.count() - dirty
    vocabulary = pieces.Vocabulary.load(queries.PIECES)
    decoded = {row.doc_id: row.text for row in pieces.decode(last, vocabulary).collect()}
    assert decoded == {row.doc_id: row.text for row in clean.select("doc_id", "text").collect()}


def test_run_leaves_the_last_stage_only(spark):
    from ludometry.session import shared_folder
    from ludometry.sources.tables import folder_names

    before = set(folder_names(spark, shared_folder(spark)))
    made = corpus_pipeline.run(spark, SF)
    rows = made.count()
    left = set(folder_names(spark, shared_folder(spark))) - before
    assert len(left) == 1 and left.pop().startswith("benchmark-")
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "again")
    assert rows == docs.count() and made.columns == docs.columns


def test_run_is_registered(spark):
    import __spark_entry__ as entries

    assert entries.queries()["pipeline"] is corpus_pipeline.run
    assert len([name for name in entries.queries() if name.startswith("op")]) == 13


def test_benchmark_stage_judges_each_row_on_its_own_text(spark, tmp_path):
    passage = [f"word{k} stands" for k in range(40)]
    spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    dirty = [(None, " ".join(passage), 1), (9, "before " + " ".join(passage), 2)]
    clean = [
        (None, None, 3), (None, "a clean text without any item of it", 4), (9, "", 5), (9, "another clean text of seven words", 6),
        (8, " ".join(passage[:20]), 7), (8, " ".join(passage[20:]), 8),  # parts of an item, not the item
    ]
    docs = spark.createDataFrame(dirty + clean, "doc_id long, text string, _row int")
    left = dict(corpus_pipeline.STAGES)["benchmark"](spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted(row["_row"] for row in left.collect()) == [3, 4, 5, 6, 7, 8]
