import awkward
import numpy as np
import public_tokenizers
import pytest
from test_minmax import brute
from test_tiling import ITEM

import __spark_entry__ as entry_points
import corpus_pipeline
from tickspan.llm import bpe, toxicity
from tickspan.llm.frames import fold
from tickspan.llm.queries import QUERIES, SQL, VOCABULARY
from tickspan.session import as_table


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark, data):
    """What each stage was given and returned."""
    docs, out = awkward.table(spark, data), []
    for name, stage in corpus_pipeline.STAGES:
        after = as_table(stage(spark, docs, data), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(stages, spark, data):
    columns = awkward.table(spark, data).columns
    for _, _, after in stages[:-1]:
        assert after.columns == columns


def test_each_stage_decides(stages, spark, data):
    by_name = {name: (before, after) for name, before, after in stages}
    before, after = by_name["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in awkward.table(spark, data, "labels").collect()}
    gone = ids(before) - ids(after)
    assert sum(labels.get(i) == 1 for i in gone) > 15
    assert sum(labels.get(i) == 0 for i in gone) <= 2
    before, after = by_name["near_duplicates"]
    component, _ = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5)
    assert ids(after) == {i for i, c in component.items() if i == c}
    before, after = by_name["decontamination"]
    items = [r["text"] for r in awkward.table(spark, data, "benchmark").collect()]
    planted = {r["doc_id"] for r in before.collect() if any(i in r["text"] for i in items)}
    assert planted and not planted & ids(after)


def test_run_is_the_stages_in_a_row(stages, spark, data):
    wanted = sorted(tuple(r) for r in stages[-1][2].collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, data).collect()) == wanted
    last = stages[-1][1]
    direct = bpe.encoded_documents(last, public_tokenizers.path(VOCABULARY))
    assert sorted(tuple(r) for r in direct.collect()) == wanted


def test_awkward_tables(spark, data, tmp_path):
    docs = awkward.documents(spark).unionByName(
        awkward.documents(spark, [(20, f"it says {ITEM} here", "en"), (21, "a clean text of its own", "en")])
    )
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert {1, 5, 7, 21} <= kept and not kept & {2, 3, 4, 6, 8, 20}
    empty = str(tmp_path / "empty")
    for name in ("documents", "benchmark", "labels"):
        awkward.table(spark, folder, name).limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_labels_of_the_held_out_are_not_learned(spark, data):
    labels = awkward.table(spark, data, "labels").filter(fold("doc_id", 4) != 2)
    index = toxicity.train(awkward.table(spark, data), labels)
    kept = {r["doc_id"] for r in labels.collect()}
    assert set(index.ids.tolist()) <= kept


def test_toxicity_stage_drops_what_the_operator_predicts(spark, data, monkeypatch):
    docs = awkward.table(spark, data).limit(20)
    for score, kept in ((0.29, 20), (0.3, 0), (0.4, 0)):
        index = toxicity.build(np.arange(0), [], np.arange(0), np.zeros(0))
        index.without = score
        monkeypatch.setattr(toxicity, "train", lambda *_, index=index: index)
        assert corpus_pipeline.toxic(spark, docs, data).count() == kept
