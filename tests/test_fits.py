import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from staylens import session
from staylens.ml import classify, cluster
from staylens.plans import model_facts, model_questions

GRID = {"maxDepth": [1, 2], "numTrees": [2, 3]}


@pytest.fixture(scope="module")
def train(spark):
    rows = [(float((i * 7 % 11) + (i % 3) > 6 or i % 13 == 0), Vectors.dense([i * 7 % 11, i % 3, i * 31 % 17])) for i in range(400)]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(3).cache()


def _sizes(df):
    return sorted(df.groupBy(F.spark_partition_id()).count().toPandas()["count"])


def test_rows_are_dealt_one_task_a_core(spark, monkeypatch):
    monkeypatch.setattr(session, "LEAST_ROWS_PER_TASK", 10)
    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(0, 800, 1, 40).filter("id < 400")  # half of the 40 splits have no rows
    assert session.dealt(uneven).rdd.getNumPartitions() == cores
    assert _sizes(session.dealt(uneven)) == pytest.approx([400 / cores] * cores, abs=cores)
    assert sorted(r["id"] for r in session.dealt(uneven).collect()) == list(range(400))
    assert session.dealt(spark.range(15)).rdd.getNumPartitions() == 1 == session.dealt(spark.range(0)).rdd.getNumPartitions()
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    assert session.dealt(uneven).rdd.getNumPartitions() == 40


def test_rows_have_one_order_in_their_task(train, monkeypatch):
    """A draw by place would differ from run to run otherwise."""
    monkeypatch.setattr(session, "LEAST_ROWS_PER_TASK", 100)
    fresh = train.select("label", "features").repartition(7)
    for part in session.dealt(fresh).rdd.glom().collect():
        assert len(part) > 50 and [r["label"] for r in part] == sorted(r["label"] for r in part)
        zeros = [list(r["features"].toArray()) for r in part if r["label"] == 0]
        assert zeros == sorted(zeros)


def test_kept_rows_are_not_dealt_again(train):
    assert session.dealt(train) is train


def test_scores_are_those_of_sparks_own_split(train):
    base = classify.estimator("rf")
    maps = ParamGridBuilder().addGrid(base.maxDepth, GRID["maxDepth"]).addGrid(base.numTrees, GRID["numTrees"]).build()
    own = TrainValidationSplit(estimator=base, estimatorParamMaps=maps, evaluator=BinaryClassificationEvaluator(), trainRatio=0.8, seed=42).fit(train)
    model, report = classify.tune("rf", train, GRID)
    assert [r["roc_auc"] for r in report.collect()] == own.validationMetrics
    assert [t.toDebugString.split("\n")[1:] for t in model.trees] == [t.toDebugString.split("\n")[1:] for t in own.bestModel.trees]


def test_a_report_alone_fits_its_grid_only(train, monkeypatch):
    fits = []
    kind = classify._CLASSES["rf"]
    fit = kind._fit
    monkeypatch.setattr(kind, "_fit", lambda self, rows: fits.append(1) or fit(self, rows))
    with_model = classify.tune("rf", train, GRID)
    assert len(fits) == 5 and with_model[0].getNumTrees in GRID["numTrees"]
    model, report = classify.tune("rf", train, GRID, refit=False)
    assert len(fits) == 9 and model is None
    assert report.collect() == with_model[1].collect()


def test_kinds_side_by_side_are_the_same_models(train):
    few = {"lr": {}, "rf": {"numTrees": 3}, "gbt": {"maxIter": 2}}
    models = classify.every_kind(lambda kind, rows: classify.fit(kind, rows, **few[kind]), train)
    assert list(models) == list(classify.NAMES)
    for kind, model in models.items():
        alone = classify.fit(kind, train, **few[kind])
        pick = ["prediction", "probability"]
        assert model.transform(train).select(pick).collect() == alone.transform(train).select(pick).collect()


def test_a_failed_fit_is_not_lost(train):
    def work(kind, rows):
        if kind == "rf":
            raise ValueError("no forest")

    with pytest.raises(ValueError, match="no forest"):
        classify.every_kind(work, train)


def test_rows_of_a_compact_file_are_dealt_by_key(spark, monkeypatch):
    monkeypatch.setattr(session, "LEAST_ROWS_PER_TASK", 10)
    cores = spark.sparkContext.defaultParallelism
    compact = spark.range(0, 40_000, 1, 40).filter("id < 2000")  # two of the 40 splits hold all rows
    got = session.dealt_by(compact, "id")
    assert len(_sizes(got)) > 2 * cores and max(_sizes(got)) < 2000 / cores
    assert sorted(r["id"] for r in got.collect()) == list(range(2000))
    even = spark.range(0, 1000, 1, 40)
    assert session.dealt_by(even, "id") is even
    few, none = spark.range(0, 19, 1, 1), spark.range(0)
    assert session.dealt_by(few, "id") is few and session.dealt_by(none, "id") is none


def test_texts_of_a_compact_file_are_measured_by_many_tasks(spark, small, tmp_path, monkeypatch):
    for name, more in (("documents", [(None, "no 1 id", "en", "s", 7)]), ("labels", [])):
        rows = spark.read.parquet(f"{small}/{name}.parquet")
        rows.unionByName(spark.createDataFrame(more, rows.schema)).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    whole = model_questions.document_features(spark, str(tmp_path))
    one = whole.collect()
    monkeypatch.setattr(session, "LEAST_ROWS_PER_TASK", 10)
    assert len(_sizes(whole)) == 1
    dealt = model_questions.document_features(spark, str(tmp_path))
    assert len(_sizes(dealt)) > 8
    assert sorted(dealt.collect()) == sorted(one) and len(one) == spark.read.parquet(f"{small}/labels.parquet").count()


def test_facts_of_all_kinds_deal_their_rows_once(spark, train, monkeypatch):
    dealt, kept = session.dealt, []
    for place in (classify, model_facts):
        monkeypatch.setattr(place, "dealt", lambda df: kept.append(df.is_cached) or dealt(df), raising=False)
    rows = train.select("features", "label")
    got = model_facts._path_facts(spark, rows, rows, {"lr": {}, "rf": {"numTrees": 2}, "gbt": {"maxIter": 1}})
    values = {(r["subject"], r["fact"]): r["value"] for r in got.collect()}
    assert kept == [False, True, True, True]
    assert {values[name, "confusion_total"] for name in classify.NAMES.values()} == {400}
    assert {values[name, "reloaded_differ"] for name in classify.NAMES.values()} == {0}


def test_a_sweep_uses_rows_that_are_kept(train, monkeypatch):
    rows = train.select("features").cache()
    spread, asked = cluster.spread, []
    monkeypatch.setattr(cluster, "spread", lambda df: asked.append(1) or spread(df))
    swept = cluster.sweep(rows, [2, 3])
    assert not asked and rows.is_cached
    rows.unpersist()
    again = cluster.sweep(rows, [2, 3])
    assert asked and [r["k"] for r in swept.collect()] == [2, 3]
    assert [r["training_cost"] for r in swept.collect()] == pytest.approx([r["training_cost"] for r in again.collect()])
