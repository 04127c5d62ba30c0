import numpy as np
import pytest
from fixtures import bookings, rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from staylens import schemas
from staylens.ml import classify, cluster, evaluate, prep
from staylens.operators import cleaning, features, split
from staylens.plans import model_questions as Q
from staylens.plans.stays import bookings as stays


@pytest.fixture(scope="module")
def parts(spark, small):
    table = features.extract(cleaning.clean(stays(spark, small))).cache()
    # Reservations whose cancellation depends on the lead time, so there is something to learn.
    flag = (F.col("lead_time") > 200) | (F.col("deposit_type") == "Non Refund")
    table = table.withColumn("is_canceled", flag.cast("int"))
    train, test = split.stratified_split(table, "is_canceled")
    model = prep.fit(train)
    return prep.transform(model, train).cache(), prep.transform(model, test).cache(), model, table


def test_mapping_names_every_position(parts):
    train, _, _, _ = parts
    mapping = prep.feature_mapping(train).orderBy("feature_index").collect()
    size = len(train.first()["features"])
    assert [r["feature_index"] for r in mapping] == list(range(size))
    names = [r["feature_name"] for r in mapping]
    assert names[-11:] == schemas.NUMERIC + schemas.FLAGS
    assert names[0].startswith("hotel_vec_") and len(set(names)) == size


def test_unseen_category_is_all_zeros(spark, parts):
    _, _, model, table = parts
    odd = table.limit(1).withColumn("hotel", F.lit("Boat"))
    vector = model.transform(odd).first()["hotel_vec"]
    assert vector.numNonzeros() == 0 and vector.size == 2


def test_saved_pipeline_and_vectors_come_back(spark, parts, tmp_path):
    train, _, model, table = parts
    prep.save(model, str(tmp_path / "pipeline"))
    again = prep.transform(prep.load(str(tmp_path / "pipeline")), table.limit(50))
    assert rows(again) == rows(prep.transform(model, table.limit(50)))
    train.write.parquet(str(tmp_path / "vectors"))
    back = spark.read.parquet(str(tmp_path / "vectors"))
    assert rows(prep.feature_mapping(back)) == rows(prep.feature_mapping(train))
    assert back.columns == ["features", "label"]


def test_scaled_columns_have_mean_0_and_deviation_1(parts):
    train, _, model, table = parts
    scaled = np.array([r["features"].toArray()[-11:-2] for r in train.collect()])
    assert np.allclose(scaled.mean(axis=0), 0, atol=1e-9)
    deviations = scaled.std(axis=0, ddof=1)
    assert np.allclose(deviations[deviations > 0], 1)


def test_many_categories_are_fitted(spark):
    df = spark.range(120_000).select(F.col("id").cast("string").alias("c"), F.lit(1.0).alias("x"), F.lit(0).alias("t"))
    columns = prep.Columns(["c"], ["x"], [], "t")
    model = prep.fit(df, columns)
    assert len(model.stages[0].labelsArray[0]) == 120_000
    assert prep.transform(model, df.limit(3), columns).first()["features"].size == 120_001


@pytest.fixture(scope="module")
def predictions(parts):
    train, test, _, _ = parts
    model = classify.fit("lr", train)
    return model.transform(test).cache()


def test_metrics_agree_with_the_evaluators(predictions):
    row = evaluate.evaluate(evaluate.scored(predictions)).first()
    for name, column in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall"), ("f1", "f1")]:
        expected = MulticlassClassificationEvaluator(metricName=name).evaluate(predictions)
        assert row[column] == pytest.approx(expected, abs=1e-12)
    auc = BinaryClassificationEvaluator().evaluate(predictions)
    assert row["roc_auc"] == pytest.approx(auc, abs=1e-9)
    # The curve of probabilities against an evaluator that sees probabilities.
    scored = evaluate.scored(predictions).drop("raw")
    exact = evaluate.roc_auc(scored).first()["roc_auc"]
    assert exact == pytest.approx(evaluate.evaluate(scored).first()["roc_auc"], abs=1e-9)
    assert row["accuracy"] > 0.9


def test_confusion_counts_every_row(predictions):
    matrix = evaluate.confusion_matrix(evaluate.scored(predictions)).collect()
    assert sum(r["predicted_0"] + r["predicted_1"] for r in matrix) == predictions.count()
    assert [r["label"] for r in matrix] == [0.0, 1.0]


def test_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.2), (1.0, 0.0, 0.1)], "label double, prediction double, score double")
    expected = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert evaluate.metrics(df).first()["f1"] == pytest.approx(expected)
    assert evaluate.confusion_matrix(df).collect()[1]["predicted_1"] == 0


def test_roc_runs_from_none_to_all(predictions):
    points = evaluate.roc_points(evaluate.scored(predictions)).orderBy(F.desc_nulls_first("threshold")).collect()
    assert tuple(points[0]) == (None, 0.0, 0.0)
    assert (points[-1]["fpr"], points[-1]["tpr"]) == (1.0, 1.0)
    assert all(a["tpr"] <= b["tpr"] and a["fpr"] <= b["fpr"] for a, b in zip(points, points[1:]))


def test_auc_counts_ties_and_crowded_scores(spark):
    """Scores that differ in the last bits stay apart; a score that a third of the rows share counts half against itself."""
    rows = [(float(i % 2), 1 - i * 1e-15) for i in range(200)] + [(float(i % 3 == 0), 0.5) for i in range(150)] + [(1.0, 0.0), (0.0, 2.0), (1.0, -1.0)]
    df = spark.createDataFrame(rows, "label double, score double")
    ones, zeros = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros)
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(want, abs=1e-12)
    one_class = df.filter("label = 1")
    assert evaluate.roc_auc(one_class).first()["roc_auc"] is None


def test_trees_importance_and_saving(spark, parts, tmp_path):
    train, test, _, _ = parts
    model = classify.fit("gbt", train, maxIter=3)
    top = evaluate.feature_importance(model, prep.feature_mapping(train)).collect()
    assert len(top) == 20 and top[0]["feature_name"] == "lead_time"
    classify.save(model, str(tmp_path / "gbt"))
    again = classify.load_gbt(str(tmp_path / "gbt"))
    assert rows(again.transform(test), "prediction") == rows(model.transform(test), "prediction")
    forest = classify.fit("rf", train, numTrees=5, maxDepth=4)
    table = evaluate.compare({"a": evaluate.scored(model.transform(test)), "b": evaluate.scored(forest.transform(test))})
    assert [r["model"] for r in table.orderBy("model").collect()] == ["a", "b"]


def test_tuning_reports_every_setting(parts):
    train, _, _, _ = parts
    grid = {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]}
    model, report = classify.tune("lr", train, grid, maxIter=10)
    got = report.collect()
    assert len(got) == 4 and sum(r["best"] for r in got) == 1
    best = max(got, key=lambda r: r["roc_auc"])
    assert best["best"] and f"regParam={model.getRegParam()}" in best["settings"]
    assert set(classify.best_settings("lr", model)) == set(grid)
    again = classify.tune("lr", train, grid, maxIter=10)[1].collect()
    assert [r["best"] for r in again] == [r["best"] for r in got]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = [(Vectors.dense([10.0 * (i % 4) + rng.normal(), rng.normal(), 0.0]),) for i in range(400)]
    return spark.createDataFrame(rows, ["features"])


def test_cluster_sweep_finds_four(points):
    got = {r["k"]: r for r in cluster.sweep(points, range(2, 7)).collect()}
    assert max(got.values(), key=lambda r: r["silhouette"])["k"] == 4
    for k in range(3, 7):
        assert got[k]["training_cost"] < got[k - 1]["training_cost"] * 1.05


def test_cluster_sizes_centers_and_projection(spark, points):
    model = cluster.fit(points)
    assigned = model.transform(points)
    assert sum(r["count"] for r in cluster.sizes(assigned).collect()) == 400
    mapping = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "feature_index int, feature_name string")
    top = cluster.top_centroid_features(model, mapping, 1).collect()
    assert len(top) == 4 and sum(r["feature_name"] == "x" for r in top) >= 3
    flat = cluster.project(assigned)
    assert flat.columns == ["prediction", "PC1", "PC2"]
    spread = flat.agg(F.stddev("PC1").alias("a"), F.stddev("PC2").alias("b")).first()
    assert spread["a"] > spread["b"] > 0


def test_document_features_use_whole_texts(spark, small):
    got = Q.document_features(spark, small).select("doc_id", "n_chars", "n_digits")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for row in got.collect():
        assert row["n_digits"] == sum(c in "0123456789" for c in texts[row["doc_id"]])
        assert row["n_chars"] == len(texts[row["doc_id"]])


def test_fits_part_large_splits_and_keep_their_rows(spark, monkeypatch):
    from staylens import session

    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    rows = spark.range(0, 1000, 1, 2)
    assert session.spread(rows).rdd.getNumPartitions() == 10 and session.spread(rows.limit(50)).rdd.getNumPartitions() == 1
    assert session.spread(spark.range(0, 1000, 1, 20)).rdd.getNumPartitions() == 20
    assert sorted(r["id"] for r in session.spread(rows).collect()) == list(range(1000))


def test_stored_sides_are_those_of_the_split(spark, small):
    from staylens.operators import features, split
    from staylens.plans import booking_models
    from staylens.plans.booking_questions import cleaned
    from staylens.schemas import TARGET

    stored = booking_models.sides(spark, small)
    made = split.stratified_split(features.extract(cleaned(spark, small)), TARGET)
    for a, b in zip(stored, made):
        assert a.columns == b.columns
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) != []
