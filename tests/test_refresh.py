from pyspark.sql import functions as F

from codeledger.plans import derived
from codeledger.plans.refresh import IncrementalTable, input_states
from codeledger.sinks.tables import DerivedTable

from helpers import rows


def built(inputs):
    totals = inputs["b"].groupBy("repo_id").agg(F.sum("n").alias("n"))
    return inputs["a"].join(totals, "repo_id", "left")


def test_only_changed_keys_are_recomputed(spark, tmp_path):
    a = spark.createDataFrame([(f"r{i}", i) for i in range(20)], "repo_id string, v int")
    b = spark.createDataFrame([(f"r{i % 20}", i) for i in range(60)] + [(None, 7)], "repo_id string, n int")
    table = IncrementalTable(DerivedTable(spark, str(tmp_path / "t")), built)
    assert table.refresh({"a": a, "b": b}) == 20
    assert table.refresh({"a": a.repartition(3), "b": b.orderBy(F.desc("n"))}) == 0  # another order is no change
    changed = {"a": a.where("repo_id <> 'r3'"), "b": b.withColumn("n", F.when(F.col("n") == 5, 500).otherwise(F.col("n")))}
    changed["b"] = changed["b"].union(spark.createDataFrame([("r7", 27), ("new", 1)], "repo_id string, n int"))
    changed["a"] = changed["a"].union(spark.createDataFrame([("new", 9)], "repo_id string, v int"))
    # r5 has another value, r7 a row twice, new is new; r3 lost its row in a and is computed to nothing
    assert table.refresh(changed) == 4
    assert rows(table.read()) == rows(built(changed))
    assert sorted(r.repo_id for r in table.read(with_refresh=True).where("_refresh = 2").collect()) == ["new", "r5", "r7"]
    empty = {name: df.limit(0) for name, df in changed.items()}
    assert table.refresh(empty) == 0 and table.read().count() == 0
    assert table.refresh({"a": a, "b": b}) == 20 and rows(table.read()) == rows(built({"a": a, "b": b}))


def test_states_tell_inputs_apart(spark):
    one = spark.createDataFrame([("r", 1)], "repo_id string, v int")
    two = spark.createDataFrame([("r", 2)], "repo_id string, v int")
    states = [input_states(i).first()[1] for i in ({"a": one, "b": two}, {"a": two, "b": one}, {"a": one}, {"a": one.union(one)})]
    assert len(set(states)) == 4


def test_combined_metrics_follow_their_inputs(spark, tmp_path):
    inventory = spark.createDataFrame([("a", "h"), ("b", "h")], "repo_id string, host_name string")
    for name in ("status", "tc", "app_id", "clone_url_ssh", "updated_on"):
        inventory = inventory.withColumn(name, F.lit(None).cast("string"))
    metrics = spark.createDataFrame([("a", "ACTIVE", 1, 5.0, None)], "repo_id string, activity_status string, number_of_contributors int, repo_size_bytes double, updated_at timestamp")
    languages = spark.createDataFrame([("a", "Go", 50.0)], "repo_id string, language string, percent_usage double")
    cloc = spark.createDataFrame([("b", 3)], "repo_id string, code int")
    inputs = {"inventory": inventory, "metrics": metrics, "languages": languages, "cloc": cloc}
    table = IncrementalTable(DerivedTable(spark, str(tmp_path / "t")), lambda i: derived.combined_repo_metrics(**i))
    assert table.refresh(inputs) == 2
    more = {**inputs, "languages": languages.union(spark.createDataFrame([("b", "C", 1.0)], languages.schema))}
    assert table.refresh(more) == 1
    assert rows(table.read()) == rows(derived.combined_repo_metrics(**more))
