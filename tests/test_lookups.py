import pytest
from pyspark.sql import functions as F

from tarmaq.operators.dedup import distinct_rows, first_per_key, repeated_keys, require_unique
from tarmaq.operators.lookup import Mark, attach, best_per_key, mark_membership, not_in, without_match
from tests.conftest import plan, rows


def test_first_per_key_groups_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(None, 1, "b"), (None, 1, "a"), ("x", 2, "c"), ("x", 1, "d"), ("", 1, "e")],
        "k string, t int, f string")
    assert rows(first_per_key(df, ["k"], ["t", "f"])) == sorted(
        [(None, 1, "a"), ("x", 1, "d"), ("", 1, "e")], key=repr)


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    firsts = first_per_key(df, ["k"], ["id"])
    text = plan(firsts)
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")
    assert firsts.count() == df.select("k").distinct().count()


def test_distinct_rows_agree_with_first_per_key(spark):
    df = spark.createDataFrame([(1, None, "p"), (1, None, "q"), (1, 2, "r")], "a int, b int, f string")
    assert rows(distinct_rows(df, ["a", "b"])) == rows(
        first_per_key(df, ["a", "b"], ["f"]).select("a", "b"))


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([("d", "1"), ("d", "1"), ("t", "1")], "domain string, code string")
    assert rows(repeated_keys(df, ["domain", "code"])) == [("d", "1", 2)]
    with pytest.raises(ValueError, match="not unique"):
        require_unique(df, ["domain", "code"])


def test_best_per_key_skips_empty_keys(spark):
    df = spark.createDataFrame(
        [("A", 1, "z"), ("A", 0, "y"), ("A", 0, "x"), ("", 0, "w"), (None, 0, "v")],
        "icao string, rank int, name string")
    assert rows(best_per_key(df, "icao", ["rank", "name"], ["name"])) == [("A", "x")]


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_membership_flags_never_change_the_rows(spark, limit):
    df = spark.createDataFrame(
        [(1, "A", "B"), (2, "A", None), (3, "", "C"), (3, "", "C")], "id int, o string, d string")
    registry = spark.sql("SELECT * FROM VALUES ('A'), ('A'), (''), (NULL), ('B') AS t(icao)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        marked = mark_membership(
            df, [Mark("has_o", "o", registry, "icao"), Mark("has_d", "d", registry, "icao")])
        assert ("BroadcastHashJoin" in plan(marked)) == (limit == "10MB")
        assert rows(marked) == sorted([
            (1, "A", "B", True, True), (2, "A", None, True, False),
            (3, "", "C", False, False), (3, "", "C", False, False)], key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_attach_in_two_roles(spark):
    trips = spark.createDataFrame([("A", "B"), ("B", "Z"), (None, "A")], "o string, d string")
    places = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "code string, name string")
    both = attach(attach(trips, "o", places, "code", {"name": "from_name"}),
                  "d", places, "code", {"name": "to_name"})
    assert rows(both) == sorted([
        ("A", "B", "Alpha", "Beta"), ("B", "Z", "Beta", None), (None, "A", None, "Alpha")], key=repr)


def test_same_code_in_two_domains_does_not_fan_out(spark):
    from tarmaq.plans.gold import with_code_descriptions

    codes = spark.createDataFrame(
        [("a", "1", "one of a"), ("b", "1", "one of b")],
        "domain string, code string, description string")
    df = spark.createDataFrame([("1", "1"), ("2", None)], "a string, b string")
    assert rows(with_code_descriptions(df, codes, {"a": "a_text", "b": "b_text"})) == sorted([
        ("1", "1", "one of a", "one of b"), ("2", None, "Codigo nao catalogado (2)", None),
    ], key=repr)


@pytest.mark.parametrize("others", [[1, 2], [1, None], [], [None]])
def test_not_in_matches_sql(spark, others):
    df = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    side = spark.createDataFrame([(o,) for o in others], "y int")
    df.createOrReplaceTempView("probe")
    side.createOrReplaceTempView("side")
    wanted = spark.sql("SELECT * FROM probe WHERE x NOT IN (SELECT y FROM side)")
    assert rows(not_in(df, "x", side, "y")) == rows(wanted)


def test_without_match_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    side = spark.createDataFrame([(1,), (None,)], "y int")
    assert rows(without_match(df, "x", side, "y")) == sorted([(3,), (None,)], key=repr)


def test_a_hot_key_is_split_when_the_side_is_too_big_to_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        steps = spark.range(0, 300_000, 1, 8).select("id", F.when(
            F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") % 5000).cast("string")).alias("code"))
        registry = spark.range(4000).select(F.col("id").cast("string").alias("icao")).union(
            spark.createDataFrame([("HOT",)], "icao string"))
        marked = mark_membership(steps, [Mark("known", "code", registry, "icao", unique=True)])
        counted = {row["known"]: row["count"] for row in marked.groupBy("known").count().collect()}
        joined = marked.persist()
        assert joined.count() == 300_000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
        joined.unpersist()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert counted == {True: 260_000, False: 40_000}


def test_planning_runs_nothing(spark, tmp_path):
    spark.range(5).select(F.col("id").cast("string").alias("icao")).write.parquet(str(tmp_path / "r"))
    registry = spark.read.parquet(str(tmp_path / "r"))
    df = spark.range(3).select(F.col("id").cast("string").alias("o"))
    spark.sparkContext.setJobGroup("planning only", "")
    try:
        marked = mark_membership(df, [Mark("has", "o", registry, "icao")])
        best = best_per_key(registry, "icao", ["icao"], ["icao"])
        plan(marked), plan(best)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
