import random

from pyspark.sql import functions as F

from adfeat.operators.skew import chunked, join_hot, join_packed, key_counts, perhaps_asked, repeated


def frames(spark):
    rnd = random.Random(3)
    left = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), rnd.choice([1, 2]), i) for i in range(400)]
    right = [("hot", 1, "x"), ("hot", 1, "y"), ("hot", 2, "z"), ("a", 1, "w"), (None, 1, "never"), ("c", 1, "unused")]
    return spark.createDataFrame(left, "k string, j int, i int"), spark.createDataFrame(right, "k string, j int, v string")


def test_same_rows_as_a_plain_join(spark, rows_of):
    left, right = frames(spark)
    for how in ("inner", "left"):
        want = rows_of(left.join(right, ["k", "j"], how).select("k", "j", "i", "v"))
        for hot_rows in (1, 50, 10**9):
            assert rows_of(join_hot(left, right, ["k", "j"], how, hot_rows).select("k", "j", "i", "v")) == want
            assert rows_of(join_hot(left, right, ["k", "j"], how, hot_rows, chunk=3).select("k", "j", "i", "v")) == want
            assert rows_of(join_hot(left, right, ["k", "j"], how, hot_rows, chunk=None).select("k", "j", "i", "v")) == want
            same = left.drop("i").unionByName(left.drop("i"))
            plain = rows_of(same.join(right, ["k", "j"], how).select("k", "j", "v"))
            assert rows_of(join_hot(same, right, ["k", "j"], how, hot_rows, chunk=2).select("k", "j", "v")) == plain
            through = join_packed(chunked(same, 2), right, ["k", "j"], how, hot_rows, key_counts(same, ["k", "j"])).drop("_hash")
            assert rows_of(repeated(through).select("k", "j", "v")) == plain
        counts = key_counts(left, ["k", "j"])
        assert rows_of(join_hot(left, right, ["k", "j"], how, 20, counts).select("k", "j", "i", "v")) == want


def test_counts_add_up(spark):
    left, _ = frames(spark)
    fine = key_counts(left, ["k", "j"])
    assert {r.k: r._n for r in key_counts(fine, ["k"], "_n").collect()} == {r.k: r._n for r in key_counts(left, ["k"]).collect()}


def test_hot_rows_leave_one_task(spark):
    left = spark.range(4000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS i")
    right = spark.range(3000).selectExpr("id AS k", "id AS v").groupBy("k").agg(F.sum("v").alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)

        def tasks(df):
            rows = df.select("k", "v", F.spark_partition_id().alias("p")).where("k = 7")
            return rows.agg(F.count_distinct("p").alias("n"), F.sum("v")).first().n

        assert tasks(left.join(right, "k", "left")) == 1
        assert tasks(join_hot(left, right, ["k"], "left", 100)) > 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_equal_rows_leave_one_task(spark):
    left = spark.range(4000).selectExpr("CASE WHEN id % 5 = 0 THEN id END AS k").na.fill(7)
    right = spark.range(3000).selectExpr("id AS k", "id AS v").groupBy("k").agg(F.sum("v").alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = join_hot(left, right, ["k"], "left", 100, chunk=50).select("k", "v", F.spark_partition_id().alias("p")).where("k = 7")
        found = rows.agg(F.count_distinct("p").alias("n"), F.count(F.lit(1)).alias("rows"), F.min("v").alias("v")).first()
        assert found.n > 4 and found.rows == 3200 and found.v == 7
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_broadcast_list_is_bounded_and_holds_numbers_only(spark, monkeypatch):
    from adfeat.operators import skew

    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    left, right = frames(spark)
    sizes = join_hot(left, right, ["k", "j"], "inner", 1)._jdf.queryExecution().optimizedPlan().toString()
    hints = [line for line in sizes.splitlines() if "strategy=broadcast" in line]
    assert len(hints) == 3  # left twice, right once: all of the same list
    counts = key_counts(left, ["k", "j"])
    total = left.count()
    assert counts.where(F.col("_n") * 3 > total).count() <= 3


def test_rows_with_maps_are_counted_and_repeated(spark, rows_of):
    df = spark.sql("""
        SELECT k, named_struct('m', map('a', k, 'b', 2), 'x', array(map(1, 'z'))) AS s, CASE WHEN k = 2 THEN map('q', 1.5D) END AS m
        FROM (SELECT id % 3 AS k FROM range(40))""")
    packed = chunked(df, 4)
    assert packed.agg(F.sum("_times")).first()[0] == 40 and packed.agg(F.max("_times")).first()[0] == 4
    assert packed.count() == packed.select("_hash").distinct().count() == 12
    assert rows_of(repeated(packed.drop("_hash"))) == rows_of(df)
    right = spark.createDataFrame([(0, "x"), (1, "y")], "k long, v string")
    assert rows_of(join_hot(df, right, ["k"], "left", 5, chunk=3).select("k", "s", "m", "v")) == rows_of(df.join(right, "k", "left").select("k", "s", "m", "v"))


def test_rows_that_nobody_asks_for_go_before_the_shuffle(spark, rows_of):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("g")).unionByName(
        spark.sql("SELECT cast(NULL AS string) AS k, 1L AS g"))
    asked = spark.range(0, 20_000, 50).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("g"))
    near = perhaps_asked(rows, asked, ["k", "g"])
    exact = rows.join(asked, ["k", "g"], "left_semi")
    assert rows_of(near.join(asked, ["k", "g"], "left_semi")) == rows_of(exact)
    assert exact.count() <= near.count() < 500
    other = asked.withColumn("k", F.col("k").cast("bigint"))  # equal to the text in a join, with another hash
    assert perhaps_asked(rows, other, ["k", "g"]).count() == 20_001


def test_rows_of_other_users_go_before_the_shuffle(spark):
    from adfeat.operators.samples import of_label_users

    rows = spark.range(20_000).select(F.col("id").cast("string").alias("user_id"), F.lit(1).alias("imp"))
    labels = spark.sql("SELECT explode(array('5', '5', '77', 'x', NULL)) AS user_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # large labels: nothing is broadcast by its size
    try:
        kept = of_label_users(rows, labels)
        plan = kept._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(r.user_id for r in kept.collect()) == ["5", "77"]
    sort_merge, marks = (next(i for i, line in enumerate(plan) if kind in line) for kind in ("SortMergeJoin", "BroadcastHashJoin"))
    shuffle = next(i for i, line in enumerate(plan) if "Exchange hashpartitioning(user_id" in line)
    assert sort_merge < shuffle < marks
