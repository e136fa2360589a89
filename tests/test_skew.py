"""Hot keys: results stay exact when AQE splits skewed partitions."""

import random

from bazaar.operators import neighbours as N
from bazaar.operators import rules as B
from tests.test_recommender import brute, brute_rules

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_product_neighbours_exact(spark):
    rnd = random.Random(7)
    ratings = {}
    for u in range(1, 61):
        ratings[(u, 1000)] = float(rnd.randint(1, 5))          # one product rated by everyone
        for p in rnd.sample(range(1001, 1040), 3):
            ratings[(u, p)] = float(rnd.randint(1, 5))
    rows = [(u, p, r) for (u, p), r in ratings.items()]
    old = _with_conf(spark, SKEW_CONF)
    try:
        df = spark.createDataFrame(rows, "customer_id long, product_id long, rating double").repartition(8)
        nb = N.similar_users(df, 5, max_block=7)    # the hot product spans 9 x 9 blocks
        got = {}
        for r in nb.orderBy("customer_id", "rank").collect():
            got.setdefault(r.customer_id, []).append(r.neighbour)
        recs = {}
        for r in N.recommend(df, nb, 5, max_block=3).orderBy("customer_id", "rank").collect():
            recs.setdefault(r.customer_id, []).append(r.product_id)
    finally:
        _restore(spark, old)
    want_nb, want_recs = brute(ratings, 5, 5)
    assert got == want_nb
    assert recs == want_recs


def _ratings_with_hot_products(seed, users=150):
    """Two products rated by everyone, others by few; users have many ratings
    of their own, so the common ones weigh little."""
    rnd = random.Random(seed)
    ratings = {}
    for u in range(1, users + 1):
        ratings[(u, 1)] = float(rnd.randint(1, 2))
        if rnd.random() < 0.7:
            ratings[(u, 2)] = float(rnd.randint(1, 5))
        for p in rnd.sample(range(100 * (u % 10) + 10, 100 * (u % 10) + 40), rnd.choice([0, 1, 12, 20])):
            ratings[(u, p)] = float(rnd.randint(1, 5))
    return ratings


def test_pruned_pairs_of_hot_products_are_exact(spark):
    for seed in (1, 2):
        ratings = _ratings_with_hot_products(seed)
        df = spark.createDataFrame([(u, p, r) for (u, p), r in ratings.items()],
                                   "customer_id long, product_id long, rating double")
        want = brute(ratings, 5, 5)[0]
        for hot, block in ((20, 10_000), (3, 25)):
            got = {}
            for r in N.similar_users(df, 5, hot_raters=hot, max_block=block).orderBy("customer_id", "rank").collect():
                got.setdefault(r.customer_id, []).append(r.neighbour)
            assert got == want


def test_fewer_pairs_than_the_full_self_join(spark, monkeypatch):
    ratings = _ratings_with_hot_products(3, users=400)
    df = spark.createDataFrame([(u, p, r) for (u, p), r in ratings.items()], "customer_id long, product_id long, rating double")
    formed, real = [], N.reaching_pairs

    def counted(*a):
        out = real(*a)
        formed.append(out.agg({"__formed": "sum"}).first()[0])
        return out

    monkeypatch.setattr(N, "reaching_pairs", counted)
    N.similar_users(df, 5, hot_raters=100).count()
    raters = [sum((u, p) in ratings for u in range(1, 401)) for p in (1, 2)]
    assert 0 < formed[0] < 0.6 * sum(n * (n - 1) for n in raters)


def test_hot_basket_rules_exact(spark):
    rnd = random.Random(3)
    baskets = [(1, list(range(1, 40)))]                      # one very large basket
    baskets += [(o, rnd.sample(range(1, 40), 3)) for o in range(2, 120)]
    old = _with_conf(spark, SKEW_CONF)
    try:
        df = spark.createDataFrame([(o, i) for o, b in baskets for i in b], "o long, i long")
        got = {((r.antecedent,), r.consequent): (r.support, r.confidence, r.lift)
               for r in B.pair_rules(df, "o", "i", 0.03, 0.1, 1.0, max_block=5).collect()}
    finally:
        _restore(spark, old)
    assert got == brute_rules(baskets, 0.03, 0.1, 1.0, max_len=2) and got


def test_block_self_pairs_forms_each_pair_once(spark):
    from pyspark.sql import functions as F

    from bazaar.operators.joins import block_self_pairs

    rows = [(1, m) for m in range(50)] + [(2, m) for m in range(3)]
    df = spark.createDataFrame(rows, "k long, m long")
    got = block_self_pairs(df, "k", "m", max_block=4)
    pairs = [(r.k, r.l_m, r.r_m) for r in got.collect()]
    want = [(1, a, b) for a in range(50) for b in range(a + 1, 50)] + [(2, 0, 1), (2, 0, 2), (2, 1, 2)]
    assert sorted(pairs) == sorted(want)
    assert got.groupBy("k").agg(F.count(F.lit(1))).count() == 2


def test_block_join_meets_each_pair_once(spark):
    from bazaar.operators.joins import block_join

    left = spark.createDataFrame([(1, u) for u in range(40)] + [(2, 0)], "k long, u long")
    right = spark.createDataFrame([(1, p) for p in range(25)] + [(2, 7), (3, 9)], "k long, p long")
    got = sorted((r.k, r.u, r.p) for r in block_join(left, right, "k", "u", "p", max_block=6).collect())
    want = sorted([(1, u, p) for u in range(40) for p in range(25)] + [(2, 0, 7)])
    assert got == want


def test_no_join_or_window_on_the_raw_key(spark):
    """Rows of a hot key meet their block count, and each other, by key and
    salt or by key and blocks; only counts are joined by the key alone."""
    import re

    from bazaar.operators.joins import block_join, block_self_pairs

    old = _with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"})
    try:
        df = spark.createDataFrame([(1, m) for m in range(6)] + [(2, 0), (2, 1)], "k long, m long")
        frames = (block_self_pairs(df, "k", "m", max_block=2),
                  block_join(df, df.withColumnRenamed("m", "p"), "k", "m", "p", max_block=2))
        for frame in frames:
            plan = frame._jdf.queryExecution().optimizedPlan().toString()
            assert "Window" not in plan
            for line in plan.splitlines():
                if "Join" in line:
                    assert re.search(r"__salt|__a", line), line
    finally:
        _restore(spark, old)
    for block in (2, 100):
        assert block_self_pairs(df, "k", "m", max_block=block).count() == 16


def test_building_a_plan_runs_no_job(spark):
    from bazaar.operators.joins import block_join, block_self_pairs

    df = spark.createDataFrame([(1, m) for m in range(6)], "k long, m long")
    spark.sparkContext.setJobGroup("lazy", "lazy")
    try:
        block_self_pairs(df, "k", "m", max_block=2)
        block_join(df, df.withColumnRenamed("m", "p"), "k", "m", "p", max_block=2)
        N.user_product_ratings(df.withColumn("s", df.m * 1.0), "k", "m", "s")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_targets_path_blocks_hot_products(spark):
    rnd = random.Random(11)
    ratings = {}
    for u in range(1, 41):
        ratings[(u, 500)] = float(rnd.randint(1, 5))
        ratings[(u, 501 + u % 7)] = float(rnd.randint(1, 5))
    df = spark.createDataFrame([(u, p, r) for (u, p), r in ratings.items()],
                               "customer_id long, product_id long, rating double")
    targets = spark.createDataFrame([(u,) for u in range(1, 41, 3)], "customer_id long")
    got = {}
    for r in N.similar_users(df, 5, targets=targets, max_block=4).orderBy("customer_id", "rank").collect():
        got.setdefault(r.customer_id, []).append(r.neighbour)
    want = brute(ratings, 5, 5)[0]
    assert got == {u: want[u] for u in range(1, 41, 3)}


def test_salted_hot_keys_are_not_broadcast(spark):
    """A stored table of hot keys looks small, but each key stands for many salts."""
    from bazaar.operators.joins import SALTS, attach
    from bazaar.session import stored, tune

    tune(spark)
    df = stored(spark.range(400).selectExpr("id % 100 AS k", "id AS m"), "rows")
    hot = stored(spark.range(50).selectExpr("id AS k", "7 AS n"), "hot")
    got = attach(df, "k", "m", hot, {"n": 1})
    assert SALTS > 1 and sorted((r.k, r.m, r.n) for r in got.collect()) == sorted(
        (m % 100, m, 7 if m % 100 < 50 else 1) for m in range(400))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().toString()
