"""Recommender and rule mining against brute force on small fixtures."""

import itertools

import numpy as np
import pytest

from bazaar.operators import rules as B
from bazaar.operators import neighbours as N

RATINGS = {
    (1, 10): 5.0, (2, 10): 5.0, (3, 10): 5.0,          # 1, 2, 3: identical vectors (ties)
    (4, 11): 3.0, (4, 12): 4.0, (5, 12): 4.0, (5, 13): 1.0,
    (6, 14): 2.0,                                     # 6 shares nothing: all neighbours padded
    (7, 10): 1.0, (7, 11): 2.0, (7, 12): 3.0, (7, 13): 4.0, (7, 15): 5.0,
    (8, 16): 5.0, (8, 10): 2.0,
}


def brute(ratings, k, n):
    users = sorted({u for u, _ in ratings})
    prods = sorted({p for _, p in ratings})
    m = np.zeros((len(users), len(prods)))
    for (u, p), r in ratings.items():
        m[users.index(u), prods.index(p)] = r
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    nbs, recs = {}, {}
    for i, u in enumerate(users):
        cands = [(round(float(unit[i] @ unit[j]), 9), v) for j, v in enumerate(users) if v != u]
        # ascending stable sort by similarity, then reversed: ties -> higher id first
        top = sorted(cands, key=lambda t: (t[0], t[1]), reverse=True)[:k]
        nbs[u] = [v for _, v in top]
        mean = m[[users.index(v) for v in nbs[u]]].mean(axis=0)
        order = sorted(range(len(prods)), key=lambda j: (-round(float(mean[j]), 9), prods[j]))
        recs[u] = [prods[j] for j in order[:n]]
    return nbs, recs


@pytest.fixture(scope="module")
def ratings_df(spark):
    rows = [(u, p, r) for (u, p), r in RATINGS.items()]
    return spark.createDataFrame(rows, "customer_id long, product_id long, rating double")


def _lists(df, key, val):
    out = {}
    for r in df.orderBy(key, "rank").collect():
        out.setdefault(r[key], []).append(r[val])
    return out


@pytest.mark.parametrize("k,n", [(5, 5), (2, 3)])
def test_neighbours_and_recommendations_match_brute_force(ratings_df, k, n):
    nbs, recs = brute(RATINGS, k, n)
    nb = N.similar_users(ratings_df, k)
    assert _lists(nb, "customer_id", "neighbour") == nbs
    rc = N.recommend(ratings_df, nb, n)
    assert _lists(rc, "customer_id", "product_id") == recs


def test_ties_and_padding(ratings_df):
    got = _lists(N.similar_users(ratings_df, 5), "customer_id", "neighbour")
    assert got[1][:2] == [3, 2]          # equal similarity -> higher user id first
    assert got[6] == [8, 7, 5, 4, 3]     # no overlap -> highest ids, itself excluded


def test_targets_equal_all_users(spark, ratings_df):
    targets = spark.createDataFrame([(1,), (6,), (99,)], "customer_id long")
    some = _lists(N.similar_users(ratings_df, 5, targets=targets), "customer_id", "neighbour")
    every = _lists(N.similar_users(ratings_df, 5), "customer_id", "neighbour")
    assert some == {1: every[1], 6: every[6]}


def test_recommend_or_default(spark, ratings_df):
    nb = N.similar_users(ratings_df, 5)
    recs = N.recommend(ratings_df, nb, 5)
    requests = spark.createDataFrame([(1,), (99,)], "customer_id long")
    out = N.recommend_or_default(requests, recs, [101, 102, 103, 104, 105], 5)
    rows = {}
    for r in out.orderBy("customer_id", "rank").collect():
        rows.setdefault(r.customer_id, []).append((r.product_id, r.is_default))
    assert rows[99] == [(p, True) for p in [101, 102, 103, 104, 105]]
    assert [p for p, _ in rows[1]] == brute(RATINGS, 5, 5)[1][1]
    assert not any(d for _, d in rows[1])


def test_exclude_seen(ratings_df):
    nb = N.similar_users(ratings_df, 5)
    rc = N.recommend(ratings_df, nb, 3, exclude_seen=True)
    seen = {(u, p) for u, p in RATINGS}
    for r in rc.where("score > 0").collect():
        assert (r.customer_id, r.product_id) not in seen


def test_user_product_ratings_min_rows(spark):
    rows = [(1, 10, 4.0), (1, 10, 2.0), (2, 11, 5.0), (3, 12, 1.0), (3, 13, 3.0)]
    df = spark.createDataFrame(rows, "customer_id long, product_id long, review_score double")
    got = {(r.customer_id, r.product_id): r.rating
           for r in N.user_product_ratings(df, "customer_id", "product_id", "review_score").collect()}
    assert got == {(1, 10): 3.0, (3, 12): 1.0, (3, 13): 3.0}   # user 2 has one row only


BASKETS = [
    (1, [1, 2, 3]), (2, [1, 2]), (3, [1, 2, 4]), (4, [2, 3]), (5, [1, 3]),
    (6, [4]), (7, [1, 2, 3]), (8, [5, 1]), (9, [2, 2, 1]),
]


def brute_rules(baskets, s, c, lift_min, max_len=3):
    sets = [frozenset(b) for _, b in baskets]
    n = len(sets)
    sup = lambda items: sum(1 for b in sets if items <= b) / n
    items = sorted({i for b in sets for i in b})
    out = {}
    for size in range(2, max_len + 1):
        for combo in itertools.combinations(items, size):
            whole = frozenset(combo)
            if sup(whole) < s:
                continue
            for y in combo:
                ante = whole - {y}
                conf = sup(whole) / sup(ante)
                lift = conf / sup(frozenset([y]))
                if conf >= c and lift >= lift_min:
                    out[(tuple(sorted(ante)), y)] = (round(sup(whole), 9), round(conf, 9), round(lift, 9))
    return out


def _rows(spark):
    return spark.createDataFrame([(o, i) for o, b in BASKETS for i in b], "o long, i long")


def test_pair_rules_brute_force(spark):
    got = {((r.antecedent,), r.consequent): (r.support, r.confidence, r.lift)
           for r in B.pair_rules(_rows(spark), "o", "i", 0.2, 0.3, 0.0).collect()}
    want = brute_rules(BASKETS, 0.2, 0.3, 0.0, max_len=2)
    assert got == want and got


def test_association_rules_brute_force(spark):
    b = B.baskets(_rows(spark), "o", "i")
    assert b.where("o = 9").first()["items"] == [1, 2]    # duplicates removed, sorted
    got = {(tuple(r.antecedent), r.consequent[0]): (r.support, r.confidence, r.lift)
           for r in B.association_rules(b, "items", 0.2, 0.3, 0.0).collect()}
    assert got == brute_rules(BASKETS, 0.2, 0.3, 0.0, max_len=3)


def test_rules_lift_filter(spark):
    b = B.baskets(_rows(spark), "o", "i")
    lifts = [r.lift for r in B.association_rules(b, "items", 0.2, 0.3, 1.0).collect()]
    assert lifts and min(lifts) >= 1.0


def brute_splits(baskets, s, c, lift_min):
    """Rules with any number of items on each side."""
    sets = [frozenset(b) for b in baskets]
    sup = lambda items: sum(1 for b in sets if items <= b) / len(sets)
    items, out = sorted({i for b in sets for i in b}), {}
    for size in range(2, len(items) + 1):
        for combo in itertools.combinations(items, size):
            whole = sup(frozenset(combo))
            for m in range(1, size) if whole >= s else ():
                for cons in itertools.combinations(combo, m):
                    ante = tuple(i for i in combo if i not in cons)
                    conf = whole / sup(frozenset(ante))
                    lift = conf / sup(frozenset(cons))
                    if conf >= c and lift >= lift_min:
                        out[ante, cons] = (round(whole, 9), round(conf, 9), round(lift, 9))
    return out


@pytest.mark.parametrize("seed, s, c, lift", [(None, 0.2, 0.3, 0.0), (1, 0.05, 0.15, 0.0), (2, 0.1, 0.25, 0.9), (3, 0.02, 0.05, 1.0)])
def test_lattice_rules_brute_force(spark, seed, s, c, lift):
    if seed is None:
        data = [b for _, b in BASKETS]
    else:
        rng = np.random.default_rng(seed)
        data = [sorted({int(x) for x in rng.integers(0, 7, rng.integers(1, 7))}) for _ in range(60)]
    df = spark.createDataFrame([(o, i) for o, b in enumerate(data) for i in b], "o long, i long")
    got = {(tuple(r.antecedent), tuple(r.consequent)): (r.support, r.confidence, r.lift)
           for r in B.lattice_rules(B.baskets(df, "o", "i"), "items", s, c, lift).collect()}
    assert got == brute_splits(data, s, c, lift)
    assert max(len(cons) for _, cons in got) > 1


def test_lattice_rules_of_one_basket_kind_and_of_none(spark):
    same = spark.createDataFrame([(["a", "b", "c"],)] * 4, "items array<string>")
    got = {(tuple(r.antecedent), tuple(r.consequent)) for r in B.lattice_rules(same, "items", 0.5, 1.0).collect()}
    assert (("a",), ("b", "c")) in got and len(got) == 12
    assert B.lattice_rules(same.limit(0), "items", 0.5, 1.0).collect() == []


def _skewed(seed, users=400, hot=3):
    """Clusters that share rare products, and a few products that most rate."""
    rng = np.random.default_rng(seed)
    out = {}
    for u in range(users):
        for p in rng.integers(0, 8, 4):
            out[u, 1000 + 10 * (u // 12) + int(p)] = float(rng.integers(3, 6))
        for p in range(hot):
            if rng.random() < 0.8:
                out[u, p] = float(rng.integers(1, 3))
    out[users, 0] = 5.0                      # nothing but hot products
    out |= {(users + 1, p): 1.0 for p in range(hot)}
    out[users + 2, 9999] = 2.0               # nothing in common with any other
    return out


@pytest.mark.parametrize("seed, cold, block, levels", [(1, 64, 10_000, 40), (2, 5, 7, 40), (3, 1, 50, 3), (4, 30, 10_000, 1)])
def test_index_gives_the_rows_of_the_self_join(spark, monkeypatch, seed, cold, block, levels):
    monkeypatch.setattr(N, "LEVELS", levels)
    ratings = _skewed(seed, users=150)
    df = spark.createDataFrame([(u, p, r) for (u, p), r in ratings.items()], "customer_id long, product_id long, rating double")
    got = _lists(N.similar_users_by_index(df, 5, cold_raters=cold, max_block=block), "customer_id", "neighbour")
    assert got == brute(ratings, 5, 5)[0]


def test_index_equals_similar_users_on_data_without_structure(spark):
    rng = np.random.default_rng(5)
    rows = {(int(u), int(p)): float(r) for u, p, r in zip(rng.integers(0, 80, 900), rng.integers(0, 40, 900), rng.integers(1, 6, 900))}
    df = spark.createDataFrame([(u, p, r) for (u, p), r in rows.items()], "customer_id long, product_id long, rating double")
    got = _lists(N.similar_users_by_index(df, 4, cold_raters=20), "customer_id", "neighbour")
    assert got == _lists(N.similar_users(df, 4), "customer_id", "neighbour")


def test_index_forms_fewer_pairs(spark):
    from pyspark.sql import functions as F
    ratings = _skewed(7)
    df = spark.createDataFrame([(u, p, r) for (u, p), r in ratings.items()], "customer_id long, product_id long, rating double")
    steps = N.index_pairs(N._unit_weights(df, "customer_id", "product_id", "rating"), 5)
    formed = steps["cold"].count() + sum(steps[n].agg(F.coalesce(F.sum("__formed"), F.lit(0))).first()[0] for n in ("prefix", "checked"))
    raters = {}
    for _, p in ratings:
        raters[p] = raters.get(p, 0) + 1
    assert formed < 0.1 * sum(n * (n - 1) for n in raters.values())


def test_index_of_no_ratings(spark):
    df = spark.createDataFrame([], "customer_id long, product_id long, rating double")
    assert N.similar_users_by_index(df, 5).collect() == []


@pytest.mark.parametrize("slab, block", [(40, 7), (1, 3), (1 << 20, 10_000)])
def test_index_reads_by_tiles_and_slabs(spark, monkeypatch, slab, block):
    from bazaar.operators import tiles as X

    monkeypatch.setattr(X, "SLAB", slab)     # below a user's pairs it reads alone
    monkeypatch.setattr(X, "LEAST_ROWS", 100)
    ratings = _skewed(11, users=90)
    got = _lists(N.similar_users_by_index(_frame(spark, ratings), 5, cold_raters=6, max_block=block), "customer_id", "neighbour")
    assert got == brute(ratings, 5, 5)[0]


def test_index_broadcasts_no_table_of_users_and_stores_no_pairs(spark, monkeypatch):
    """Whatever the threshold, what grows with users, products or pairs is not
    gathered on the driver; of pairs over cold products only the k best are kept."""
    from bazaar.operators import tiles as X

    plans, real = [], N.stored

    def watched(df, *a, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *a, **kw)

    for m in (N, X):
        monkeypatch.setattr(m, "stored", watched)
    monkeypatch.setattr(X, "LEAST_ROWS", 100)
    ratings = _skewed(12, users=120) | {(u, 500): 3.0 for u in range(120)}
    df = _frame(spark, ratings)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "1g")
    try:
        got = N.similar_users_by_index(df, 5, cold_raters=200)
        plans.append(got._jdf.queryExecution().executedPlan().toString())
        want = brute(ratings, 5, 5)[0]
        assert _lists(got, "customer_id", "neighbour") == want
        assert len(plans) > 5 and not any("BroadcastHashJoin" in p for p in plans)
        cold = N.index_pairs(N._unit_weights(df, "customer_id", "product_id", "rating"), 5, 200)["cold"]
        assert cold.count() <= 5 * 123 * X.number_of_tiles(len(ratings)) < 120 * 119
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def _frame(spark, ratings):
    return spark.createDataFrame([(u, p, r) for (u, p), r in ratings.items()], "customer_id long, product_id long, rating double")


@pytest.mark.parametrize("seed, change", [(1, "ratings"), (2, "new users"), (3, "users gone"), (4, "nothing")])
def test_refreshed_neighbours_equal_a_full_run(spark, seed, change):
    rng = np.random.default_rng(seed)
    old = {(int(u), 100 * (int(u) // 10) + int(p)): float(r) for u, p, r in zip(
        rng.integers(0, 60, 300), rng.integers(0, 12, 300), rng.integers(1, 6, 300))}
    new = dict(old)
    if change == "ratings":
        new[next(iter(old))] += 0.5
        new[3, 555_555] = 2.0
        del new[list(old)[5]]
    elif change == "new users":
        new |= {(1000, 0): 4.0, (1001, 777): 1.0, (1002, 777): 1.0}
    elif change == "users gone":
        new = {k: v for k, v in old.items() if k[0] not in (59, 58, 3)}
    a, b = _frame(spark, old), _frame(spark, new)
    got = N.refreshed_neighbours(N.similar_users(a, 4), a, b, 4)
    order = ["customer_id", "rank", "neighbour", "similarity"]
    assert sorted(map(tuple, got.select(order).collect())) == sorted(map(tuple, N.similar_users(b, 4).select(order).collect()))
    moved = {r[0] for r in N.changed_users(a, b).collect()}
    assert moved == {u for u, p in set(old) | set(new) if old.get((u, p)) != new.get((u, p))}


def test_ratings_by_buckets_are_not_shuffled(spark, ratings_df, tmp_dir):
    from bazaar.sources.io import save_ratings_table

    table = save_ratings_table(ratings_df, "ratings_in_buckets", 4, path=f"{tmp_dir}/ratings")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.sources.bucketing.autoBucketedScan.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        nb = N.similar_users(ratings_df, 5)
        recs = N.recommend(table, nb, 5, bucketed=True)
        assert _lists(recs, "customer_id", "product_id") == brute(RATINGS, 5, 5)[1]
        targets = spark.createDataFrame([(1,), (6,)], "customer_id long")
        some = N.similar_users(table, 5, targets=targets, bucketed=True)
        assert _lists(some, "customer_id", "neighbour") == {u: brute(RATINGS, 5, 5)[0][u] for u in (1, 6)}
        # lengths by user, and the ratings of the neighbours: no exchange between the scan and the join
        unit = N._unit_weights(table, "customer_id", "product_id", "rating", bucketed=True)
        assert "Exchange" not in unit._jdf.queryExecution().executedPlan().toString()
        met = nb.select("customer_id", "neighbour").join(table.select(table.customer_id.alias("neighbour"), "rating"), "neighbour")
        lines = met._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, x in enumerate(lines) if "ratings_in_buckets" in x and "Bucketed: true" in x)
        join = max(i for i in range(scan) if "SortMergeJoin" in lines[i])
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        above = [x for i, x in enumerate(lines[join:scan], join) if all(depth(x) < depth(y) for y in lines[i + 1:scan + 1])]
        assert not any("Exchange" in x for x in above)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
def test_merged_ratings_equal_the_full_build(spark, tmp_dir, seed):
    from bazaar.operators.rating_sums import merge_ratings, ratings_of, read_sums

    rng = np.random.default_rng(seed)
    rows = [(int(u), int(p), float(s), int(b)) for u, p, s, b in zip(
        rng.integers(0, 25, 200), rng.integers(0, 9, 200), rng.integers(1, 6, 200), rng.choice([0, 0, 1, 2, 4], 200))]
    rows += [(None, 1, 5.0, 0), (1, None, 5.0, 1), (2, 2, None, 2), (99, 1, 3.0, 4)]
    df = spark.createDataFrame(rows, "customer_id long, product_id long, review_score double, b int")
    path = f"{tmp_dir}/sums"
    assert read_sums(spark, path) is None
    for batch in (0, 1, 1, 2, 0, 3, 4, 4):  # some run again, one is empty
        merge_ratings(df.where(f"b = {batch}"), path, batch, "customer_id", "product_id", "review_score", 5)
    got = sorted(map(tuple, ratings_of(read_sums(spark, path), "customer_id", "product_id").collect()))
    want = N.user_product_ratings(df, "customer_id", "product_id", "review_score").select("customer_id", "product_id", "rating")
    assert got == sorted(map(tuple, want.collect()))


def test_a_batch_writes_only_the_partitions_of_its_users(spark, tmp_dir):
    import os

    from bazaar.operators.rating_sums import merge_ratings

    df = spark.createDataFrame([(u, 1, 5.0) for u in range(40)], "customer_id long, product_id long, review_score double")
    path = f"{tmp_dir}/sums"
    files = lambda: {(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    merge_ratings(df, path, 0, "customer_id", "product_id", "review_score", 8)
    before = files()
    merge_ratings(df.where("customer_id = 3"), path, 1, "customer_id", "product_id", "review_score", 8)
    assert len({d for d, _ in before ^ files()}) == 1
    merge_ratings(df.limit(0), path, 2, "customer_id", "product_id", "review_score", 8)
