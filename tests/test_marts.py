"""Case-value clusters and session settings."""

import random
from itertools import combinations

import pytest

from lexweave import session
from lexweave.plans import marts
from lexweave.plans.marts import case_value_clusters, cluster_starts, posts_by_hashtag


def test_clusters_are_ordered_and_bounded(spark):
    values = [1.0, 1.5, 10.0, 10.5, 50.0, 51.0, 200.0, 1000.0, 1001.0, 5000.0]
    df = spark.createDataFrame([(v,) for v in values + values[:3] + [None]], "v double")
    out = case_value_clusters(df, "v", bounds_k=3).orderBy("final_value").collect()
    assert [r.final_value for r in out] == sorted(values)
    for k in range(2, 8):
        labels = [r[f"clusters_{k}"] for r in out]
        assert labels == sorted(labels) and set(labels) == set(range(k))
    for r in out:
        assert r.clusters_lower_bound <= r.final_value <= r.clusters_upper_bound


def cost(groups):
    return sum(sum((v - sum(g) / len(g)) ** 2 for v in g) for g in groups)


def split(values, starts):
    ends = [0, *starts, len(values)]
    return [values[a:b] for a, b in zip(ends, ends[1:])]


@pytest.mark.parametrize("seed", range(6))
def test_cluster_starts_cost_least_of_all(seed):
    rng = random.Random(seed)
    values = sorted(rng.choices([int(rng.lognormvariate(4, 2)) for _ in range(9)], k=40))
    bins = sorted({v: values.count(v) for v in values}.items())
    starts = cluster_starts([(v, n, n * v, n * v * v) for v, n in bins], 5)
    distinct = [v for v, _ in bins]
    for k in range(1, min(5, len(bins)) + 1):
        least = min(cost(split(values, [values.index(c) for c in cuts])) for cuts in combinations(distinct[1:], k - 1))
        assert cost(split(values, [values.index(c) for c in starts[k]])) == pytest.approx(least, abs=1e-6)


@pytest.mark.parametrize("shape", ["even", "skewed", "few", "one", "none"])
def test_clusters_are_close_to_the_best_and_the_same_in_every_run(spark, shape):
    rng = random.Random(3)
    values = {
        "even": [rng.uniform(0, 1000) for _ in range(300)],
        "skewed": [rng.lognormvariate(3, 2.5) for _ in range(300)],
        "few": [1.0, 1.0, 2.0, 9.0], "one": [5.0] * 3, "none": [],
    }[shape]
    df = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "v double")
    out = case_value_clusters(df, "v").orderBy("final_value").collect()
    again = case_value_clusters(df.repartition(7), "v").orderBy("final_value").collect()
    assert out == again and [r.final_value for r in out] == sorted(set(values))
    values.sort()
    grid = [(i, 1, round(v * 1e6), round(v * 1e6) ** 2) for i, v in enumerate(values)]
    for k in range(2, 8):
        labels = {r.final_value: r[f"clusters_{k}"] for r in out}
        groups = [[v for v in values if labels[v] == i] for i in sorted(set(labels.values()))]
        if values:
            best = split(values, cluster_starts(grid, k)[min(k, len(values))])
            assert cost(groups) <= cost(best) * 1.01 + 1e-6, (shape, k)


def test_a_tag_counts_once_per_post(spark):
    df = spark.sql("SELECT '#a x #b #a' Caption, timestamp'2024-01-01 05:00:00' PostDate")
    assert sorted((r.Hashtag, r.Posts) for r in posts_by_hashtag(df).collect()) == [("a", 1), ("b", 1)]


def test_scratch_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(root)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_no_machine_local_scratch_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Cluster(), "x")


def test_all_grains_and_rollups_read_their_rows_once(spark):
    from conftest import SF

    from lexweave.catalogue import QUERIES

    for name in ("a9_targets_in_one_pass", "a5_rollups_in_one_pass"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1, name


def test_a_removed_post_leaves_no_entry(spark):
    posts = spark.sql("SELECT '#a x' Caption, timestamp'2024-01-01 05:00:00' PostDate, 't' Media_Type, 2 Comments, 3 Likes")
    whole = marts.post_rollups(posts)
    assert sorted((r.rollup, r.key, r.Posts, r.Likes) for r in whole.collect()) == [
        ("date", None, 1, 3), ("hashtag", "a", 1, 3), ("hour", "5", 1, 3), ("media_type", "t", 1, 3)]
    assert marts.merge_rollups(whole, marts.post_changes(posts, posts.limit(0))).count() == 0
