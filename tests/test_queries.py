"""Every registered query against its SQL."""

import pytest
from compare import assert_same, connect

from tilewise.plans.queries import QUERIES
from tilewise.plans.sql import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert_same(QUERIES[name](spark, sf_dir), con, ORACLES[name])


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_weighted_draws_follow_the_mass(spark, sf_dir):
    from pyspark.sql import functions as F

    from tilewise.operators.sampling import draw_pairs

    pairs = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 0.0)], "k string, area double")
    draws = spark.range(4000).withColumn("u", (F.col("id") + 0.5) / 4000)
    n = {r.k: r.n for r in draw_pairs(pairs, "area", ["k"], draws).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert n == {"a": 1000, "b": 3000}
    assert draw_pairs(pairs.where("area = 0"), "area", ["k"], draws).count() == 0
