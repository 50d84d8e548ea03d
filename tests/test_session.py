from types import SimpleNamespace

import pytest

from salvor import session


def test_scratch_is_cleared(spark, tmp_path):
    path = session.scratch(spark, "trial")
    spark.range(3).write.parquet(path)
    session.clear_scratch(spark)
    assert not session._made
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_a_cluster_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda key, default: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.shared_folder(SimpleNamespace(conf=conf, sparkContext=context))


def test_drivers_without_a_gender_are_dropped(spark):
    from salvor.plans.drivers import safety_quartiles

    rows = [("F", 1.0), ("F", 2.0), (None, 3.0)]
    got = safety_quartiles(spark.createDataFrame(rows, "gender string, safety_rating double")).collect()
    assert {r["gender"] for r in got} == {"F"}
