import random

import pytest

from tallyworks.llm import store
from tallyworks.llm.ordering import running


@pytest.mark.parametrize("seed", [1, 2])
def test_running_sums_with_a_hot_group_and_nulls(spark, seed):
    random.seed(seed)
    rows = [(random.choice(["hot", "hot", "hot", "a", None]), random.randint(0, 9) or None, i, random.randint(0, 5)) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, o int, i int, v long").repartition(6)
    got = {r.i: r.before for r in running(df, ["g"], ["o", "i"], "v", "before").collect()}
    sums = {}
    for g, o, i, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        assert got[i] == sums.get(g, 0)
        sums[g] = sums.get(g, 0) + v
    assert len(got) == 700


def test_running_over_an_empty_table_and_without_groups(frame):
    assert running(frame([], "g string, v long"), ["g"], ["g"], "v", "before").count() == 0
    rows = running(frame([("b", 2), ("a", 1), ("c", 3)], "g string, v long"), [], ["g"], "v", "before").collect()
    assert {r.g: r.before for r in rows} == {"a": 0, "b": 1, "c": 3}


def test_saved_tables_keep_rows_and_types(frame):
    df = frame([(1, None, [1.5])], "a long, b string, c array<double>")
    assert store.save(df, "t").collect() == df.collect() and store.save(df, "t").dtypes == df.dtypes
    assert store.save(df.limit(0), "t").count() == 0


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: None)

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "x"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_folder(Session)
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_folder(Session)
    Session.sparkContext.master = "local[4]"
    assert store.shared_folder(Session) == store.shared_folder(Session)
