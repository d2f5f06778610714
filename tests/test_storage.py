"""Tables in the shared folder, ranks and running sums."""

import os
import random

import pytest
from pyspark.sql import functions as F

from peakloom import storage


def test_running_sums_equal_brute_force(spark, monkeypatch):
    """A group that is most of the table, null groups, ties, descending order, and no group; also beyond the broadcast bound."""
    r = random.Random(1)
    rows = [(r.choice(["hot"] * 8 + ["a", None]), r.randrange(40), r.randrange(5), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, k long, v long, id long").repartition(5)
    for bound in (storage.BROADCAST_ROWS, 0):
        monkeypatch.setattr(storage, "BROADCAST_ROWS", bound)
        got = {x.id: x.at for x in storage.running(df, ["g"], ["k", "id"], "at", "v").collect()}
        assert got == {i: sum(w for h, c, w, j in rows if h == g and (c, j) < (k, i)) for g, k, _, i in rows}
    ranks = {x.id: x.at for x in storage.running(df, [], [F.desc("k"), F.desc("id")], "at").collect()}
    order = sorted(rows, key=lambda x: (x[1], x[3]), reverse=True)
    assert ranks == {x[3]: i for i, x in enumerate(order)}
    tied = [x.at for x in storage.running(df.select("g", "k"), ["g"], ["k"], "at", ranges=1).filter("g = 'hot'").collect()]
    assert sorted(tied) == list(range(len(tied)))
    assert storage.running(df.filter("false"), ["g"], ["k"], "at").count() == 0


def test_tables_are_in_the_shared_folder_until_discarded(spark):
    before = storage.made()
    df = storage.materialise(spark.range(5))
    (path,) = [p for p in storage.made() if p not in before]
    assert df.count() == 5 and path.startswith(storage.shared_dir(spark)) and os.path.isdir(path)
    storage.discard(spark, [path, "/not/ours"])
    assert not os.path.exists(path) and storage.made() == before


def test_scratch_tables_go_at_the_end(spark):
    before = storage.made()
    with storage.scratch(spark):
        df = storage.materialise(spark.range(3))
        assert df.count() == 3 and len(storage.made()) == len(before) + 1
    assert storage.made() == before


def test_a_driver_s_own_folder_is_an_error_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context
        conf = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        storage.shared_dir(Session)
    Session.conf = {"spark.sql.warehouse.dir": "hdfs://name/warehouse"}
    assert storage.shared_dir(Session) == "hdfs://name/warehouse/scratch"
    Context.master = "local[4]"
    Session.conf = {"spark.sql.warehouse.dir": "/tmp/warehouse"}
    assert storage.shared_dir(Session) == "/tmp/warehouse/scratch"
