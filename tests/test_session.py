import os

import pytest

from tradeflow import session


def test_dropped_work(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    pinned = session.pin(spark.range(3), "numbers")
    assert pinned.count() == 3 and os.listdir(tmp_path / "tradeflow")
    session.drop_work(spark)
    assert not (tmp_path / "tradeflow").exists()


@pytest.mark.parametrize("master,allowed", [("local", True), ("local[4]", True), ("local-cluster[2,1,512]", False), ("yarn", False)])
def test_a_cluster_needs_a_shared_folder(master, allowed):
    class Context:
        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, _):
            pass

    class Session:
        sparkContext = Context()
        conf = {}

    Context.master = master
    if allowed:
        assert session.shared_folder(Session()).startswith("/")
    else:
        with pytest.raises(ValueError):
            session.shared_folder(Session())


def test_tables_made_meanwhile_can_be_dropped(spark):
    kept = session.pin(spark.range(2), "kept")
    with session.noted() as made:
        session.pin(spark.range(3), "gone")
        with session.noted() as inner:
            session.pin(spark.range(4), "inner")
    after = session.pin(spark.range(5), "after")
    assert [len(made), len(inner)] == [1, 1] and "gone" in made[0]
    session.drop_tables(spark, made + inner)
    assert not os.path.exists(made[0]) and not os.path.exists(inner[0])
    assert (kept.count(), after.count()) == (2, 5)


def test_a_join_on_the_key_of_a_pinned_table_moves_the_other_side_only(spark):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(4, "id")
    with session.noted() as made:
        held = session.pin_by(rows, "id", "held")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.range(0, 2000, 2).join(held, "id")
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning") == 1
        assert joined.count() == 500 and held.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(made) == 1 and not [t for t in spark.catalog.listTables() if t.name.startswith("pinned_")]
