"""Session helpers: the shared scratch folder follows the session's checkpoint dir."""

from gustolake.plans import jobs
from gustolake.session import scratch_dir


def test_scratch_dir_uses_checkpoint_dir(spark):
    base = spark.sparkContext.getCheckpointDir() or scratch_dir(spark)
    assert scratch_dir(spark) == spark.sparkContext.getCheckpointDir() == base
    assert scratch_dir(spark, "x").startswith(base.rstrip("/") + "/")


def test_run_all_returns_every_result_and_raises():
    assert jobs.run_all({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    try:
        jobs.run_all({"a": lambda: 1, "b": lambda: 1 / 0})
    except ZeroDivisionError:
        pass
    else:
        raise AssertionError("failure not propagated")


def test_cluster_needs_a_shared_folder():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_slow_gold_stage_holds_up_only_its_users():
    import threading

    from gustolake.plans.gold import GoldTables

    tables, started, release = GoldTables({}, None), threading.Event(), threading.Event()

    def slow():
        started.set()
        assert release.wait(10)
        return "slow"

    t = threading.Thread(target=lambda: tables._once("a", slow))
    t.start()
    assert started.wait(10)
    assert tables._once("b", lambda: "quick") == "quick"
    release.set()
    t.join()
    assert tables._once("a", lambda: "again") == "slow"
