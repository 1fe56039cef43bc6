import threading

import pytest

from rankloom import session


def test_scopes_belong_to_their_thread(spark):
    kept, opened, closed = {}, threading.Event(), threading.Event()

    def other():
        with session.scratch_scope(spark):
            kept["table"] = session.materialize(spark.range(3))
            opened.set()
            closed.wait(60)
            kept["count"] = kept["table"].count()

    with session.scratch_scope(spark):
        worker = threading.Thread(target=other)
        worker.start()
        opened.wait(60)
        session.materialize(spark.range(2))
    closed.set()
    worker.join()
    assert kept["count"] == 3


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
