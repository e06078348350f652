import pytest

from cohort_engine import session


class _Context:
    def __init__(self, master, real):
        self.master, self._real = master, real

    def __getattr__(self, name):
        return getattr(self._real, name)

    def getConf(self):
        class Conf:
            def get(self, _):
                return None

        return Conf()


class _Session:
    def __init__(self, master, warehouse, real):
        self.sparkContext = _Context(master, real.sparkContext)
        self._values = {"spark.sql.warehouse.dir": warehouse}

        class Conf:
            def get(_, key, default=None):
                return self._values.get(key, default)

        self.conf = Conf()


def test_no_local_scratch_folder_off_one_machine(spark, tmp_path):
    for warehouse in (f"file:{tmp_path}", str(tmp_path), f"file://{tmp_path}"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_dir(_Session("spark://host:7077", warehouse, spark), "x")
        with pytest.raises(ValueError):
            session.scratch_dir(_Session("local-cluster[2,1,1024]", warehouse, spark), "x")
    for master in ("local", "local[4]", "local[*]"):
        path = session.scratch_dir(_Session(master, f"file:{tmp_path}", spark), "x")
        assert path.startswith(f"file:{tmp_path}/scratch-")


def test_checkpoint_folder_first(spark):
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(folder)
