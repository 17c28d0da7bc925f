from concurrent.futures import ThreadPoolExecutor

import pytest

from loomwright import session
from loomwright.paths import shared_dir
from loomwright.session import fit_shuffle, own_session


def test_shuffle_partitions_only_grow(spark, monkeypatch):
    before = spark.conf.get(session.SHUFFLE_PARTITIONS)
    df = spark.range(100_000)
    try:
        fit_shuffle(df)
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == before
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 10_000)
        fit_shuffle(df)
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == "81"
        fit_shuffle(spark.createDataFrame([(1,)], "a int"))
        fit_shuffle(spark.range(10))
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == "81"
        fit_shuffle(spark.range(10_000_000))
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == "8001"
    finally:
        spark.conf.set(session.SHUFFLE_PARTITIONS, before)


class Session:
    """As much of a session as the choice of the folder looks at."""

    def __init__(self, master, named=None):
        self.sparkContext = self
        self.conf = self
        self.master = master
        self.named = named
        self.chosen = None

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_shared_folder_is_the_one_the_session_names(spark):
    session = Session("yarn", "s3a://bucket/shared/")
    a, b = shared_dir(session, "x"), shared_dir(session, "x")
    assert a.startswith("s3a://bucket/shared/x-") and a != b
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_no_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"), "x")
    local = Session("local[2]")
    assert shared_dir(local, "x").startswith(f"{local.chosen}/x-")


def test_threads_never_lower_the_shuffle(spark, monkeypatch):
    before = spark.conf.get(session.SHUFFLE_PARTITIONS)
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 10_000)
    sizes = [10_000, 400_000, 20_000, 50_000] * 4
    try:
        with ThreadPoolExecutor(8) as pool:
            list(pool.map(lambda n: fit_shuffle(spark.range(n)), sizes))
        assert spark.conf.get(session.SHUFFLE_PARTITIONS) == "321"
    finally:
        spark.conf.set(session.SHUFFLE_PARTITIONS, before)


def test_a_session_of_its_own(spark):
    spark.conf.set("spark.sql.files.openCostInBytes", "123")
    try:
        own = own_session(spark)
        assert own.conf.get("spark.sql.files.openCostInBytes") == "123"
        own.conf.set("spark.sql.files.openCostInBytes", "456")
        assert spark.conf.get("spark.sql.files.openCostInBytes") == "123"
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
