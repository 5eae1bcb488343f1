import os

import pytest

from orderlens.sources import staging as st


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    """Only what shared_folder asks of a session."""

    def __init__(self, master, **conf):
        self.conf = _Conf({k.replace("__", "."): v for k, v in conf.items()})
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_named_folder_wins():
    session = _Session("spark://a:1", spark__checkpoint__dir="s3a://bucket/x/", spark__sql__warehouse__dir="/w")
    assert st.shared_folder(session) == "s3a://bucket/x"


def test_cluster_without_a_shared_folder_raises(monkeypatch):
    monkeypatch.setattr(st, "_scheme", lambda session, path: "file")
    for warehouse in ("/opt/w", "file:/opt/w"):
        with pytest.raises(ValueError):
            st.shared_folder(_Session("local-cluster[2,1,1024]", spark__sql__warehouse__dir=warehouse))


def test_a_warehouse_in_a_shared_file_system_will_do(monkeypatch):
    monkeypatch.setattr(st, "_scheme", lambda session, path: "hdfs")  # a path without a scheme lies in the default file system
    assert st.shared_folder(_Session("spark://a:1", spark__sql__warehouse__dir="/warehouse")) == "/warehouse/_staged"


def test_schemes_are_those_of_the_file_system(spark):
    assert st._scheme(spark, "/opt/w") == "file" == st._scheme(spark, "file:/opt/w")


def test_local_session_uses_the_warehouse():
    assert st.shared_folder(_Session("local[2]", spark__sql__warehouse__dir="/w")) == "/w/_staged"


def test_staging_leaves_nothing_behind(spark):
    folder = os.path.join(st.shared_folder(spark), "orderlens")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with st.staging(spark):
        kept = st.staged(spark.range(10), "probe")
        assert kept.count() == 10
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before
