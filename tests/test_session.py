"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from edaphon.session import fresh_path, shared_dir


def session(master: str, setting: str | None = None, checkpoint: str | None = None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: setting),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
    )


def test_the_setting_decides():
    assert shared_dir(session("spark://x", "s3://b/c/")) == "s3://b/c"
    assert shared_dir(session("spark://x", None, "hdfs://d")) == "hdfs://d"
    assert fresh_path(session("spark://x", "s3://b"), "t").startswith("s3://b/edaphon/t-")


def test_only_a_local_session_may_leave_it_unset():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
