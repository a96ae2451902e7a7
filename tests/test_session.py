import os
from types import SimpleNamespace

import pytest

from twinrow.session import run_folder


def fake(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_named_folder_is_used():
    first, second = (run_folder(fake("hdfs:///shared/", "yarn"), "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError):
        run_folder(fake(None, "yarn"), "x")


def test_a_local_master_may_use_its_own():
    assert os.path.isdir(os.path.dirname(run_folder(fake(None, "local[4]"), "x")))
