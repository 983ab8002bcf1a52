import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from aerolake.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app_name="aerolake-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    # Tests own the checkpoint folder only because none is configured here.
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture
def tmpdir_str(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
