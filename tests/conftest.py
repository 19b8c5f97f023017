import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    s = local_session(cores="*", shuffle_partitions=8)
    from tidemark.session import checkpoint_root

    # the configured shared folder, or (only when none is set) a local one
    checkpoint_root(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-t-")
