from __future__ import annotations

import os
import sys
import tempfile

import pytest
from helpers import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from faultline.session import build_session

    scratch = tempfile.mkdtemp(prefix="faultline-tests-")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def layers_small(spark):
    from faultline.plans.pipeline import Layers

    return Layers(spark, SF_SMALL)
