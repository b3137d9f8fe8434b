from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from searchtide.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    from searchtide.sources.testtables import raw_events

    return raw_events(spark, SMALL)


@pytest.fixture(scope="session")
def curated_path(spark, raw, tmp_path_factory):
    from searchtide.plans.curation_job import run_curation
    from searchtide.sources.raw import write_raw
    from searchtide.sources.testtables import TEST_RULES

    base = tmp_path_factory.mktemp("lake")
    write_raw(raw, f"{base}/landing")
    run_curation(spark, f"{base}/landing", f"{base}/curated", rules=TEST_RULES, run_id="fixture")
    return f"{base}/curated"


@pytest.fixture(scope="session")
def curated_rows(spark, curated_path):
    from searchtide.sources.curated import read_curated

    return read_curated(spark, curated_path)
