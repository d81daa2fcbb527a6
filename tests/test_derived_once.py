"""Jobs of the catalogue derive their input files once, however often they are read."""

import os

import pytest

from firmweave.catalog import registry_queries
from tests.support import SF_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_json_job_reads_its_sources_from_what_was_written(spark, monkeypatch):
    read, write = [], registry_queries.write_json_arrays

    def noted(rows, uri, **settings):
        read.extend(rows.inputFiles())
        write(rows, uri, **settings)

    monkeypatch.setattr(registry_queries, "write_json_arrays", noted)
    assert registry_queries.etl_job_json(spark, SF_DIR).count() > 0
    assert read and not [f for f in read if SF_DIR in f]


@pytest.mark.parametrize("name", ["etl_job_append", "etl_job_retried"])
def test_repeated_runs_share_their_input(spark, monkeypatch, name):
    calls, make = [], registry_queries.source_files
    monkeypatch.setattr(registry_queries, "source_files", lambda *a: calls.append(a) or make(*a))
    assert getattr(registry_queries, name)(spark, SF_DIR).count() > 0
    assert len(calls) == 1
