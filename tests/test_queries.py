"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from tests import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    good, note = compare.compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert good, note


def test_entry(spark):
    assert entry.entry(spark).columns == ["year", "event_category", "events", "total_cost"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


SHUFFLED = [
    "unified_fact", "dedup_star", "corpus", "validations", "star_denormalise", "fact_lookup_inner_left",
    "repoint_facts", "provider_counts", "keyword_match", "profile_match", "hybrid_coverage",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_when_nothing_can_be_broadcast(spark, con, no_broadcast, shuffled_tables, name):
    good, note = compare.compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert good, note


@pytest.fixture(scope="module")
def shuffled_tables():
    """Builds the stored tables anew, so that they too are made without broadcasts."""
    from wardstar.plans import standins

    kept = dict(standins._built)
    standins._built.clear()
    yield
    standins._built.clear()
    standins._built.update(kept)
