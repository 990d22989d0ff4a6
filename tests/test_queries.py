"""Every core query against DuckDB on the smallest tables."""

import datetime
import math
from pathlib import Path

import pytest

from quillspark.plans import registry
from quillspark.sources.tables import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return "nan" if math.isnan(v) else round(float(v), 4)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, list) else v


def rows_of(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


#: Queries that SQL can't state, and the tests that compare their operators with brute force.
BRUTE_FORCE = {"a9_betweenness": "test_betweenness_against_all_paths", "u12_sampled_betweenness": "test_betweenness_against_all_paths", "a47_mann_whitney": "test_rank_tests_against_enumeration",
               "u2_logistic_regression": "test_logistic_regression_beats_chance", "j2_fuzzy_titles": "test_merge", "s14_vocabulary_match": "test_vocabulary_against_brute_force", "s39_longest_runs": "test_longest_run_and_versions",
               "st8_backfill": "test_backfill_is_whole_and_resumes", "w5_growing_archive": "test_growing_archive_matches_a_loop_over_days", "w9_window_stability": "test_window_stability",
               "j9_reference_base": "test_reference_base_and_index_add_unclaimed_raw_works", "j10_whole_index": "test_reference_base_and_index_add_unclaimed_raw_works"}


def test_logistic_regression_beats_chance(spark):
    r = registry.queries()["u2_logistic_regression"](spark, FOLDER).first()
    assert r["tested"] > 0 and 0.5 < r["auc"] <= 1 and 0 < r["accuracy"] <= 1


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = rows_of([r[c] for c in cols] for r in df.collect())
    if name not in registry.oracle_sql():
        assert name in BRUTE_FORCE and cols and all(len(r) == len(cols) for r in got)
        return
    q = duck.execute(registry.oracle_sql()[name])
    names = [x[0] for x in q.description]
    want = rows_of([r[names.index(c)] for c in cols] for r in q.fetchall())
    assert sorted(names) == cols and len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 2e-4 * max(1, abs(x)) for x, y in zip(a, b)), (a, b)
