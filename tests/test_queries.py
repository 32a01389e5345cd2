"""Registered queries against their SQL; ``ALL_QUERIES=1`` checks every one."""

import os

import pytest
from oracle import compare, duck

from asterion.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"
CORE = ["discovery_tracklets", "load_discoveries", "yearly_breakdown", "or_key_join", "alias_semi_join", "unmatched_list_entries", "station_discovery_profile",
        "station_report", "obs_summary", "object_catalog", "boxscore", "project_rollup", "size_completeness", "membership_wide", "disagreement_matrix",
        "collapse_simulation", "alias_report", "apparition_reach", "pairwise_codetection", "response_curve", "segment_arcs_wrapped", "nearest_in_time",
        "solar_elongation_histogram", "eclipse_overlap", "moon_position", "null_rates", "percentiles_disc", "snapshot_fingerprint", "cross_match_lists",
        "time_on_page", "parse_mpcorb", "parse_circulars", "parse_year_blocks", "decode_obs80", "psv_lines", "canonicalize", "stream_known_set"]


@pytest.fixture(scope="module")
def con():
    return duck(DIR)


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES) and set(CORE) <= set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("ALL_QUERIES") else CORE)
def test_query_matches_its_sql(spark, con, name):
    problem, _ = compare(spark, con, QUERIES[name], ORACLES.get(name), DIR)
    assert problem is None
