"""A sample of registered queries against their DuckDB oracle at sf 0.001 (the full set
runs with ``python tools/check_oracle.py``)."""
import pytest

from caresight.testing import compare

SF = "/root/testdata/sf0.001"
SAMPLE = ["cost_by_area_modality", "cost_by_body_area", "oncology_final", "alert_statistics",
          "response_buckets", "action_completion", "action_completion_filtered", "split_param", "string_split",
          "first_matching_diagnosis", "any_column_in_set", "not_in_null_aware", "quality_pivot", "float_label", "date_diff_units", "alert_report",
          "split_param_sql", "string_split_sql", "split_join_sql", "published_report", "catalog_report", "role_scope_strict", "first_read_converted"]


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, name):
    ok, msg = compare(spark, SF, name)
    assert ok, msg
