"""Registered queries against their SQL twins. CHECK_ALL=1 runs every one, as check_oracle.py does."""

import os
import re

import pytest

import __spark_entry__ as entry_module
import check_oracle
from chatterlens.plans import catalog, oracle

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
SAMPLED = """p01_signal_summary s06_features_csv s10_sample_posts s12_json_codec r07_ingest_key r12_page_status
r14_unseen_cards r15_hashtag_quota r18_collect_posts n03_normalise_hashtags c01_unescape_html c03_nfkc c06_clean_text
c09_merge_tags c10_drop_empty d02_first_occurrence d03_new_posts f08_feature_matrix t07_vocabulary t09_document_scores
t12_top_keywords r18_run_counts c11_isolate_faults s12_json_files g08_label_by_hashtag g13_rolling_summary v01_posts_over_time v04_signal_histogram""".split()


def names():
    return list(catalog.queries()) if os.environ.get("CHECK_ALL") else SAMPLED


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no tables at {SF_DIR}")
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, duck, name):
    assert check_oracle.compare(spark, duck, name, SF_DIR) == ""


def test_every_query_has_a_twin():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry_module.queries())


def test_names():
    assert all(re.fullmatch(r"[a-z]\w+", n) and not re.match(r"op\d", n) for n in catalog.queries())


def test_every_document_and_page_becomes_a_post(spark, duck):
    from chatterlens.plans import views

    counts = {
        t: duck.sql(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in ("events", "documents", "pages")
    }
    copies = duck.sql("SELECT count(*) FROM events WHERE event_type = 'purchase'").fetchall()[0][0]
    assert views.posts(spark, SF_DIR).count() == sum(counts.values()) + copies


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 1 and rows[0].total_tweets > 0
