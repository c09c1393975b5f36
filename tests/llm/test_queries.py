"""Every registered query on the given tables: its columns, and its SQL where there is one."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, differences  # noqa: E402

from starquay.llm.queries import ORACLE, QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_decontaminate": "doc_id item_id",
    "op2_main_text": "page_id url text n_chars",
    "op3_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_language_mixture": "doc_id held_out lang_pred score",
    "op5_mix_sources": "doc_id mix_source mix_slot",
    "op6_backoff_scores": "doc_id n_words log_score",
    "op7_line_quality": "doc_id held_out score predicted",
    "op8_fuzzy_passages": "doc_id source_id start_word end_word",
    "op9_jaccard_join": "doc_id n_shingles component_id",
    "op10_nearest": "query_id rank vec_id score",
    "op11_collocations": "lang rank phrase a l r n score",
    "op12_importance_draw": "doc_id n_features weight score rank",
    "op13_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_one_query_per_operator():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    wanted = COLUMNS[name].split()
    assert df.columns[: len(wanted)] == wanted or set(wanted) <= set(df.columns)
    if name in ORACLE:
        assert differences(df, connect(SF_DIR), ORACLE[name]) == []
    else:
        assert df.count() >= 0
