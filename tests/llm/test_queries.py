"""The registered problem queries over the smallest data."""

import pytest

SCHEMAS = {
    "p1_found": [("rec_id_first", "bigint"), ("rec_id_dup", "bigint")],
    "p2_found": [("rec_id", "bigint"), ("field_name", "string")],
    "p3_found": [("rec_id", "bigint"), ("cause_num", "string")],
    "p4_found": [("name_id_a", "bigint"), ("name_id_b", "bigint")],
    "p6_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p7_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p8_found": [("doc_id", "bigint"), ("seg_no", "int"), ("lang", "string")],
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_columns_and_keys(spark, data, name):
    from lexmill.llm.queries import QUERIES

    df = QUERIES[name](spark, data).cache()
    assert df.dtypes == SCHEMAS[name]
    keys = [c for c, t in SCHEMAS[name] if t != "array<int>" and not (name == "p8_found" and c == "lang")]
    assert df.count() > 0 and df.select(*keys).distinct().count() == df.count()
    df.unpersist()
