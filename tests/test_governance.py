import datetime as dt

import pytest

from tidemark.functions.governance import MASKED_TEXT, masked_view, pii_columns, tag_pii


def _df(spark):
    df = spark.createDataFrame([("Ann", dt.date(1980, 5, 17), "X1"), (None, None, "X2")],
                               "first STRING, dob DATE, code STRING")
    return tag_pii(df, {"first": "FIRST_NAME", "dob": "DOB"})


def test_masking_by_role_and_type(spark):
    df = _df(spark)
    assert pii_columns(df) == {"first": "FIRST_NAME", "dob": "DOB"}
    masked = masked_view(df, roles=["ANALYST_ROLE"]).collect()
    assert [r.first for r in masked] == [MASKED_TEXT, MASKED_TEXT]  # NULL masks to the literal too
    assert [r.dob for r in masked] == [dt.date(1980, 1, 1), None]  # NULL date stays NULL
    assert [r.code for r in masked] == ["X1", "X2"]  # untagged column passes
    clear = masked_view(df, roles=["COMPLIANCE_ROLE"]).collect()
    assert clear[0].first == "Ann" and clear[0].dob == dt.date(1980, 5, 17)
    assert masked_view(df, roles=[]).collect()[0].first == MASKED_TEXT


def test_tag_vocabulary_is_closed(spark):
    with pytest.raises(ValueError):
        tag_pii(_df(spark), {"code": "SHOE_SIZE"})


def test_tags_survive_projection(spark):
    df = masked_view(_df(spark), roles=[]).select("first")
    assert pii_columns(df) == {"first": "FIRST_NAME"}
