import pytest

from riskspan import session
from riskspan.operators.filters import keyword_filter


def test_keyword_filter_rows(spark):
    rows = [(1, "Siemens PLC firmware"), (2, "no hit here"), (3, None),
            (4, "the scada gateway"), (5, "EMSx only")]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    got = {r.id: r.matched_keyword for r in keyword_filter(df, "text").collect()}
    assert got == {1: "PLC", 4: "scada"}


def test_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    assert session.is_local(spark)
    if spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    monkeypatch.setattr(session, "is_local", lambda s: False)
    with pytest.raises(ValueError):
        session.checkpoint_root(spark)
