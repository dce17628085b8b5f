import __spark_entry__ as E
from tests.conftest import SF


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert sorted(df.columns) == sorted(["doc_id", "label", "model", "n_tokens", "p_spam", "p_ham", "raw_prediction",
                          "prediction", "confidence", "is_confident"])


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_some_queries_run(spark):
    q = E.queries()
    for name in ("F9_tokens", "W4_split_assignment", "J9_A29_M8_sender_boost", "A20_U1_composition"):
        assert q[name](spark, SF).count() > 0
