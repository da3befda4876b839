import duckdb
import pytest

from tablekit.llm.chat_perspectives import ROTATE_SQL, rotate
from tablekit.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_three_speakers_take_turns_as_assistant(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "ann", "a"), (1, 2, "bob", "b"), (1, 3, "cy", "c")], SCHEMA)
    out = rotate(df).collect()
    assert len(out) == 12
    for who in ("ann", "bob", "cy"):
        own = sorted((r for r in out if r.perspective == who), key=lambda r: r.turn)
        assert [r.chat_role for r in own] == ["system"] + ["assistant" if r.speaker == who else "user" for r in own[1:]]
        assert [r.trained for r in own] == [r.speaker == who for r in own]
        for r in own:
            assert r.name == ("" if r.chat_role != "user" else r.speaker)
            if r.trained:
                body = r.segment[r.mask_start:r.mask_end]
                assert body.endswith("<|im_end|>") and body.removesuffix("<|im_end|>") == {"ann": "a", "bob": "b", "cy": "c"}[who]
            else:
                assert r.mask_start is None and r.mask_end is None


ODD = [(1, 0, "ann", None), (1, None, "bob", ""), (1, 1, None, "x"), (None, 0, "ann", "n"), (None, 1, "bob", "m"),
       (2, 0, "system", "only"), (3, 0, "", "empty name"), (3, 0, "ann", "t"), (3, 0, "ann", "t"),
       (4, 0, "a<|im_end|>", "<|im_start|>assistant"), (5, 0, "user", "é" * 200_000), (None, None, None, None)]


def test_odd_rows_match_sql(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", ODD)
    assert rows_of(rotate(df)) == sorted(con.sql(ROTATE_SQL).fetchall(), key=repr)
    segments = [r.segment for r in rotate(df).collect()]
    assert all(s.count("<|im_start|>") == 1 and s.count("<|im_end|>") == 1 for s in segments)


def test_empty_table_and_extra_columns(spark):
    assert rotate(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, 0, "ann", "a", "p", "n", True)], SCHEMA + ", perspective string, name string, trained boolean")
    assert [r.perspective for r in rotate(df).collect()] == ["ann"]


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    assert rows_of(rotate(table(spark, sf, "conversations"))) == sorted(con.sql(ROTATE_SQL).fetchall(), key=repr)
