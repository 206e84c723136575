"""The queries that have SQL, against DuckDB on the driver's small tables and on rows made for the cases these lack."""

import os

import duckdb
import pytest

from boutlens.llm import queries

SMALL = "/root/testdata/sf0.01"


def compared(spark, folder, name):
    got = queries.QUERIES[name](spark, folder)
    con = duckdb.connect()
    for t in os.listdir(folder):
        path = f"{folder}/{t}" if t.endswith(".parquet") and os.path.isfile(f"{folder}/{t}") else f"{folder}/{t}/*.parquet"
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    columns = sorted(got.columns)
    text = ", ".join(columns)
    expected = con.execute(f"SELECT {text} FROM ({queries.ORACLE[name]})").fetchall()
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(map(str, rows)) == sorted(map(str, expected))
    return got


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    df = compared(spark, SMALL, name)
    if name == "op8_tool_calls":
        rows = df.collect()
        assert max(r.level or 0 for r in rows) >= 3 and max(r.repeats for r in rows) > 1
        assert {"$.text: too long", "$.turn: too large"} <= {p for r in rows for p in (r.problems or "").split("; ")}


def test_urls_of_all_kinds_equal_the_sql(spark, tmp_path):
    urls = ["http://A.Example.ORG/es/x?porn", "https://www.example.org/en/12", "https://b.com/fr/", "http://spam-farm.net/x", "http://cheap.pills.net/", "http://cheap.net/cheap",
            "http://spammer.net/essex", None, "", "no scheme casino", "x://h#f", "HTTP://Host.net?q", "http://notexample.org/en/1", "http://x.net/adult-dating/sex", "://"]
    for folder, rows in (("some", urls + urls[:3]), ("none", [])):
        spark.createDataFrame(list(enumerate(rows)), "page_id long, url string").write.parquet(str(tmp_path / folder / "pages.parquet"))
        compared(spark, str(tmp_path / folder), "op7_url_filter")


def test_conversations_of_all_kinds_equal_the_sql(spark, tmp_path):
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "x" * 400), (1, 2, "assistant", "a\nb\nc"), (1, 3, "user", None), (1, 5, "user", "y\n\n\n\n" + "z" * 50), (1, 6, "assistant", None),
            (1, 9, "user", "w" * 50), (2, 0, "user", "no answer"), (2, 4, "assistant", "orphan \"quoted\" \\ é"), (3, 2, "system", "late"), (None, 0, "user", "x"), (4, None, "user", "x"),
            (1, 1, "user", "x" * 400), (5, 0, None, "x"), (6, 40, "user", "far " * 20), (6, 20, "user", "near " * 20), (6, 10, "user", "q " * 30), (6, 0, "user", "s " * 30)]
    for folder, some in (("some", rows), ("none", [])):
        spark.createDataFrame(some, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / folder / "conversations.parquet"))
        compared(spark, str(tmp_path / folder), "op8_tool_calls")
