import duckdb
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import line_dedup as L

SF = "/root/testdata/sf0.01"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_exact_line_stays_once(make_docs):
    docs = make_docs([f"own text number {'abcde'[i]} x{'abcde'[i]}y\nAll rights reserved by us." for i in range(5)])
    got = texts(L.dedup_lines(docs))
    assert got[0].endswith("All rights reserved by us.")
    assert all("reserved" not in got[i] and got[i].startswith("own text") for i in range(1, 5))


def test_digits_and_variable_fields_are_one_template(make_docs):
    names = ["ann", "bob", "cleo", "dan", "eve"]
    docs = make_docs([f"x{n}\nposted on day {i} by the user {n} of this site today" for i, n in enumerate(names)])
    got = texts(L.dedup_lines(docs))
    assert got[0] == f"x{names[0]}\nposted on day 0 by the user {names[0]} of this site today"
    assert [got[i] for i in range(1, 5)] == [f"x{n}" for n in names[1:]]


def test_unlike_lines_of_a_leaf_stay(make_docs):
    docs = make_docs(["the same start " + " ".join(f"{w}{c}" for c in "abcdef") for w in ("k", "l", "m", "n")])
    assert texts(L.dedup_lines(docs)) == texts(docs)


def test_many_times_in_one_document_is_not_across_documents(make_docs):
    docs = make_docs(["one line that comes again\n" * 9, "other words stand here now"])
    assert texts(L.dedup_lines(docs)) == texts(docs)
    table = "\n".join(f"row of the table has the name {c}x in it" for c in "abcdefgh")
    docs = make_docs([table, "nothing"])
    assert texts(L.dedup_lines(docs)) == texts(docs)


def test_odd_rows(spark, make_docs):
    boiler = "read the terms of use here"
    long = "\n".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)} word goes on" for i in range(9000))
    docs = make_docs([(1, None), (2, ""), (3, "\n \n"), (4, boiler), (4, boiler), (5, boiler), (6, f"{boiler}\n"),
                      (None, f"a b\n{boiler}"), (7, long + "\n" + boiler)])
    docs = docs.withColumn("n_lines", F.lit("clash")).withColumn("gone", F.lit(1)).withColumn("leaf", F.lit(2))
    out = L.dedup_lines(docs)
    got = sorted(((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()), key=str)
    assert got == sorted([(0, "a b", 2, 1), (1, None, 0, 0), (2, "", 1, 0), (3, "\n \n", 3, 0), (4, boiler, 1, 0),
                          (4, boiler, 1, 0), (5, "", 1, 1), (6, "", 2, 1), (7, long, 9001, 1)], key=str)
    assert L.dedup_lines(docs.where("false")).count() == 0
    assert L.stage(spark, docs, "").columns == docs.columns


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(L.SQL).fetchall())
    got = sorted(tuple(r) for r in L.query(spark, SF).collect())
    assert got == want
    assert sum(r[3] for r in got) > 100


def test_plan_is_native(spark):
    plan = L.query(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("seed", range(2))
def test_random_small_corpora_equal_sql(spark, make_docs, seed, tmp_path):
    import random
    rng = random.Random(seed)
    words = ["aa", "bb", "cc", "dd", "7", "e1"]
    docs = make_docs(["\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 7))) for _ in range(4))
                      for _ in range(60)])
    docs.select("doc_id", "text").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = sorted(tuple(r) for r in L.dedup_lines(docs.select("doc_id", "text")).collect())
    assert got == sorted(con.execute(L.SQL).fetchall())


def two_fields(n):
    """One template with two fields of recurring letter-only values, in ``n`` documents."""
    a, b = ([f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(30)] for w in ("user", "town"))
    return [f"the daily report for user {a[i % 30]} from {b[i // 30 % 30]} is ready" for i in range(n)]


@pytest.mark.parametrize("n", [5, 900, 100_000])
def test_stage_finds_recurring_field_values_at_every_size(spark, make_docs, n):
    docs = make_docs(two_fields(900 if n > 900 else n)).select("doc_id", "text", "n_chars")
    if n > 900:
        docs = spark.range(n).select((F.col("id") % 900).alias("doc_id"), "id").join(docs, "doc_id").select(
            F.col("id").alias("doc_id"), "text", "n_chars")
    for out in (L.stage(spark, docs, ""), L.dedup_lines(docs)):
        assert [(r["doc_id"], r["text"]) for r in out.where("text <> ''").collect()] == [(0, two_fields(1)[0])]


def test_sql_finds_recurring_field_values(make_docs, tmp_path):
    make_docs([t + "\nShare this" for t in two_fields(900)]).select("doc_id", "text").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    got = con.execute(L.SQL).fetchall()
    assert sorted(r[3] for r in got) == [0] + [2] * 899


def test_clashing_names_in_the_stage(spark, make_docs):
    docs = make_docs(["same line here\nx", "same line here\ny", "same line here\nz"])
    for name in ("_th", "_TH_", "n_lines", "n_dropped", "g"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    out = L.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert {tuple(r[c] for c in docs.columns[5:]) for r in out.collect()} == {tuple(f"own {c}" for c in docs.columns[5:])}
    assert texts(out) == {0: "same line here\nx", 1: "y", 2: "z"}


def test_stage_takes_lines_of_one_and_two_tokens(spark, make_docs):
    script = "这是一行没有空格的文字每个页面都有它"
    docs = make_docs([f"And ornd.\n{script}\nown{w}\npage {i}\n{i}" for i, w in enumerate(["ab", "cd", "ef", "gh"])])
    got = texts(L.stage(spark, docs, ""))
    assert got == {0: f"And ornd.\n{script}\nownab\npage 0\n0", 1: "owncd\npage 1\n1", 2: "ownef\npage 2\n2", 3: "owngh\npage 3\n3"}


def test_stage_takes_long_lines_from_the_second_document_on(spark, make_docs):
    long = " ".join(f"word{c}{d}" for c in "abcdefgh" for d in "1234567")
    script = "没有空格的很长的一行" * 12
    other = long.replace("worda1", "worda9")    # the same form, not the same line
    docs = make_docs([f"xa\n{long}\na short line of two", f"yb\n{long}\na short line of two\n{script}", f"zc\n{script}"])
    assert texts(L.stage(spark, docs, "")) == {0: f"xa\n{long}\na short line of two", 1: f"yb\na short line of two\n{script}", 2: "zc"}
    docs = make_docs([long, other, "nothing else"])
    assert texts(L.stage(spark, docs, "")) == texts(docs)
