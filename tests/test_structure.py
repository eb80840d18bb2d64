import pytest
from pyspark.sql import functions as F

from corpusloom.operators import structure as S
from corpusloom.operators.corpus import one_each
from corpusloom.sources import records as R
from corpusloom.streaming.ingest import file_stream, ingest


def test_body_is_cut_at_both_ends(spark):
    text = "cover\nABSTRACT\n" + "middle line\n" * 20 + "REFERENCES\nsomebody, 1999"
    rows = [(1, text), (2, "no headings\nat all"), (3, ""), (4, None), (5, "a\n" * 20 + "ABSTRACT\nlate")]
    got = dict(spark.createDataFrame(rows, "k long, t string").select("k", S.body(F.col("t"), "ABSTRACT", "REFERENCES")).collect())
    assert got[1].startswith("ABSTRACT\nmiddle") and got[1].endswith("middle line")
    assert got[2] == rows[1][1] and got[3] == "" and got[4] is None and got[5].startswith("a\na")


def test_page_edges(spark):
    rows = [(1, p, f"Journal of Things\nbody {p} text\nmore {p}\nlast {p}\nPage foot") for p in range(5)] + [(2, p, "Same\nx") for p in range(3)] + [(3, 1, None)]
    got = S.page_edges(spark.createDataFrame(rows, "d long, p long, t string"), "d", "p", "t").collect()
    assert sorted((r.d, r.line, r.n_pages) for r in got) == [(1, "Journal of Things", 5), (1, "Page foot", 5)]


def test_gate_reaches_nested_strings(spark):
    row = [("x", ["a@b.org", None], {"k": "c@d.org e@f.org"}, ("g@h.org", 3)), (None, None, None, None)]
    df = spark.createDataFrame(row, "plain string, list array<string>, map map<string,string>, one struct<a string, n int>")
    hits = S.gate_hits(df, "made")
    assert {(r.path, r.detector): r.hits for r in hits.collect()} == {("list[]", "email"): 1, ("map{}", "email"): 2, ("one.a", "email"): 1}
    with pytest.raises(ValueError):
        S.require_clean(hits)
    S.require_clean(S.gate_hits(df.limit(0), "made"))


def test_windows_halves_and_kinds(spark):
    bounds = spark.sql("select date'2024-01-01' low, date'2024-01-10' high")
    w = R.date_windows(bounds, 7)
    assert [(str(r.first_day), str(r.last_day)) for r in w.orderBy("position").collect()] == [("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-10")]
    days = R.halved(R.halved(R.halved(R.halved(w)))).collect()
    assert sorted(str(r.first_day) for r in days) == [f"2024-01-{d:02}" for d in range(1, 11)] and all(r.first_day == r.last_day for r in days)
    files = spark.createDataFrame([(b"%PDF-1.4",), (b"PK\x03\x04..",), (b" \n<html>",), (b"text",), (b"",), (None,)], "c binary")
    assert [r[0] for r in files.select(R.file_kind(F.col("c"))).collect()] == ["pdf", "zip", "html", "desconhecido", "desconhecido", None]


def test_json_lines_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"k": 1, "v": "x"}\n\n{"k": 2, "v": "y"}\n{"k": 2, "v": "y"}\n')
    assert R.read_jsonl(spark, str(folder / "a.json"), "k long, v string").count() == 3
    assert R.read_jsonl(spark, str(folder / "none.json"), "k long, v string").count() == 0
    take = lambda: sorted(tuple(r) for r in ingest(file_stream(spark, str(folder), "k long, v string"), str(tmp_path / "t"), ["k"], str(tmp_path / "s")).collect())
    assert take() == [(1, "x"), (2, "y")]
    (folder / "b.json").write_text('{"k": 2, "v": "again"}\n{"k": 3, "v": "z"}\n')
    assert take() == [(1, "x"), (2, "y"), (3, "z")]
    R.write_jsonl(R.read_jsonl(spark, str(folder / "a.json"), "k long, v string"), str(tmp_path / "out"), per_file=2)
    assert R.read_jsonl(spark, str(tmp_path / "out"), "k long, v string").count() == 3


def test_one_row_of_a_key_whatever_the_order(spark):
    rows = [(1, "a", None), (1, "b", 2), (1, "b", 2), (None, "c", 3), (None, None, None), (2, "d", 4)]
    take = lambda r: sorted(map(tuple, one_each(spark.createDataFrame(r, "k long, v string, n int").repartition(3), ["k"]).collect()), key=repr)
    got = take(rows)
    assert got == take(rows[::-1]) and len(got) == 3 and set(got) <= set(rows)
    assert take(rows[:0]) == []
