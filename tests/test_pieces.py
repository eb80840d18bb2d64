import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.functions import pii
from corpusloom.functions.pieces import pieces
from corpusloom.operators import processed
from corpusloom.operators import tokens as K


def test_pieces_keep_order_and_bounds():
    for column in (pa.array(["ab" * 50, None, "", "x" * 900] * 700), pa.array([[1] * 100, None, [], [2] * 900] * 700, type=pa.list_(pa.int32()))):
        cut = list(pieces(column, 2000, 64))
        assert pa.concat_arrays(cut).equals(column) and max(map(len, cut)) <= 64
        assert all(len(p) == 1 or sum(len(v or ()) for v in p.to_pylist()) <= 2000 for p in cut)
    assert [len(p) for p in pieces(pa.array(["x" * 50, "y", "z" * 50]), 10)] == [1, 1, 1]
    assert list(pieces(pa.array([], type=pa.string()))) == []


def test_tokens_are_made_text_by_text():
    class Slow:
        def encode(self, text, add_special_tokens):  # one text, never a batch of them
            assert isinstance(text, str) and not add_special_tokens
            return type("E", (), {"ids": [len(text)] * 3})

    got = list(K._ids_of(iter([pa.array(["ab", None] * 1000), pa.array(["c"])]), Slow()))
    assert max(map(len, got)) <= 512 and pa.concat_arrays(got).to_pylist() == [[2] * 3, [0] * 3] * 1000 + [[1] * 3]


def test_round_trip_of_odd_texts(spark):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(0, None), (1, ""), (2, "a<|endoftext|>b"), (3, "ação 漢字 🙂 \r\n  x")] + [(k, f"row {k} of many") for k in range(4, 1200)]
    df = spark.createDataFrame(rows, "k int, t string").coalesce(1).withColumn("ids", K.encoded(F.col("t"), path))
    got = {r.k: (r.ids, r.back) for r in df.withColumn("back", K.decoded(F.col("ids"), path)).collect()}
    assert got[0] == ([], "") and got[1] == ([], "") and 50256 in got[2][0]
    assert all(got[k][1] == (t or "") for k, t in rows)


def test_personal_data_comes_in_pieces():
    texts = ["Ana a@b.org, CPF 529.982.247-25", None, ""] * 700
    got = list(pii._personal(iter([pa.array(texts)]), None, "mask", None, 90_000))
    assert max(map(len, got)) <= 512
    rows = pa.chunked_array(got).to_pylist()
    assert rows[0]["text"] == "Ana [EMAIL], CPF [CPF]" and dict(rows[0]["counts"]) == {"EMAIL": 1, "CPF": 1} and rows[1]["text"] is None and rows[2]["counts"] == []


def test_findings_are_looked_for_once(spark):
    df = spark.createDataFrame([(1, "a@b.org"), (2, None), (3, "none")], "doc_id int, t string").select("doc_id", pii.personal(F.col("t")).alias("texto"))
    found = processed.findings(df, ("texto",))
    assert [(r.doc_id, r.campo, r.tipo) for r in found.collect()] == [(1, "texto", "EMAIL")]
    assert found.groupBy("tipo").count()._jdf.queryExecution().sparkPlan().toString().count("ArrowEvalPython") == 1
