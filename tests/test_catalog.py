import duckdb
import numpy as np
import pytest

from corpusloom.operators import corpus
from corpusloom.operators.components import components
from corpusloom.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    df = catalog.queries()[name](spark, DIR)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    rel = con.sql(catalog.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    at = [rel.columns.index(c) for c in sorted(df.columns)]
    assert got == sorted(tuple(str(r[i]) for i in at) for r in rel.fetchall())


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, k) for k in range(101, 120)] + [(7, 7), (3, 2)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 120)}


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fuzzy_components_equal_brute_force(spark):
    rng = np.random.default_rng(14)
    rows = [(0, ""), (1, None), (2, "..."), (3, "One, two!"), (4, "one two")]
    for family in range(60):
        base = [f"w{k}" for k in rng.integers(0, 3000, 200)]
        for changes in (0, 2, 4, 5):  # shares about 0.9 to 0.77 of the first
            words = list(base)
            for at in rng.choice(200, changes, replace=False):
                words[at] = f"v{family}x{at}"
            rows.append((len(rows), ", ".join(words)))
    sets, home = {}, {}
    for i, text in rows:
        w = (text or "").lower().replace(",", "").replace("!", "").replace(".", "").split()
        if w:
            sets[i], home[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}, i
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                x, y = sorted((home[i], home[j]))
                home = {k: x if v == y else v for k, v in home.items()}
    many = {v for k, v in home.items() if k != v}
    got = corpus.fuzzy_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.node: r.component for r in got} == {k: v for k, v in home.items() if v in many} and len(got) > 100
