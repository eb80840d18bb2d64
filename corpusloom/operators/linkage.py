"""Record linkage: keys of titles, authors and institutions; candidate pairs in blocks; scores; one golden record a group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.components import components
from corpusloom.storage import materialize

#: Words that name keys leave out, and acronyms of institutions by their names.
LEFT_OUT = tuple("a o as os um uma de da do das dos e em no na para com the of".split())
ACRONYMS = {
    "universidade federal do piaui": "ufpi",
    "universidade federal do ceara": "ufc",
    "universidade de sao paulo": "usp",
    "universidade estadual de campinas": "unicamp",
    "universidade federal de minas gerais": "ufmg",
    "universidade federal do rio de janeiro": "ufrj",
    "universidade federal do rio grande do sul": "ufrgs",
    "universidade federal de pernambuco": "ufpe",
    "universidade federal da bahia": "ufba",
    "universidade estadual paulista": "unesp",
    "universidade federal de santa catarina": "ufsc",
    "universidade de brasilia": "unb",
    "universidade federal de sao paulo": "unifesp",
    "fundacao oswaldo cruz": "fiocruz",
}
#: Fields that a golden record takes from other members where its own are empty.
FILLED = ("url_landing", "url_binario", "identificador", "resumo", "programa", "ies", "area", "taxonomia", "tipo", "autor")


def _plain(text: Column) -> Column:
    return T.bare(F.coalesce(text, F.lit("")))


def _kept(words: Column) -> Column:
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*LEFT_OUT))


def title_key(title: Column) -> Column:
    return F.array_join(_kept(F.split(F.regexp_replace(_plain(title), "[^a-z0-9 ]+", " "), " +")), " ")


def author_key(author: Column) -> Column:
    """The name's words in order, so that both orders of a name are one key."""
    return F.array_join(F.array_sort(_kept(F.regexp_extract_all(_plain(author), F.lit("[a-z]+"), F.lit(0)))), " ")


def institution_key(name: Column, acronyms: dict[str, str] = ACRONYMS) -> Column:
    """A known acronym; else the name itself where it is short; else its initials."""
    flat = F.btrim(F.regexp_replace(_plain(name), "[^a-z]+", " "))
    tight = F.replace(flat, F.lit(" "), F.lit(""))
    initials = F.array_join(F.transform(F.filter(F.split(flat, " "), lambda w: (w != "") & ~w.isin(*LEFT_OUT)), lambda w: F.left(w, F.lit(1))), "")
    key = reduce(lambda a, kv: a.when(F.contains(flat, F.lit(kv[0])), F.lit(kv[1])), acronyms.items(), F.when(F.lit(False), F.lit("")))
    key = key.when(F.length(tight).between(2, 8), tight)
    return key.otherwise(F.when(initials != "", initials).otherwise(F.left(tight, F.lit(8))))


def block_key(title: Column) -> Column:
    """The first four words of a title's key."""
    return F.coalesce(F.nullif(F.array_join(F.slice(F.split(title_key(title), " "), 1, 4), " "), F.lit("")), F.lit("sem-titulo"))


def edit_similarity(a: Column, b: Column) -> Column:
    """One less the edit distance's share of the longer key; zero if either is empty."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when((a == "") | (b == "") | a.isNull() | b.isNull(), F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def sequence_similarity(a: Column, b: Column) -> Column:
    """The matching-blocks ratio of Python's difflib, in Arrow batches; zero if either is empty."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, p, q).ratio() if p and q else 0.0 for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def keyed(records: DataFrame, key: str) -> DataFrame:
    """(key, title, author, place, identifier, year, block): what pairs are made and scored of."""
    return records.select(
        F.col(key).alias("key"),
        title_key(F.col("titulo")).alias("title"),
        author_key(F.col("autor")).alias("author"),
        institution_key(F.col("ies")).alias("place"),
        F.coalesce("identificador", F.lit("")).alias("identifier"),
        F.col("ano").cast("int").alias("year"),
        block_key(F.col("titulo")).alias("block"),
    )


def candidate_pairs(keys: DataFrame, fewest: int = 2, most: int = 400) -> DataFrame:
    """(a, b), a < b: records of one block whose years are at most two apart, by way of the years around each.

    Blocks of more than ``most`` records have a key that tells nothing, and are left out, as the definition has it; those that
    remain bound the pairs by ``most`` times the rows. Records without a year meet each other.
    """
    years = F.when(F.col("year").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.sequence(F.col("year") - 1, F.col("year") + 1))
    filed = keys.select("key", "block", F.explode(years).alias("y")).withColumn("y", F.coalesce("y", F.lit(-1)))
    sizes = filed.groupBy("block", "y").agg(F.count(F.lit(1)).alias("n")).where(F.col("n").between(fewest, most)).drop("n")
    filed = filed.join(sizes, ["block", "y"])
    other = filed.select(F.col("key").alias("b"), "block", "y")
    return filed.withColumnRenamed("key", "a").join(other, ["block", "y"]).where("a < b").select("a", "b").distinct()


def scored_pairs(keys: DataFrame, pairs: DataFrame, similarity: Callable[[Column, Column], Column] = edit_similarity) -> DataFrame:
    """(a, b, score): 1 for equal identifiers, else 0.6 of the titles' likeness, 0.3 of the authors' and 0.1 for one institution."""
    side = lambda p: keys.select(*[F.col(c).alias(f"{p}_{c}") for c in ("key", "title", "author", "place", "identifier")])
    met = pairs.join(side("a"), F.col("a") == F.col("a_key")).join(side("b"), F.col("b") == F.col("b_key"))
    same = (F.col("a_identifier") != "") & (F.col("a_identifier") == F.col("b_identifier"))
    likeness = 0.6 * similarity(F.col("a_title"), F.col("b_title")) + 0.3 * similarity(F.col("a_author"), F.col("b_author")) + F.when(F.col("a_place") == F.col("b_place"), 0.1).otherwise(0.0)
    return met.select("a", "b", F.when(same, F.lit(1.0)).otherwise(likeness).alias("score"))


def golden(records: DataFrame, key: str, groups: DataFrame, filled: tuple[str, ...] = FILLED) -> DataFrame:
    """One record for each group (node, component): the best linked and longest described, its gaps filled from the others.

    The best has a file link, then a page link, an identifier, the longest abstract, and the smallest key. A gap takes the
    value of the first other member, by key, that has one. ``fontes`` lists the group's sources.
    """
    full = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    home = records.join(groups, records[key] == groups["node"], "left").withColumn("_group", F.coalesce("component", F.col(key))).drop("node", "component")
    rank = F.struct((~full("url_binario")).alias("a"), (~full("url_landing")).alias("b"), (~full("identificador")).alias("c"), (-F.length(F.coalesce("resumo", F.lit("")))).alias("d"), F.col(key).alias("e"))
    columns = [c for c in records.columns if c not in filled]
    best = F.min_by(F.struct(*columns, *filled), rank).alias("_best")
    spare = [F.min(F.when(full(c), F.struct(F.col(key).alias("k"), F.col(c).alias("v")))).alias(f"_spare_{c}") for c in filled]
    made = home.groupBy("_group").agg(best, *spare, F.array_sort(F.collect_set(F.coalesce("fonte", F.lit("?")))).alias("fontes"))
    value = lambda c: F.when(F.coalesce(F.col(f"_best.{c}"), F.lit("")) != "", F.col(f"_best.{c}")).otherwise(F.coalesce(F.col(f"_spare_{c}.v"), F.col(f"_best.{c}"))).alias(c)
    return made.select(*[F.col(f"_best.{c}").alias(c) for c in columns], *[value(c) for c in filled], "fontes", F.size("fontes").alias("n_fontes"))


def reconciled(records: DataFrame, key: str, merge: float = 0.90, review: float = 0.82, shown: int = 40, similarity: Callable[[Column, Column], Column] = edit_similarity) -> tuple[DataFrame, dict]:
    """One record for each work that sources describe, and metrics with at most ``shown`` accepted and borderline pairs."""
    keys = materialize(keyed(records, key), "keys")
    scores = materialize(scored_pairs(keys, candidate_pairs(keys), similarity), "scores")
    groups = components(scores.where(F.col("score") >= merge).select("a", "b"))
    merged = golden(records, key, groups)
    sample = lambda rows: [r.asDict() for r in rows.select("a", "b", F.round("score", 3).alias("score")).orderBy("a", "b").limit(shown).collect()]
    counts = merged.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("n_fontes") > 1).cast("long")).alias("multi")).first()
    metrics = {
        "records_in": records.count(),
        "records_out": counts.n,
        "groups_of_several_sources": counts.multi or 0,
        "pairs_compared": scores.count(),
        "accepted": sample(scores.where(F.col("score") >= merge)),
        "borderline": sample(scores.where((F.col("score") >= review) & (F.col("score") < merge))),
    }
    return merged, metrics


def stratum(columns: dict[str, Column]) -> Column:
    """A name of a stratum: institutions by key, years by band, anything else folded and cut; parts joined by a bar."""
    part = {
        "ies": institution_key,
        "ano": lambda c: F.coalesce(T.year_band(c), F.lit("sem-ano")),
        "ano_faixa": lambda c: F.coalesce(T.year_band(c), F.lit("sem-ano")),
    }
    other = lambda c: F.coalesce(F.nullif(F.left(_plain(c.cast("string")), F.lit(40)), F.lit("")), F.lit("?"))
    return F.concat_ws("|", *[part.get(name, other)(c) for name, c in columns.items()])
