"""Parts of a text that repeat or frame it: page edges, front and back matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T


def page_edges(pages: DataFrame, document: str, page: str, text: str, edge: int = 2, share: float = 0.6, least: int = 3, fewest_pages: int = 4) -> DataFrame:
    """(document, line, n_pages): lines of 3 to 120 characters at the first or last ``edge`` lines of enough of a document's pages.

    Enough is ``share`` of its pages rounded down, and ``least`` at least; documents of fewer than ``fewest_pages`` have none.
    """
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x)), lambda x: x != "")
    df = pages.select(document, page, lines.alias("l"))
    ends = F.array_distinct(F.concat(F.slice("l", 1, edge), F.when(F.size("l") > edge, F.slice("l", F.greatest(F.size("l") - edge + 1, F.lit(1)), edge)).otherwise(F.array().cast("array<string>"))))
    seen = df.select(document, page, F.explode(ends).alias("line")).where(F.length("line").between(3, 120)).distinct()
    seen = seen.groupBy(document, "line").agg(F.count(F.lit(1)).alias("n_pages"))
    n = pages.groupBy(document).agg(F.count_distinct(page).alias("_pages")).where(F.col("_pages") >= fewest_pages)
    return seen.join(n, document).where(F.col("n_pages") >= F.greatest(F.floor(F.col("_pages") * share), F.lit(least))).select(document, "line", "n_pages")


def body(text: Column, front: str, back: str, front_within: float = 0.30, back_after: float = 0.45) -> Column:
    """Text from the first line that fits ``front``, if early enough, to the last line that fits ``back``, if late enough.

    Patterns match a whole line. Without such lines nothing is cut.
    """
    n = F.length(text)

    def step(seen: Column, line: Column) -> Column:
        at = seen["at"]
        opens = F.when(line.rlike(f"^(?:{front})$") & (at < n * front_within), at)
        closes = F.when(line.rlike(f"^(?:{back})$") & (at >= n * back_after), at)
        return F.struct((at + F.length(line) + 1).alias("at"), F.coalesce(seen["first"], opens).alias("first"), F.coalesce(closes, seen["last"]).alias("last"))

    nowhere = F.lit(None).cast("int")
    found = F.aggregate(F.split(text, "\n"), F.struct(F.lit(0).alias("at"), nowhere.alias("first"), nowhere.alias("last")), step)
    begin, end = F.coalesce(found["first"], F.lit(0)), F.coalesce(found["last"], n)
    return F.btrim(F.substring(text, begin + 1, end - begin), F.lit(" \t\r\n"))


#: Detectors of the gate: patterns that two engines read alike.
DETECTORS = {
    "email": T.EMAIL,
    "ipv4": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "card": r"\b[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}\b",
    "phone": r"\+[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{3,5}[ -]?[0-9]{3,5}\b",
}


def string_leaves(df: DataFrame, leave_out: tuple[str, ...] = ()) -> list[tuple[str, Column]]:
    """(path, array of strings) of every string in a table, however nested, by its schema."""

    def walk(kind, column: Column, path: str):
        name = kind.typeName()
        if name == "string":
            yield path, F.array(column)
        elif name == "struct":
            for f in kind.fields:
                yield from walk(f.dataType, column[f.name], f"{path}.{f.name}")
        elif name == "map":
            yield from spread(kind.keyType, F.map_keys(column), f"{path}{{keys}}")
            yield from spread(kind.valueType, F.map_values(column), f"{path}{{}}")
        elif name == "array":
            yield from spread(kind.elementType, column, f"{path}[]")

    def spread(kind, column: Column, path: str):
        for inner, _ in walk(kind, F.lit(None), path):
            yield inner, F.flatten(F.transform(column, leaf_of(kind, path, inner)))

    def leaf_of(kind, path: str, inner: str):
        return lambda x: F.flatten(F.array(*[c for p, c in walk(kind, x, path) if p == inner]))

    return [leaf for f in df.schema.fields if f.name not in leave_out for leaf in walk(f.dataType, F.col(f"`{f.name}`"), f.name)]


def _matches(strings: Column, pattern: str) -> Column:
    return F.aggregate(strings, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.regexp_count(x, F.lit(pattern)), F.lit(0)))


def gate_hits(df: DataFrame, product: str, detectors: dict[str, str] = DETECTORS, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """(product, path, detector, hits) over every string of a table, in one pass; only hits above zero."""
    counts = []
    for path, column in string_leaves(df, leave_out):
        for name, pattern in detectors.items():
            found = _matches(column, pattern)
            counts.append(F.struct(F.lit(path).alias("path"), F.lit(name).alias("detector"), F.coalesce(F.sum(F.coalesce(found, F.lit(0))), F.lit(0)).alias("hits")))
    if not counts:
        return df.sparkSession.createDataFrame([], "product string, path string, detector string, hits long")
    return df.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).where("c.hits > 0").select(F.lit(product).alias("product"), "c.*")


def require_clean(hits: DataFrame) -> None:
    """Stops a run whose products still hold personal data. ``hits`` has one row for each column and detector."""
    found = hits.collect()
    if found:
        raise ValueError("personal data left: " + "; ".join(f"{r.product}.{r.path} {r.detector} {r.hits}" for r in found))
