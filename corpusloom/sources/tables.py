"""Tables of candidates: text files of unknown encoding and separator, columns by many names, the inventory's filters."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.inventory import capped

ENCODINGS = ("utf-8", "latin-1", "cp1252")
SEPARATORS = (";", ",", "\t")
#: Fields of a public graduate census and the column names they go by, the surest first.
CENSUS = {
    "titulo": ["^nm_producao$", "titulo", "^ds_titulo"],
    "autor": ["^nm_discente$", "^nm_autor$", "autor"],
    "ano": ["^an_base$", "^nr_ano", "ano.*(base|defesa)", "^dt_.*defesa"],
    "ies": ["^nm_entidade_ensino$", "^nm_ies$", "entidade.*ensino", "^sg_entidade"],
    "programa": ["^nm_programa", "programa"],
    "area_avaliacao": ["^nm_area_avaliacao$", "area.*avaliacao"],
    "area_conhecimento": ["^nm_area_conhecimento$", "area.*conhecimento"],
    "grande_area": ["^nm_grande_area", "grande.*area"],
    "tipo": ["^nm_grau_academico$", "^ds_grau", "grau.*academico", "^nm_producao_tipo"],
    "resumo": ["^ds_resumo$", "resumo"],
    "palavras_chave": ["^ds_palavra_chave$", "palavra.*chave"],
    "paginas": ["^nr_paginas$", "paginas"],
    "uf": ["^sg_uf", "^nm_uf"],
    "regiao": ["^nm_regiao", "^nm_grande_regiao"],
}
#: An inventory candidate.
CANDIDATE = """fonte string, chave_origem string, titulo string, autor string, ano int, ies string, programa string, area string, taxonomia string,
tipo string, idioma string, identificador string, endpoint string, url_landing string, url_binario string, resumo string, palavras_chave string, extra map<string,string>"""
OPEN_MARKS = ("openaccess", "open access", "acesso aberto", "info:eu-repo/semantics/openaccess")


def plain_name(name: str) -> str:
    import unicodedata

    folded = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", "_", folded).strip("_")


def sniffed(head: bytes, fewest: int = 4) -> tuple[str, str]:
    """Encoding and separator of the first that read a file's head into ``fewest`` columns or more."""
    for encoding in ENCODINGS:
        try:
            # a head may end inside a character
            line = head.decode(encoding, "strict" if len(head) < 65_536 else "ignore").lstrip("﻿").split("\n", 1)[0]
        except UnicodeDecodeError:
            continue
        for separator in SEPARATORS:
            if line.count(separator) + 1 >= fewest:
                return encoding, separator
    raise ValueError("encoding and separator unknown")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A delimited file as text columns, probed by its first bytes alone; lines of another shape are dropped."""
    head = bytes(spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 65_536)).first()[0]) if not path.endswith(".gz") else _unzipped_head(spark, path)
    encoding, separator = sniffed(head)
    options = {"header": True, "sep": separator, "encoding": {"latin-1": "ISO-8859-1", "cp1252": "windows-1252"}.get(encoding, encoding), "quote": '"', "escape": '"', "mode": "DROPMALFORMED"}
    return spark.read.options(**options).csv(path)


def _unzipped_head(spark: SparkSession, path: str) -> bytes:
    lines = spark.read.text(path).limit(2).collect()
    return "\n".join(r.value for r in lines).encode()


def mapped(columns: list[str], fields: dict[str, list[str]] = CENSUS) -> dict[str, str]:
    """Which column holds each field: of a field's patterns the first that fits a column, and of columns the first."""
    plain = [(plain_name(c), c) for c in columns]
    found = {}
    for field, patterns in fields.items():
        hits = [c for p in patterns for n, c in plain if re.search(p, n)]
        if hits:
            found[field] = hits[0]
    return found


def census(tables: dict[str, DataFrame], area: str = "area_avaliacao", values: list[str] = ()) -> DataFrame | None:
    """Candidates of census tables by name: one area's rows that have a title. Tables without the needed columns are left out."""
    out = []
    for name, df in tables.items():
        at = mapped(df.columns)
        place = at.get(area) or at.get("area_conhecimento") or at.get("area_avaliacao")
        if not {"titulo", "autor", "ies"} <= set(at) or place is None:
            continue
        col = lambda field, at=at: F.btrim(F.coalesce(F.col(f"`{at[field]}`"), F.lit(""))) if field in at else F.lit("")
        rows = df.where(T.name_key(F.coalesce(F.col(f"`{place}`"), F.lit(""))).isin(*map(plain_name, values))) if values else df
        rows = rows.where(col("titulo") != "")
        year = F.nullif(F.regexp_extract(col("ano"), r"((?:19|20)\d{2})", 1), F.lit("")).cast("int")
        # the row itself names it: numbers of rows differ from run to run
        key = F.concat(F.lit(f"capes:{name}:"), F.left(F.sha1(F.concat_ws("|", col("titulo"), col("autor"), col("ano"), col("ies"))), F.lit(16)))
        extra = F.create_map(*[x for f in ("uf", "regiao", "paginas", "area_avaliacao", "area_conhecimento", "grande_area") for x in (F.lit(f), col(f))])
        out.append(
            rows.select(
                F.lit("capes").alias("fonte"), key.alias("chave_origem"), col("titulo").alias("titulo"), col("autor").alias("autor"), year.alias("ano"), col("ies").alias("ies"), col("programa").alias("programa"),
                F.coalesce(F.nullif(col(area), F.lit("")), col("area_conhecimento")).alias("area"), F.lit(f"capes.{area}").alias("taxonomia"), col("tipo").alias("tipo"), F.lit("por").alias("idioma"),
                *[F.lit("").alias(c) for c in ("identificador", "endpoint", "url_landing", "url_binario")], col("resumo").alias("resumo"), col("palavras_chave").alias("palavras_chave"), extra.alias("extra"),
            )
        )
    return reduce(DataFrame.unionByName, out) if out else None


def open_access(rights: Column, marks: tuple[str, ...] = OPEN_MARKS) -> Column:
    """Whether rights name open access; no rights do not close a record."""
    text = F.lower(F.coalesce(rights, F.lit("")))
    return (text == "") | T.any_term(text, marks)


def institutions(name: Column, allowed: list[str] = (), denied: list[str] = ()) -> Column:
    """Not on the list of the denied, and on that of the allowed where there is one, in any case."""
    upper = F.upper(F.coalesce(name, F.lit("")))
    ok = F.lit(True)
    if denied:
        ok = ok & ~upper.isin(*[d.upper() for d in denied])
    return ok & upper.isin(*[a.upper() for a in allowed]) if allowed else ok


def in_scope(context: Column, include: list[str] = (), exclude: list[str] = (), allowed: list[str] = ()) -> Column:
    """Some term of ``include`` as a part of the text, and none of ``exclude`` as whole words once ``allowed`` are gone."""
    key = T.name_key(context)
    ok = F.lit(True)
    if include:
        ok = ok & T.any_term(key, [plain_name(t) for t in include if plain_name(t)])
    if not exclude:
        return ok
    marked = F.concat(F.lit("_"), key, F.lit("_"))
    for a in allowed:
        if plain_name(a):
            marked = F.regexp_replace(marked, f"(?<=_){re.escape(plain_name(a))}(?=_)", "")
    return ok & ~reduce(lambda x, y: x | y, [F.contains(marked, F.lit(f"_{plain_name(t)}_")) for t in exclude if plain_name(t)])


def inventory(df: DataFrame, only_open: bool = True, allowed: list[str] = (), denied: list[str] = (), include: list[str] = (), exclude: list[str] = (), expressions: list[str] = (), per_institution: int = 0, seed: int = 42) -> DataFrame:
    """Candidates of an inventory table (id, titulo, autor, ano, tipo, instituicao, repositorio, url, direitos, idioma, assuntos)."""
    c = F.col
    rows = df.where(c("url").isNotNull() & ~T.internal_host(T.host(c("url").cast("string"))))
    if only_open:
        rows = rows.where(F.lower(F.coalesce("direitos", F.lit(""))) == "openaccess")
    rows = rows.where(institutions(c("instituicao"), allowed, denied))
    context = F.concat_ws(" ", F.coalesce("titulo", F.lit("")), F.coalesce("assuntos", F.lit("")))
    rows = rows.where(in_scope(context, include, exclude, expressions))
    if per_institution:
        rows = capped(rows, ["instituicao"], "id", per_institution, seed).drop("nth", "_n")
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit(""))
    return rows.select(
        F.lit("bdtd_inventario").alias("fonte"), text("id").alias("chave_origem"), text("titulo").alias("titulo"), text("autor").alias("autor"), c("ano").cast("double").cast("int").alias("ano"), text("instituicao").alias("ies"),
        F.lit("").alias("programa"), text("assuntos").alias("area"), F.lit("inventory subjects").alias("taxonomia"), text("tipo").alias("tipo"), text("idioma").alias("idioma"), text("url").alias("identificador"),
        F.lit("").alias("endpoint"), text("url").alias("url_landing"), F.lit("").alias("url_binario"), F.lit("").alias("resumo"), text("assuntos").alias("palavras_chave"),
        F.create_map(F.lit("direitos"), text("direitos"), F.lit("repositorio"), text("repositorio")).alias("extra"),
    )


def as_record(candidates: DataFrame) -> DataFrame:
    """Candidates in the shape of a metadata record, so that staging reads every source alike."""
    c = F.col
    some = lambda name: F.coalesce(c(name), F.lit(""))
    words = F.filter(F.transform(F.split(F.coalesce(F.nullif("palavras_chave", F.lit("")), c("area"), F.lit("")), ";"), lambda x: F.btrim(x)), lambda x: x != "")
    one = lambda name: F.array(some(name))
    none = F.array().cast("array<string>")
    people = F.struct(F.when(some("autor") != "", F.array("autor")).otherwise(none).alias("primary"), none.alias("secondary"), none.alias("corporate"))
    raw = F.create_map(F.lit("eu_rights_str_mv"), F.array(F.coalesce(F.try_element_at("extra", F.lit("direitos")), F.lit(""))), F.lit("dc.publisher.program.fl_str_mv"), one("programa"))
    return candidates.select(
        F.coalesce(F.nullif("chave_origem", F.lit("")), F.nullif("identificador", F.lit("")), F.left("titulo", F.lit(120))).alias("id"), c("titulo").alias("title"), one("resumo").alias("summary"), people.alias("authors"), one("tipo").alias("formats"),
        F.array(F.coalesce("idioma", F.lit("por"))).alias("languages"), F.array(F.coalesce(c("ano").cast("string"), F.lit(""))).alias("publicationDates"), F.transform(words, lambda w: F.array(w)).alias("subjects"), one("ies").alias("institutions"),
        F.filter(F.array("url_binario", "url_landing"), lambda u: F.coalesce(u, F.lit("")) != "").alias("urls"), raw.alias("rawData"),
    )


def candidate_urls(records: DataFrame) -> Column:
    """A record's addresses: its own, then those of four raw fields, distinct, in order."""
    raw = [F.coalesce(F.try_element_at("rawData", F.lit(k)), F.array().cast("array<string>")) for k in ("url", "urls", "dc.identifier.uri.fl_str_mv", "link_str_mv")]
    return F.array_distinct(F.filter(F.concat(F.coalesce(records["urls"], F.array().cast("array<string>")), *raw), lambda u: F.coalesce(u, F.lit("")) != ""))
