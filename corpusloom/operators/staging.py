"""Staging: records of several sources to four tables (documents, authors, subjects, files), and their integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.sources.records import file_kind

#: A metadata record and a download as they are kept.
RECORD = """id string, title string, summary array<string>, authors struct<primary:array<string>,secondary:array<string>,corporate:array<string>>,
formats array<string>, languages array<string>, publicationDates array<string>, subjects array<array<string>>, institutions array<string>,
urls array<string>, rawData map<string,array<string>>"""
DOWNLOAD = "doc_id string, urls_origem array<string>, baixado boolean, arquivo string, url_pdf string, sha256 string, bytes long"
#: Roles of authors by the records' field.
ROLES = {"primary": "autor", "secondary": "coautor", "corporate": "instituicao"}
#: Languages with the names and codes that sources use.
LANGUAGES = {
    "pt": "pt por portugues pt-br pt_br portuguese",
    "en": "en eng ingles english",
    "es": "es spa espanhol espanol spanish",
    "fr": "fr fra fre frances french",
    "it": "it ita italiano italian",
    "de": "de ger deu alemao german",
}


def doc_key(source_id: Column) -> Column:
    return T.short_hash(F.coalesce(source_id, F.lit("")))


def flat(text: Column) -> Column:
    """White space as single spaces, trimmed; null is empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\s\\x{A0}\\x{2028}\\x{2029}]+", " "), "^ | $", "")


def flat_list(values: Column) -> Column:
    """The distinct non-empty flat values of an array, in order; null is none."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), flat), lambda x: x != ""))


def joined(values: Column) -> Column:
    return F.array_join(flat_list(values), " | ")


def raw(*keys: str) -> Column:
    """The first of several raw fields that has values."""
    found = [F.when(F.size(F.coalesce(F.try_element_at("rawData", F.lit(k)), F.array().cast("array<string>"))) > 0, F.try_element_at("rawData", F.lit(k))) for k in keys]
    return F.coalesce(*found, F.array().cast("array<string>"))


def best_abstract(values: Column, longer_than: int = 120, least: float = 0.08) -> Column:
    """Of long descriptions the one with most Portuguese function words, if it has enough; else the first long one; else all, flat."""
    long = F.filter(flat_list(values), lambda x: F.length(x) > longer_than)
    scored = F.transform(long, lambda x, i: F.struct(T.share_of(T.words(F.lower(x)), T.PT_ABSTRACT).alias("s"), (-i).alias("i"), x.alias("x")))
    best = F.array_max(scored)
    return F.when(F.size(long) == 0, flat(F.array_join(F.filter(values, lambda x: x != ""), " "))).when(best["s"] > least, best["x"]).otherwise(F.get(long, 0))


def first_year(values: Column, pattern: str = r"1[89]\d{2}|20\d{2}") -> Column:
    """The first year in the first value that has one."""
    found = F.filter(F.transform(flat_list(values), lambda x: F.regexp_extract(x, f"({pattern})", 1)), lambda y: y != "")
    return F.get(found, 0).cast("int")


def first_part(value: Column) -> Column:
    """Of several values in one field the first."""
    return F.split(F.coalesce(value.cast("string"), F.lit("")), r"[|;]")[0]


def standard_language(value: Column) -> Column:
    key = F.btrim(T.bare(first_part(value)))
    return reduce(lambda a, kv: a.when(key.isin(*kv[1].split()), F.lit(kv[0])), LANGUAGES.items(), F.when(F.lit(False), F.lit("")))


def standard_kind(value: Column) -> Column:
    key = T.bare(first_part(value))
    has = lambda *parts: reduce(lambda a, b: a | b, [F.contains(key, F.lit(p)) for p in parts])
    return F.when(has("disserta", "master", "mestrado"), "dissertação de mestrado").when(has("tese", "doctor", "doutorado"), "tese de doutorado")


def standard_year(value: Column, low: int = 1800) -> Column:
    """The first four digits, if they are a year up to now."""
    y = F.nullif(F.regexp_extract(first_part(value), r"(\d{4})", 1), F.lit("")).cast("int")
    return F.when(y.between(F.lit(low), F.year(F.current_date())), y)


def standardised(df: DataFrame) -> DataFrame:
    """Closed vocabularies for idioma, tipo and ano where they occur; what stood there is kept as <column>_bruto."""
    for name, f in (("idioma", standard_language), ("tipo", standard_kind), ("ano", standard_year)):
        if name in df.columns:
            df = df.withColumn(f"{name}_bruto", F.col(name).cast("string")).withColumn(name, f(F.col(f"{name}_bruto")))
    return df


def last_of(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key in a stated order."""
    return rows.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_nth = 1").drop("_nth")


def documents(records: DataFrame, downloads: DataFrame, area: str, order: str | None = None) -> DataFrame:
    """One row for each record id (the first by ``order``, else by title), with its last download.

    ``records`` fits RECORD, ``downloads`` DOWNLOAD; a column ``order`` of either gives the order in which rows came.
    """
    c = F.col
    made = records.withColumn("doc_id", doc_key(c("id")))
    by = order if order else "title"
    made = made.withColumn("_nth", F.row_number().over(Window.partitionBy("doc_id").orderBy(by, "title"))).where("_nth = 1").drop("_nth")
    d = last_of(downloads, "doc_id", order if order and order in downloads.columns else "arquivo").select("doc_id", *[F.col(x).alias(f"_{x}") for x in ("urls_origem", "url_pdf", "arquivo", "sha256", "bytes", "baixado")])
    either = lambda field, *keys: F.when(F.size(F.coalesce(c(field), F.array().cast("array<string>"))) > 0, c(field)).otherwise(raw(*keys))
    institution = F.coalesce(F.nullif(F.get(c("institutions"), 0), F.lit("")), F.array_join(flat_list(raw("institution", "dc.publisher.initials.fl_str_mv")), " "))
    return made.join(d, "doc_id", "left").select(
        "doc_id",
        F.coalesce("id", F.lit("")).alias("id_bdtd"),
        flat(F.coalesce(F.nullif("title", F.lit("")), F.array_join(raw("title"), " "))).alias("titulo"),
        joined(raw("title_alt", "dc.title.alternative.fl_str_mv")).alias("titulo_alternativo"),
        best_abstract(either("summary", "description")).alias("resumo"),
        flat(institution).alias("instituicao"),
        joined(raw("dc.publisher.program.fl_str_mv", "publisher")).alias("programa"),
        joined(either("formats", "format")).alias("tipo"),
        joined(either("languages", "language")).alias("idioma"),
        first_year(either("publicationDates", "publishDate")).alias("ano"),
        joined(raw("dc.subject.cnpq.fl_str_mv")).alias("area_cnpq"),
        joined(raw("eu_rights_str_mv", "dc.rights.driver.fl_str_mv")).alias("direitos"),
        F.coalesce(F.get("_urls_origem", 0), F.lit("")).alias("url_registro"),
        F.col("_url_pdf").alias("url_pdf"),
        F.col("_arquivo").alias("arquivo"),
        F.col("_sha256").alias("sha256_arquivo"),
        F.coalesce("_bytes", F.lit(0)).cast("long").alias("bytes_arquivo"),
        F.coalesce("_baixado", F.lit(False)).alias("tem_arquivo"),
        F.lit(area).alias("area_projeto"),
        F.current_timestamp().alias("staging_em"),
    )


def authors(records: DataFrame) -> DataFrame:
    """(doc_id, nome, papel), distinct: authors by role, and advisors from the raw fields."""
    named = [_with_role(flat_list(F.col(f"authors.{field}")), role) for field, role in ROLES.items()]
    named.append(_with_role(flat_list(raw("dc.contributor.advisor1.fl_str_mv", "dc.contributor.advisor.fl_str_mv")), "orientador"))
    return records.select(doc_key(F.col("id")).alias("doc_id"), F.explode(F.concat(*named)).alias("a")).select("doc_id", "a.nome", "a.papel").distinct()


def _with_role(names: Column, role: str) -> Column:
    return F.transform(names, lambda x: F.struct(x.alias("nome"), F.lit(role).alias("papel")))


def subjects(records: DataFrame) -> DataFrame:
    """(doc_id, assunto), distinct."""
    every = flat_list(F.flatten(F.filter(F.coalesce("subjects", F.array().cast("array<array<string>>")), lambda x: x.isNotNull())))
    return records.select(doc_key(F.col("id")).alias("doc_id"), F.explode(every).alias("assunto")).distinct()


def files(downloads: DataFrame, contents: DataFrame) -> DataFrame:
    """Of each named file: whether it is there, its size, the kind its name declares and the kind it is.

    ``contents`` (arquivo, bytes, head) tells what is on the disk, as ``binaryFile`` reads it; ``head`` may be the first bytes alone.
    """
    named = downloads.where(F.coalesce("arquivo", F.lit("")) != "").select("doc_id", "arquivo", "sha256")
    there = contents.select("arquivo", F.col("bytes").alias("_bytes"), F.col("head").alias("_head"))
    found = F.col("_bytes").isNotNull()
    return named.join(there, "arquivo", "left").select(
        "doc_id",
        "arquivo",
        found.alias("existe"),
        F.coalesce("_bytes", F.lit(0)).cast("long").alias("bytes"),
        F.lower(F.regexp_extract("arquivo", r"\.([^./]*)$", 1)).alias("tipo_declarado"),
        F.when(found, file_kind(F.col("_head"))).otherwise("ausente").alias("tipo_real"),
        "sha256",
    )


FAILURE = "id string, type string, detail string"


def integrity(docs: DataFrame, people: DataFrame, topics: DataFrame, files_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Failures (id, type, detail) of six checks, and a row of counts by check; repeated title and year are counted alone."""
    ids = docs.select("doc_id")
    fail = lambda df, kind, detail: df.select(F.col("doc_id").cast("string").alias("id"), F.lit(kind).alias("type"), detail.cast("string").alias("detail"))
    lost = lambda df: df.select("doc_id").distinct().join(ids, "doc_id", "left_anti")
    checks = {
        "arquivo_orfao": fail(lost(files_of), "arquivo_orfao", F.lit("file without a document")),
        "arquivo_ausente": fail(files_of.where("not existe"), "arquivo_ausente", F.lit("named file is not there")),
        "fk_quebrada_autores": fail(lost(people), "fk_quebrada_autores", F.lit("authors name no document")),
        "fk_quebrada_assuntos": fail(lost(topics), "fk_quebrada_assuntos", F.lit("subjects name no document")),
        "tipo_divergente": fail(files_of.where("existe and tipo_declarado <> tipo_real"), "tipo_divergente", F.col("tipo_real")),
        "sem_titulo": fail(docs.where(F.coalesce("titulo", F.lit("")) == ""), "sem_titulo", F.lit("")),
    }
    failures = reduce(DataFrame.unionByName, checks.values())
    again = docs.select(F.lower(F.btrim(F.coalesce("titulo", F.lit("")))).alias("t"), F.coalesce(F.col("ano").cast("string"), F.lit("")).alias("y")).groupBy("t", "y").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("titulos_repetidos"))
    counts = failures.agg(*[F.coalesce(F.sum((F.col("type") == k).cast("long")), F.lit(0)).alias(k) for k in checks])
    return failures, counts.withColumn("titulos_repetidos", again.scalar())
