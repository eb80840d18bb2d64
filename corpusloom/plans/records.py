"""Queries over records: staging, linkage, inventories, harvest plans, processed and curated tables.

The test tables hold no metadata records; ``_records`` and ``_candidates`` make some of documents, with the same
expressions in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import robots
from corpusloom.functions import text as T
from corpusloom.operators import corpus as C
from corpusloom.operators import curated as U
from corpusloom.operators import inventory as I
from corpusloom.operators import linkage as L
from corpusloom.operators import processed as P
from corpusloom.operators import reports as R
from corpusloom.operators import staging as S
from corpusloom.plans.catalog import _listed
from corpusloom.plans.registry import query, read
from corpusloom.sources import fetch, oai, tables
from corpusloom.storage import materialize, ship_package

W = T.WORD
_FLAT = r"trim(regexp_replace({0}, '[\s\x{{A0}}\x{{2028}}\x{{2029}}]+', ' ', 'g'), ' ')"
_HEAD = f"list_slice(regexp_extract_all(left(text, 2000), '{W}'), 1, 8)"
#: Records of documents; every ninth id comes twice.
_BASE = f"""base AS (SELECT doc_id, 'oai:host' || (doc_id % 7) || ':' || doc_id AS id, array_to_string({_HEAD}, ' ') AS title, {_FLAT.format('left(text, 600)')} AS abstract,
lower(coalesce(regexp_extract_all(left(text, 2000), '{W}')[9], 'anon')) || ', A.' AS author, source, lang, (1990 + doc_id % 30)::INT AS year, left(sha1('oai:host' || (doc_id % 7) || ':' || doc_id), 16) AS key FROM documents)"""


def _base(spark, sf_dir) -> DataFrame:
    w = T.words(F.left("text", F.lit(2000)))
    d = read(spark, sf_dir, "documents")
    ident = F.concat(F.lit("oai:host"), (F.col("doc_id") % 7).cast("string"), F.lit(":"), F.col("doc_id").cast("string"))
    return d.select(
        "doc_id",
        "text",
        "lang",
        "source",
        ident.alias("id"),
        F.array_join(F.slice(w, 1, 8), " ").alias("title"),
        F.left("text", F.lit(600)).alias("abstract"),
        F.concat(F.lower(F.coalesce(F.get(w, 8), F.lit("anon"))), F.lit(", A.")).alias("author"),
        (F.col("doc_id") % 30 + 1990).cast("int").alias("year"),
        S.doc_key(ident).alias("key"),
    )


def _records(spark, sf_dir) -> DataFrame:
    none = F.array().cast("array<string>")
    b = _base(spark, sf_dir)
    people = F.struct(F.array("author").alias("primary"), F.array(F.lit("B, Co"), F.col("author")).alias("secondary"), none.alias("corporate"))
    raw = F.create_map(F.lit("publisher"), F.array(F.concat(F.lit("Programa  "), "lang")), F.lit("eu_rights_str_mv"), F.array(F.lit("openAccess")), F.lit("dc.contributor.advisor1.fl_str_mv"), F.array(F.lit("Advisor")))
    one = b.select(
        "id", "title", F.array("abstract").alias("summary"), people.alias("authors"), F.array(F.lit("masterThesis")).alias("formats"), F.array(F.lit("por"), F.lit("eng")).alias("languages"),
        F.array(F.concat(F.lit("em "), F.col("year").cast("string"))).alias("publicationDates"), F.array(F.array("lang", "source"), F.array("lang")).alias("subjects"), F.array("source").alias("institutions"), none.alias("urls"), raw.alias("rawData"), "doc_id",
    )
    return one.where("doc_id % 9 <> 0").drop("doc_id").unionByName(one.where("doc_id % 9 = 0").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n", "doc_id"))


def _downloads(spark, sf_dir) -> DataFrame:
    """A file for every second document, and every 50th without a record."""
    b = _base(spark, sf_dir).where("doc_id % 2 = 0")
    name = F.concat(F.lit("/raw/"), "key", F.when(F.col("doc_id") % 6 == 0, ".zip").otherwise(".pdf"))
    key = F.when(F.col("doc_id") % 50 == 0, F.concat(F.lit("x"), "key")).otherwise(F.col("key"))
    return b.select(key.alias("doc_id"), F.array(F.concat(F.lit("http://r/"), "key")).alias("urls_origem"), F.lit(True).alias("baixado"), name.alias("arquivo"), F.lit(None).cast("string").alias("url_pdf"), F.sha2("key", 256).alias("sha256"), F.lit(10).cast("long").alias("bytes"))


@query(
    f"""WITH {_BASE} SELECT key AS doc_id, id AS id_bdtd, title AS titulo, md5(abstract) AS resumo, source AS instituicao, 'Programa ' || lang AS programa, 'masterThesis' AS tipo, 'por | eng' AS idioma, year AS ano,
'openAccess' AS direitos, CASE WHEN doc_id % 2 = 0 AND doc_id % 50 <> 0 THEN 'http://r/' || key ELSE '' END AS url_registro, doc_id % 2 = 0 AND doc_id % 50 <> 0 AS tem_arquivo FROM base"""
)
def staging_documents(spark, sf_dir):
    d = S.documents(_records(spark, sf_dir), _downloads(spark, sf_dir), "teste")
    return d.select("doc_id", "id_bdtd", "titulo", F.md5("resumo").alias("resumo"), "instituicao", "programa", "tipo", "idioma", "ano", "direitos", "url_registro", "tem_arquivo")


@query(f"WITH {_BASE} SELECT key AS doc_id, author AS nome, 'autor' AS papel FROM base UNION SELECT key, author, 'coautor' FROM base UNION SELECT key, 'B, Co', 'coautor' FROM base UNION SELECT key, 'Advisor', 'orientador' FROM base")
def staging_authors(spark, sf_dir):
    return S.authors(_records(spark, sf_dir))


@query(f"WITH {_BASE} SELECT key AS doc_id, lang AS assunto FROM base UNION SELECT key, source FROM base")
def staging_subjects(spark, sf_dir):
    return S.subjects(_records(spark, sf_dir))


def _staged(spark, sf_dir):
    b = _base(spark, sf_dir)
    downloads = _downloads(spark, sf_dir)
    disk = b.where("doc_id % 2 = 0 and doc_id % 10 <> 0").select(F.concat(F.lit("/raw/"), "key", F.when(F.col("doc_id") % 6 == 0, ".zip").otherwise(".pdf")).alias("arquivo"), F.lit(10).alias("bytes"), F.when(F.col("doc_id") % 8 == 0, F.lit("PK").cast("binary")).otherwise(F.lit("%PDF-1").cast("binary")).alias("head"))
    return S.documents(_records(spark, sf_dir), downloads, "teste"), S.files(downloads, disk)


@query(
    f"""WITH {_BASE}, f AS (SELECT CASE WHEN doc_id % 50 = 0 THEN 'x' || key ELSE key END AS id, doc_id % 10 <> 0 AS there, CASE WHEN doc_id % 6 = 0 THEN 'zip' ELSE 'pdf' END AS said, CASE WHEN doc_id % 8 = 0 THEN 'desconhecido' ELSE 'pdf' END AS is_kind, doc_id FROM base WHERE doc_id % 2 = 0)
SELECT 'arquivo_orfao' AS type, count(*)::BIGINT AS n FROM f WHERE doc_id % 50 = 0 UNION ALL SELECT 'arquivo_ausente', count(*) FROM f WHERE NOT there UNION ALL SELECT 'tipo_divergente', count(*) FROM f WHERE there AND said <> is_kind
UNION ALL SELECT 'fk_quebrada_autores', 1 UNION ALL SELECT 'sem_titulo', n FROM (SELECT count(*)::BIGINT AS n FROM base WHERE title = '') WHERE n > 0"""
)
def staging_failures(spark, sf_dir):
    """Six checks; some files are orphans, missing or of another kind, and one author names no document."""
    docs, files = _staged(spark, sf_dir)
    people = S.authors(_records(spark, sf_dir)).unionByName(spark.createDataFrame([("nobody", "N", "autor")], "doc_id string, nome string, papel string"))
    failures, _ = S.integrity(docs, people, S.subjects(_records(spark, sf_dir)), files)
    return R.failures_by_type(failures)


@query(f"WITH {_BASE}, t AS (SELECT lower(trim(title, ' ')) AS t, year, count(*) AS n FROM base GROUP BY ALL) SELECT (SELECT count(*) FROM base WHERE title = '')::BIGINT AS sem_titulo, coalesce(sum(n - 1), 0)::BIGINT AS titulos_repetidos FROM t")
def staging_counts(spark, sf_dir):
    docs, files = _staged(spark, sf_dir)
    _, counts = S.integrity(docs, S.authors(_records(spark, sf_dir)), S.subjects(_records(spark, sf_dir)), files)
    return counts.select("sem_titulo", "titulos_repetidos")


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'pt' WHEN 1 THEN 'en' WHEN 2 THEN 'es' WHEN 3 THEN 'de' END AS idioma, CASE doc_id % 3 WHEN 0 THEN 'dissertação de mestrado' WHEN 1 THEN 'tese de doutorado' END AS tipo,
CASE WHEN 1700 + doc_id % 300 BETWEEN 1800 AND year(current_date) THEN (1700 + doc_id % 300)::INT END AS ano, (1700 + doc_id % 300)::VARCHAR || '; x' AS ano_bruto FROM documents"""
)
def standardized_metadata(spark, sf_dir):
    """Closed vocabularies of language, kind and year, with what stood there."""
    k = F.col("doc_id")
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.pmod(k, F.lit(len(values))).cast("int"))
    d = read(spark, sf_dir, "documents").select("doc_id", pick(["Português | eng", "ENGLISH", "espanhol", "deu", "xx"]).alias("idioma"), pick(["Dissertação", "doctoralThesis", "artigo"]).alias("tipo"), F.concat((k % 300 + 1700).cast("string"), F.lit("; x")).alias("ano"))
    return S.standardised(d).select("doc_id", "idioma", "tipo", "ano", "ano_bruto")


_CAND = f"""{_BASE}, cand AS (SELECT doc_id AS k, 'f' || (doc_id % 3) AS fonte, title AS titulo, author AS autor, year AS ano, 'Universidade de ' || source AS ies, CASE WHEN doc_id % 4 = 0 THEN 'doi' || (doc_id % 40) ELSE '' END AS identificador,
CASE WHEN doc_id % 5 = 0 THEN 'http://f/' || doc_id ELSE '' END AS url_binario, CASE WHEN doc_id % 2 = 0 THEN 'http://p/' || doc_id ELSE '' END AS url_landing, abstract AS resumo FROM base)"""


def _candidates(spark, sf_dir) -> DataFrame:
    k = F.col("doc_id")
    text = lambda cond, *parts: F.when(cond, F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])).otherwise("")
    num = k.cast("string")
    return _base(spark, sf_dir).select(
        k.alias("k"), F.concat(F.lit("f"), (k % 3).cast("string")).alias("fonte"), F.concat(F.lit("c"), num).alias("chave_origem"), F.col("title").alias("titulo"), F.col("author").alias("autor"), F.col("year").alias("ano"), F.concat(F.lit("Universidade de "), "source").alias("ies"),
        text(k % 4 == 0, "doi", (k % 40).cast("string")).alias("identificador"), text(k % 5 == 0, "http://f/", num).alias("url_binario"), text(k % 2 == 0, "http://p/", num).alias("url_landing"), S.flat(F.col("abstract")).alias("resumo"),
        *[F.lit("").alias(c) for c in ("programa", "area", "taxonomia", "tipo")],
    )


_FOLD = "lower(strip_accents({0}))"
_OUT = _listed(L.LEFT_OUT)
_KEYS = rf"""{_CAND}, keys AS (SELECT k, array_to_string(list_filter(string_split_regex(regexp_replace({_FOLD.format('titulo')}, '[^a-z0-9 ]+', ' ', 'g'), ' +'), lambda x: length(x) > 1 AND NOT list_contains({_OUT}, x)), ' ') AS title,
array_to_string(list_sort(list_filter(regexp_extract_all({_FOLD.format('autor')}, '[a-z]+'), lambda x: length(x) > 1 AND NOT list_contains({_OUT}, x))), ' ') AS author, identificador AS identifier, ano AS year, ies FROM cand),
blocks AS (SELECT *, coalesce(nullif(array_to_string(string_split(title, ' ')[1:4], ' '), ''), 'sem-titulo') AS block FROM keys)"""


@query(f"WITH {_KEYS} SELECT k AS key, title, author, identifier, year, block FROM blocks")
def linkage_keys(spark, sf_dir):
    return L.keyed(_candidates(spark, sf_dir), "k").drop("place")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ufpi' WHEN 1 THEN 'usp' WHEN 2 THEN 'puc' WHEN 3 THEN 'ip' ELSE '' END AS place FROM documents")
def institution_keys(spark, sf_dir):
    """An acronym of the list by either accent, a short name, initials, and nothing."""
    names = ["UNIVERSIDADE FEDERAL DO PIAUÍ", "Universidade de São Paulo (USP)", "P.U.C.", "Instituto de Pesquisas", None]
    name = F.get(F.array(*[F.lit(n) for n in names]), F.pmod("doc_id", F.lit(5)).cast("int"))
    return read(spark, sf_dir, "documents").select("doc_id", L.institution_key(name).alias("place"))


_PAIRS = f"""{_KEYS}, filed AS (SELECT k, block, year + unnest([-1, 0, 1]) AS y FROM blocks), sizes AS (SELECT block, y FROM filed GROUP BY ALL HAVING count(*) BETWEEN 2 AND 400), ok AS (SELECT * FROM filed JOIN sizes USING (block, y)),
pairs AS (SELECT DISTINCT a.k AS a, b.k AS b FROM ok a JOIN ok b ON a.block = b.block AND a.y = b.y AND a.k < b.k)"""
_SIM = "(CASE WHEN {0} = '' OR {1} = '' THEN 0.0::DOUBLE ELSE 1 - levenshtein({0}, {1})::DOUBLE / greatest(length({0}), length({1})) END)"
_SCORES = f"""{_PAIRS}, scores AS (SELECT p.a, p.b, CASE WHEN x.identifier <> '' AND x.identifier = y.identifier THEN 1.0::DOUBLE ELSE 0.6::DOUBLE * {_SIM.format('x.title', 'y.title')} + 0.3::DOUBLE * {_SIM.format('x.author', 'y.author')} + CASE WHEN x.ies = y.ies THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END END AS score
FROM pairs p JOIN blocks x ON p.a = x.k JOIN blocks y ON p.b = y.k)"""


@query(f"WITH {_SCORES} SELECT a, b, floor(score * 10000 + 0.5)::BIGINT AS score FROM scores")
def linkage_scores(spark, sf_dir):
    keys = L.keyed(_candidates(spark, sf_dir), "k").withColumn("place", F.lit("")).join(_candidates(spark, sf_dir).select(F.col("k").alias("key"), "ies"), "key").withColumn("place", F.col("ies")).drop("ies")
    return L.scored_pairs(keys, L.candidate_pairs(keys)).withColumn("score", F.floor(F.col("score") * 10000 + 0.5))


@query()
def linkage_merged(spark, sf_dir):
    """One record for each work among the sources."""
    merged, _ = L.reconciled(materialize(_candidates(spark, sf_dir), "candidates"), "k")
    return merged.select("k", "fontes", "n_fontes", "url_binario", "url_landing", "identificador")


@query(
    """SELECT 'x' || page_id AS chave_origem, 'Título saúde ' || page_id AS titulo, (2000 + page_id % 20)::INT AS ano, 'UF' || (page_id % 3) AS ies FROM pages
WHERE page_id % 5 <> 0 AND page_id % 7 <> 0 AND page_id % 3 <> 1 AND page_id % 11 <> 0 AND url IS NOT NULL"""
)
def inventory_filtered(spark, sf_dir):
    """The inventory's filters: internal hosts, closed rights, an institution left out, topics in and out of scope."""
    k = F.col("page_id")
    num = k.cast("string")
    df = read(spark, sf_dir, "pages").where("url is not null").select(
        F.concat(F.lit("x"), num).alias("id"), F.concat(F.lit("Título saúde "), num).alias("titulo"), F.lit("A").alias("autor"), (k % 20 + 2000).cast("double").alias("ano"), F.lit("tese").alias("tipo"), F.concat(F.lit("UF"), (k % 3).cast("string")).alias("instituicao"),
        F.lit("r").alias("repositorio"), F.when(k % 5 == 0, F.lit("http://localhost:4000/x")).otherwise(F.lit("https://repo.org/x")).alias("url"), F.when(k % 7 == 0, "closed").otherwise("openAccess").alias("direitos"), F.lit("por").alias("idioma"),
        F.when(k % 11 == 0, "bovina de corte").otherwise("soro fetal bovino; equina").alias("assuntos"),
    )
    return tables.inventory(df, denied=["uf1"], include=["saude"], exclude=["bovina", "bovino"], expressions=["soro fetal bovino"]).select("chave_origem", "titulo", "ano", "ies")


@query("WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderkey) AS t FROM orders), p AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY t, o_orderstatus) - 1 AS place FROM o) SELECT o_orderkey, place::BIGINT AS place, (place // 200)::BIGINT AS round FROM p")
def interleaved_plan(spark, sf_dir):
    """Strata of one institution take turns, in rounds of 200."""
    return I.interleaved(read(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus", "o_orderkey").select("o_orderkey", "place", "round")


@query(
    """WITH e AS (SELECT 'k' || o_orderkey AS chave_origem, o_orderpriority AS estrato, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS p FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT 'k' || o_orderkey AS chave_origem, o_orderpriority AS estrato FROM orders WHERE o_orderstatus = 'P'), m AS (SELECT estrato, max(p) AS last FROM e GROUP BY 1), g AS (SELECT estrato, count(*) AS more FROM n GROUP BY 1)
SELECT chave_origem, p::BIGINT AS ordem_na_fila, (7 + coalesce(more, 0))::INT AS cota_estrato, true AS na_cota_inicial FROM e LEFT JOIN g USING (estrato)
UNION ALL SELECT chave_origem, coalesce(last, -1) + row_number() OVER (PARTITION BY estrato ORDER BY chave_origem), (coalesce(CASE WHEN last IS NOT NULL THEN 7 END, 0) + more)::INT, false FROM n LEFT JOIN m USING (estrato) JOIN g USING (estrato)"""
)
def merged_inventory(spark, sf_dir):
    """New candidates behind their strata's queues; the quotas grow by them."""
    o = read(spark, sf_dir, "orders")
    key = F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("chave_origem")
    old = o.where("o_orderstatus = 'F'").select("o_orderkey", key, F.col("o_orderpriority").alias("estrato"))
    old = C.ranked(old.withColumn("_b", F.lit(0)), ["_b"], ["o_orderkey"], ["estrato"]).select("chave_origem", "estrato", (F.col("_rank") - 1).alias("ordem_na_fila"), F.lit(7).alias("cota_estrato"), F.lit(True).alias("na_cota_inicial"))
    new = o.where("o_orderstatus = 'P'").select(key, F.col("o_orderpriority").alias("estrato"))
    return I.merged(old, new).select("chave_origem", "ordem_na_fila", "cota_estrato", "na_cota_inicial")


@query("SELECT o_orderpriority, 2000::BIGINT AS quota, count(*)::BIGINT AS attempts, sum((o_orderstatus = 'F')::INT)::BIGINT AS obtained, floor(sum((o_orderstatus = 'F')::INT) / count(*) * 1000)::BIGINT AS rate, sum((o_orderstatus = 'F')::INT) >= 2000 AS closed FROM orders GROUP BY 1")
def stratum_resolution(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    quotas = o.select("o_orderpriority").distinct().withColumn("quota", F.lit(2000).cast("long"))
    return I.stratum_report(o, quotas, "o_orderpriority", F.col("o_orderstatus") == "F").withColumn("rate", F.floor(F.col("obtained") / F.col("attempts") * 1000))


@query("SELECT event_type AS type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def failures_by_type(spark, sf_dir):
    return R.failures_by_type(read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type")))


def _corpus(spark, sf_dir) -> DataFrame:
    """Documents with metadata, split and text, as the products take them."""
    b = _base(spark, sf_dir)
    return b.select(
        "doc_id", "text", F.col("id").alias("id_bdtd"), F.col("title").alias("titulo"), S.flat(F.col("abstract")).alias("resumo"), F.col("author").alias("autor"), F.col("source").alias("instituicao"), F.concat(F.lit("Programa "), "lang").alias("programa"), F.col("year").alias("ano"),
        F.lit("tese | x").alias("tipo"), F.col("lang").alias("idioma"), F.lit("openAccess").alias("direitos"), F.concat(F.lit("https://h/"), F.col("key")).alias("url_registro"), F.lit("teste").alias("area_projeto"), F.concat_ws("; ", "lang", F.lit("CNPQ::X"), "source").alias("palavras_chave"),
        F.size(T.words(F.col("text"))).cast("long").alias("palavras"), F.when(F.col("doc_id") % 10 == 0, "validation").when(F.col("doc_id") % 10 == 1, "test").when(F.col("doc_id") % 10 == 2, "discarded").otherwise("train").alias("split"),
    )


_SPLITS = "CASE doc_id % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' WHEN 2 THEN 'discarded' ELSE 'train' END"


@query(f"WITH {_BASE} SELECT doc_id, 'OAI-PMH host' || (doc_id % 7) AS fonte, title AS titulo, author AS autor, year AS ano FROM base")
def record_meta(spark, sf_dir):
    return _corpus(spark, sf_dir).select("doc_id", U.meta()).select("doc_id", "meta.fonte", "meta.titulo", "meta.autor", "meta.ano")


@query(
    f"""WITH {_BASE}, m AS (SELECT doc_id, key, lang, source, author FROM base WHERE doc_id % 3 <> 0)
SELECT key AS doc_id, author AS autor, least(lang, source) || CASE WHEN lang = source THEN '' ELSE '; ' || greatest(lang, source) END AS palavras_chave, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'T' || doc_id END AS titulo FROM m"""
)
def corpus_loaded(spark, sf_dir):
    """Documents joined with metrics, treated titles, first author and keywords; those without text are left out."""
    b = materialize(_base(spark, sf_dir).select("doc_id", "key"), "keys")
    docs = S.documents(_records(spark, sf_dir), _downloads(spark, sf_dir), "teste")
    metrics = b.select(F.col("key").alias("doc_id"), F.lit(True).alias("no_corpus"), F.lit("x").alias("idioma"))
    treated = b.where("doc_id % 4 <> 0").select(F.col("key").alias("doc_id"), F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("titulo"))
    texts = b.where("doc_id % 3 <> 0").select(F.col("key").alias("doc_id"))
    return U.loaded(docs, metrics, treated, S.authors(_records(spark, sf_dir)), S.subjects(_records(spark, sf_dir)), texts).select("doc_id", "autor", "palavras_chave", "titulo")


_FIELDS = rf"""{_BASE}, f AS (SELECT doc_id, trim(title, ' ') AS titulo, trim(abstract, ' ') AS resumo, lang || '; ' || source AS palavras_chave, source AS instituicao, 'Programa ' || lang AS programa FROM base WHERE {_SPLITS} <> 'discarded'),
p AS (SELECT doc_id, list_filter([CASE WHEN titulo <> '' AND length(resumo) >= 200 THEN struct_pack(q := 'Explique, em um parágrafo, do que trata o trabalho intitulado "' || titulo || '".', a := resumo) END,
CASE WHEN titulo <> '' AND length(palavras_chave) >= 200 THEN struct_pack(q := 'Quais são as palavras-chave do trabalho "' || titulo || '"?', a := palavras_chave) END,
CASE WHEN instituicao <> '' AND length(resumo) >= 200 THEN struct_pack(q := 'Escreva o resumo de uma tese de ' || programa || ' da ' || instituicao || ' sobre o seguinte tema: ' || palavras_chave || '.', a := resumo) END,
CASE WHEN resumo <> '' AND titulo <> '' THEN struct_pack(q := 'Com base no resumo a seguir, proponha um título acadêmico adequado.' || chr(10) || chr(10) || 'Resumo: ' || resumo, a := titulo) END], lambda x: x IS NOT NULL) AS l FROM f)"""


@query(f"WITH {_FIELDS}, e AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS n FROM p) SELECT doc_id || '-' || n AS id, md5(x.q) AS request, md5(x.a) AS answer FROM e")
def instruction_templates(spark, sf_dir):
    """Every template that a document's fields fill; any language fits, as the texts have no Portuguese."""
    pairs = U.instruction_pairs(_corpus(spark, sf_dir), fits=lambda c: F.lit(True))
    return pairs.select("id", F.md5("request").alias("request"), F.md5("answer").alias("answer"))


@query(
    rf"""WITH d AS (SELECT doc_id, {_SPLITS} AS split, regexp_extract_all(text, '\s*\S+') AS t FROM documents WHERE {_SPLITS} <> 'discarded'), c AS (SELECT *, unnest(range(0, len(t), 450)) AS start FROM d WHERE len(t) > 0)
SELECT doc_id || '#' || lpad((start // 450)::VARCHAR, 5, '0') AS chunk_id, split, least(500, len(t) - start)::INT AS palavras, 'Programa ' || lang AS meta_programa FROM c JOIN documents USING (doc_id) WHERE least(500, len(t) - start) >= 50 OR start = 0"""
)
def rag_corpus(spark, sf_dir):
    return U.rag(_corpus(spark, sf_dir), about=("programa",)).select("chunk_id", "split", "palavras", "meta_programa")


@query(f"WITH {_BASE}, w AS (SELECT b.*, length(trim(abstract, ' ')) AS n FROM base b) SELECT 'ret-' || doc_id AS id, doc_id AS gold, title AS gold_title FROM w WHERE doc_id % 10 < 2 AND n > 300 ORDER BY md5('42|' || doc_id), doc_id LIMIT 300")
def retrieval_benchmark(spark, sf_dir):
    return U.retrieval_items(_corpus(spark, sf_dir)).select("id", "gold", "gold_title")


@query()
def choice_benchmark(spark, sf_dir):
    """Four choices an item, the answer among them; where and when."""
    items = U.choice_items(materialize(_corpus(spark, sf_dir).drop("text"), "corpus"))
    return items.select("id", "kind", "answer", F.array_contains("choices", F.col("answer")).alias("holds"), F.size(F.array_distinct("choices")).alias("n"))


@query(r"SELECT 'ppl-' || doc_id AS id, md5(array_to_string(regexp_extract_all(text, '\S+')[1:1024], ' ')) AS text FROM documents WHERE doc_id % 10 < 2 ORDER BY md5('13|' || doc_id), doc_id LIMIT 200")
def perplexity_benchmark(spark, sf_dir):
    return U.perplexity_items(_corpus(spark, sf_dir)).select("id", F.md5("text").alias("text"))


@query(f"WITH {_BASE} SELECT count(*)::BIGINT AS n_docs, (SELECT sum(len(regexp_extract_all(text, '{W}'))) FROM documents)::BIGINT AS n_words, (SELECT median(len(regexp_extract_all(text, '{W}'))) FROM documents)::DOUBLE AS median_words, min(year) AS first_year, max(year) AS last_year, count(DISTINCT source)::BIGINT AS n_institutions FROM base")
def corpus_statistics(spark, sf_dir):
    return U.summary(_corpus(spark, sf_dir))


@query("SELECT coalesce(source, '(não informado)') AS value, count(*)::BIGINT AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 8")
def datacard_values(spark, sf_dir):
    return U.top_values(_corpus(spark, sf_dir), "instituicao", 8)


@query()
def author_split(spark, sf_dir):
    """Works of one author and programme stay together; training documents like held-out ones are discarded."""
    df = materialize(_corpus(spark, sf_dir).drop("split"), "corpus")
    return U.split_documents(df.drop("text"), df.select("doc_id", "text")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query()
def processed_documents(spark, sf_dir):
    """From text to the processed table: normalised, masked, without repetition, judged, deduplicated."""
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    done = materialize(P.treated(docs.select("doc_id", "text"), separator="\n"), "treated")
    verdicts = materialize(P.judged(done, expected=None, least=20, stopwords=0), "judged")
    removed = P.deduplicated(verdicts.where("approved"))
    return P.table(verdicts, removed)


@query("SELECT doc_id, doc_id % 4 = 0 AS outside FROM documents")
def scope_recheck(spark, sf_dir):
    """Subjects, title, programme and abstract decide; the text's head where there is no abstract."""
    b = _base(spark, sf_dir)
    docs = b.select("doc_id", F.lit("Um estudo").alias("titulo"), F.lit("P").alias("programa"), F.when(F.col("doc_id") % 2 == 0, F.lit("  ")).otherwise(F.lit("pé equino")).alias("resumo"))
    texts = b.select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.lit("gado bovino de corte")).otherwise(F.lit("x")).alias("text"))
    topics = b.select("doc_id", F.lit("saúde").alias("assunto"))
    return P.scope_context(docs, topics, texts).select("doc_id", P.out_of_scope(F.col("context"), ("bovino", "equino"), ("pe equino",)).alias("outside"))


@query("WITH s AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) AS n FROM documents WHERE doc_id % 10 <> 0) SELECT doc_id FROM s WHERE n <= 5 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 10 = 0")
def sampled_with_done(spark, sf_dir):
    """All extracted before, and up to five new ones of each institution."""
    docs = read(spark, sf_dir, "documents")
    return P.sampled(docs, docs.where("doc_id % 10 = 0").select("doc_id"), "source", 5).select("doc_id")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def latest_history(spark, sf_dir):
    """An append-only history overlaid by this run's rows, the latest wins."""
    e = read(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return P.latest(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id").select("user_id", "event_type")


@query("SELECT 'oai:h:' || page_id AS chave_origem, 'Título ' || page_id AS titulo, (1990 + page_id % 30)::INT AS ano, 'Prog' AS programa, CASE WHEN page_id % 2 = 0 THEN '10.1/doi.' || page_id ELSE 'http://hdl/handle/' || page_id END AS identificador FROM pages WHERE page_id % 10 <> 0")
def oai_parsed(spark, sf_dir):
    """Records of a qualified format, parsed; every tenth has no title."""
    ship_package(spark)
    field = lambda e, q, v, s="dc": F.concat(F.lit(f'<dim:field mdschema="{s}" element="{e}"' + (f' qualifier="{q}"' if q else "") + ">"), v if not isinstance(v, str) else F.lit(v), F.lit("</dim:field>"))
    n = F.col("page_id").cast("string")
    head = F.concat(F.lit(f'<record xmlns="{oai.NS["oai"]}"><header><identifier>oai:h:'), n, F.lit(f'</identifier></header><metadata><dim:dim xmlns:dim="{oai.NS["dim"]}">'))
    title = F.when(F.col("page_id") % 10 == 0, F.lit("")).otherwise(field("title", "", F.concat(F.lit("Título "), n)))
    doi = F.when(F.col("page_id") % 2 == 0, field("identifier", "doi", F.concat(F.lit("10.1/doi."), n))).otherwise(F.lit(""))
    body = F.concat(head, title, field("date", "issued", (F.col("page_id") % 30 + 1990).cast("string")), field("publisher", "program", "Prog", "local"), field("identifier", "uri", F.concat(F.lit("http://hdl/handle/"), n)), doi, F.lit("</dim:dim></metadata></record>"))
    stored = read(spark, sf_dir, "pages").select(F.lit("http://e").alias("endpoint"), body.alias("xml"))
    return oai.candidates(stored, "oai").select("chave_origem", "titulo", "ano", "programa", "identificador")


@query("SELECT url_host AS origin, count(*)::BIGINT AS n FROM (SELECT regexp_extract(url, '^([A-Za-z]+://[^/]+)', 1) AS url_host, page_id FROM pages) WHERE NOT regexp_matches(url_host, '[02468]([.]|$)') GROUP BY 1")
def robots_permitted(spark, sf_dir):
    """Candidates whose origin no stored verdict bars: origins with an even digit before a dot or their end are barred."""
    pages = read(spark, sf_dir, "pages")
    origin = robots.origin(F.col("url"))
    evidence = pages.select(origin.alias("origin")).distinct().withColumn("allowed", ~F.col("origin").rlike(r"[02468]([.]|$)"))
    return robots.permitted(pages, "url", evidence).groupBy(origin.alias("origin")).agg(F.count(F.lit(1)).alias("n"))


@query()
def harvest_simulated(spark, sf_dir):
    """A quota harvest over a made-up network: every fifth file is missing, and one institution answers with errors."""
    ship_package(spark)
    o = read(spark, sf_dir, "customer")
    plan = o.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("chave_origem"), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("http://h"), F.col("c_nationkey").cast("string"), F.lit(".org/"), F.col("c_custkey").cast("string"), F.lit(".pdf"))).alias("url_binario"), F.lit("").alias("url_landing"), F.concat(F.lit("i"), F.col("c_nationkey").cast("string"), F.lit("|2000-2004")).alias("estrato"), F.lit(20).alias("cota_estrato"), F.col("c_custkey").alias("place"))
    planned = I.interleaved(plan.withColumn("inst", F.split("estrato", r"\|")[0]), "inst", "estrato", "place")
    return fetch.quota_harvest(planned, _network, "").groupBy("estrato").agg(F.sum(F.col("baixado").cast("long")).alias("got"), F.count(F.lit(1)).alias("tried"))


def _network():
    class Made(fetch.Resolver):
        def __init__(self):
            super().__init__(lambda url: None, "corpusloom", fetch.Pace(0.0))

        def obtain(self, urls, path):
            if "h7.org" in urls[0]:
                return fetch.Result(False, reason="http_503")
            return fetch.Result(True, path, urls[0], "0" * 64, 10)

    return Made()
