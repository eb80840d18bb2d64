"""Queries over texts and pages: normalisation, personal data, languages, robots, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import normalize as N
from corpusloom.functions import pii, robots
from corpusloom.functions import text as T
from corpusloom.operators import processed as P
from corpusloom.operators import tokens as K
from corpusloom.plans.catalog import _LANGUAGE, _listed
from corpusloom.plans.registry import query, read
from corpusloom.sources import fetch
from corpusloom.storage import ship_package

W = T.WORD
#: The test texts have none of the things that normalisation mends; every query puts some in, the same way in both engines.
_DIRTY = "'ﬁnal ' || replace(left(text, 4000), ' the ', ' the-' || chr(10) || 'n ') || chr(10) || '  12  ' || chr(10) || 'Intro ........ 7' || chr(8232) || 'a' || chr(160) || 'b &amp; c' || chr(10) || chr(10) || chr(10) || 'end' || chr(8203)"


def _dirty():
    head = F.replace(F.left("text", F.lit(4000)), F.lit(" the "), F.lit(" the-\nn "))
    return F.concat(F.lit("ﬁnal "), head, F.lit("\n  12  \nIntro ........ 7" + chr(0x2028) + "a" + chr(0xA0) + "b &amp; c\n\n\nend" + chr(0x200B)))


_TRIM = r"'^\s+|\s+$'"


@query(
    rf"""WITH a AS (SELECT doc_id, replace(replace(regexp_replace(replace(replace({_DIRTY}, 'ﬁ', 'fi'), chr(8232), chr(10)), '[^\P{{C}}\n\t]', '', 'g'), chr(160), ' '), 'ﬂ', 'fl') AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '(?m)^\s{{0,10}}(?:[-–—]\s*)?\d{{1,4}}(?:\s*[-–—])?\s*$', '', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '([\p{{L}}\p{{N}}_])[-‐‑–]\n\s*([\p{{L}}\p{{N}}_])', '\1\2', 'g'), '[.·•_\-–—]{{4,}}', ' ', 'g') AS t FROM b),
d AS (SELECT doc_id, replace(replace(t, '&nbsp;', ' '), '&amp;', '&') AS t FROM c),
e AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), ' *\n *', E'\n', 'g'), '\n{{3,}}', E'\n\n', 'g') AS t FROM d)
SELECT doc_id, length(regexp_replace(t, {_TRIM}, '', 'g'))::BIGINT AS n_chars, md5(regexp_replace(t, {_TRIM}, '', 'g')) AS plain FROM e"""
)
def normalized_full(spark, sf_dir):
    """The chain without cuts, over texts with something for each of its steps."""
    t = N.plain(_dirty(), front=False, back=False)
    return read(spark, sf_dir, "documents").select("doc_id", F.length(t).cast("long").alias("n_chars"), F.md5(t.cast("binary")).alias("plain"))


_FRAMED = "'Capa' || chr(10) || 'RESUMO' || chr(10) || text || chr(10) || '6 REFERÊNCIAS' || chr(10) || 'Silva, 1999'"


@query(f"SELECT doc_id, md5(CASE WHEN 5 < length({_FRAMED}) * 0.30 THEN 'RESUMO' || chr(10) || text ELSE 'Capa' || chr(10) || 'RESUMO' || chr(10) || text END) AS body FROM documents WHERE length(text) > 200")
def structural_cuts(spark, sf_dir):
    """Front and back matter put around each text, and cut again."""
    t = F.concat(F.lit("Capa\nRESUMO\n"), F.col("text"), F.lit("\n6 REFERÊNCIAS\nSilva, 1999"))
    cut = F.regexp_replace(N.without_back(N.without_front(t)), r"\n$", "")
    return read(spark, sf_dir, "documents").where("length(text) > 200").select("doc_id", F.md5(cut.cast("binary")).alias("body"))


@query("WITH c AS (SELECT conv_id, count(*) AS n, string_agg('Running head' || chr(10) || text || chr(10) || 'page foot', chr(12) ORDER BY turn) AS t, string_agg(text, chr(10) ORDER BY turn) AS bare FROM conversations WHERE NOT contains(text, chr(12)) GROUP BY conv_id) SELECT conv_id, n::BIGINT AS pages, md5(CASE WHEN n < 4 THEN replace(t, chr(12), chr(10)) ELSE bare END) AS plain FROM c")
def page_edges_removed(spark, sf_dir):
    """Conversations as pages with a running head and foot."""
    page = F.concat(F.lit("Running head\n"), F.col("text"), F.lit("\npage foot"))
    pages = F.array_sort(F.collect_list(F.struct("turn", page.alias("p"))))
    c = read(spark, sf_dir, "conversations").where(~F.contains("text", F.lit("\f"))).groupBy("conv_id").agg(pages.alias("p"))
    t = N.without_page_edges(F.array_join(F.transform("p", lambda x: x["p"]), "\f"))
    return c.select("conv_id", F.size("p").cast("long").alias("pages"), F.md5(t.cast("binary")).alias("plain"))


@query(f"WITH {_LANGUAGE} SELECT doc_id, coalesce(language, 'un') AS language, floor(coalesce(confidence, 0) * 1000)::BIGINT AS confidence FROM documents LEFT JOIN lr USING (doc_id)")
def language_vote(spark, sf_dir):
    df = T.with_language(read(spark, sf_dir, "documents"), "text")
    return df.select("doc_id", "language.lang", F.floor(F.col("language.confidence") * 1000).alias("confidence")).withColumnRenamed("lang", "language")


_SHARE = lambda stop: f"coalesce(len(list_filter(w, lambda x: list_contains({_listed(stop)}, x))) / nullif(len(w), 0), 0)"


@query(f"WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '{W}') AS w FROM documents) SELECT doc_id, len(w) < 20 OR ({_SHARE(T.PT_PAIRS)} >= 0.06 AND {_SHARE(T.PT_PAIRS)} > {_SHARE(T.EN_PAIRS)}) AS portuguese FROM w")
def portuguese_guard(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.in_portuguese(F.col("text")).alias("portuguese"))


def _planted():
    return F.concat("text", F.lit(" CPF 529.982.247-25, tel (86) 3215-5678, ORCID 0000-0002-1825-0097, CEP 64000-040"))


@query()
def pii_masked_full(spark, sf_dir):
    """All detectors over every text, with some data put behind each."""
    ship_package(spark)
    p = read(spark, sf_dir, "documents").select("doc_id", pii.personal(_planted()).alias("p"))
    total = F.aggregate(F.map_values("p.counts"), F.lit(0), lambda a, x: a + x)
    return p.select("doc_id", F.md5(F.col("p.text").cast("binary")).alias("masked"), total.cast("long").alias("n"))


@query()
def pii_findings(spark, sf_dir):
    ship_package(spark)
    p = read(spark, sf_dir, "documents").select("doc_id", pii.personal(_planted()).alias("texto"))
    return P.findings(p, ("texto",)).groupBy("tipo").agg(F.count(F.lit(1)).alias("n"))


def _weights(d: str, weights: list[int], start: int = 1) -> str:
    return "(" + " + ".join(f"substr({d}, {start + i}, 1)::INT * {w}" for i, w in enumerate(weights)) + ")"


def _mod(total: str) -> str:
    return f"(CASE WHEN {total} % 11 < 2 THEN 0 ELSE 11 - {total} % 11 END)"


_STATE = lambda t: f"(CASE WHEN {t} % 11 = 10 THEN 0 WHEN {t} % 11 = 0 AND substr(v, 9, 2) IN ('01', '02') THEN 1 ELSE {t} % 11 END)"
_V1 = _STATE(_weights("v", list(range(2, 10))))
_V2 = _STATE(f"({_weights('v', [7, 8], 9)} + {_V1} * 9)")
_VARIED = lambda d: f"length(replace({d}, substr({d}, 1, 1), '')) > 0"


@query(
    f"""WITH k AS (SELECT o_orderkey, lpad((o_orderkey * 7919 % 1000000000000)::VARCHAR, 12, '0') AS b FROM orders),
n AS (SELECT o_orderkey, b, left(b, 10) AS p10, b || '00' AS c14, left(b, 8) || lpad((o_orderkey % 30)::VARCHAR, 2, '0') || '00' AS v, '7' || b || '05' AS s, lpad((o_orderkey * 104729 % 100000000000)::VARCHAR, 11, '1') AS t FROM k),
m AS (SELECT *, p10 || {_mod(_weights('p10', pii.PIS_WEIGHTS))} AS p, left(c14, 12) || {_mod(_weights('c14', pii.CNPJ_WEIGHTS[1:]))} AS c13 FROM n),
x AS (SELECT *, c13 || {_mod(_weights('c13', pii.CNPJ_WEIGHTS))} AS c, left(v, 10) || {_V1} || {_V2} AS w FROM m)
SELECT o_orderkey, {_VARIED('p')} AS pis, {_VARIED('c')} AS cnpj, (o_orderkey % 30) BETWEEN 1 AND 28 AS voter, {_weights('s', list(range(15, 0, -1)))} % 11 = 0 AS card,
regexp_full_match(t, '[1-9]{{2}}9[0-9]{{8}}') AS phone FROM x"""
)
def check_digits_all(spark, sf_dir):
    """Numbers made with right digits are valid; the others are as their digits have it."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.lpad((F.col("o_orderkey") * 7919 % 1000000000000).cast("string"), 12, "0").alias("b"))
    o = o.withColumn("p10", F.left("b", F.lit(10))).withColumn("c14", F.concat("b", F.lit("00")))
    o = o.withColumn("v", F.concat(F.left("b", F.lit(8)), F.lpad((F.col("o_orderkey") % 30).cast("string"), 2, "0"), F.lit("00")))
    o = o.withColumn("p", F.concat("p10", pii._mod11(pii._sum(F.col("p10"), pii.PIS_WEIGHTS)).cast("string")))
    o = o.withColumn("c13", F.concat(F.left("c14", F.lit(12)), pii._mod11(pii._sum(F.col("c14"), pii.CNPJ_WEIGHTS[1:])).cast("string")))
    o = o.withColumn("c", F.concat("c13", pii._mod11(pii._sum(F.col("c13"), pii.CNPJ_WEIGHTS)).cast("string")))
    state = F.substring("v", 9, 2)
    digit = lambda t: F.when(t % 11 == 10, 0).when((t % 11 == 0) & state.isin("01", "02"), 1).otherwise(t % 11)
    first = digit(pii._sum(F.col("v"), list(range(2, 10))))
    second = digit(pii._sum(F.col("v"), [7, 8], 9) + first * 9)
    o = o.withColumn("w", F.concat(F.left("v", F.lit(10)), first.cast("string"), second.cast("string")))
    o = o.withColumn("s", F.concat(F.lit("7"), "b", F.lit("05"))).withColumn("t", F.lpad((F.col("o_orderkey") * 104729 % 100000000000).cast("string"), 11, "1"))
    c = F.col
    return o.select("o_orderkey", pii.valid_pis(c("p")).alias("pis"), pii.valid_cnpj(c("c")).alias("cnpj"), pii.valid_voter_id(c("w")).alias("voter"), pii.valid_health_card(c("s")).alias("card"), pii.valid_phone(c("t")).alias("phone"))


_MARKED = " OR ".join(f"contains(h, '{m}')" for m in robots.PAGE_MARKS)


@query(f"WITH p AS (SELECT page_id, lower(left(CASE WHEN page_id % 5 = 0 THEN '<title>Just a moment' || html ELSE html END, 20000)) AS h FROM pages) SELECT page_id, ({_MARKED}) AS challenge FROM p")
def challenge_pages(spark, sf_dir):
    """Every fifth page opens with a mark."""
    html = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("<title>Just a moment"), F.col("html"))).otherwise(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", robots.challenge_page(html).alias("challenge"))


@query(
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN false ELSE true END AS allowed,
CASE page_id % 6 WHEN 0 THEN 'sem_robots' WHEN 1 THEN 'http_503' WHEN 2 THEN 'robots_html_sem_regras' WHEN 3 THEN 'veto_robos_ia' WHEN 4 THEN 'bloqueia_nosso_agente' ELSE 'ok' END AS reason,
CASE WHEN page_id % 6 = 5 THEN 7.0 END::DOUBLE AS crawl_delay FROM pages"""
)
def robots_verdicts(spark, sf_dir):
    """Six kinds of answer, by page."""
    ship_package(spark)
    kinds = [(404, ""), (503, ""), (200, "<html>home</html>"), (200, "User-agent: GPTBot\nDisallow: /"), (200, "User-agent: *\nDisallow: /"), (200, "User-agent: *\nCrawl-delay: 7\nDisallow: /admin")]
    k = F.pmod("page_id", F.lit(6)).cast("int")
    p = read(spark, sf_dir, "pages").select("page_id", F.get(F.array(*[F.lit(s) for s, _ in kinds]), k).alias("s"), F.get(F.array(*[F.lit(b) for _, b in kinds]), k).alias("b"))
    return p.select("page_id", robots.verdicts(F.col("s"), F.col("b"), "corpusloom").alias("v")).select("page_id", "v.*")


@query(
    r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '^([A-Za-z]+://[^/]+)', 1) || '/bitstream/1/t.pdf' WHEN 1 THEN regexp_extract(url, '^([A-Za-z]+://[^/]+)', 1) || '/meta.pdf' WHEN 2 THEN 'https://files.org/a.PDF?x=1' ELSE regexp_extract(url, '^([A-Za-z]+://[^/]+)', 1) || '/report?id=3' END AS file FROM pages"""
)
def page_files(spark, sf_dir):
    """Pages with a link to a file of four kinds put before them; an internal host becomes the page's."""
    heads = ['<a href="/bitstream/1/t.pdf">x</a>', '<meta name="citation_pdf_url" content="http://localhost:8080/meta.pdf"><a href="/bitstream/2/u.pdf">', '<a class=x href="https://files.org/a.PDF?x=1">', '<object type="application/pdf" data="/report?id=3"></object>']
    html = F.concat(F.get(F.array(*map(F.lit, heads)), F.pmod("page_id", F.lit(4)).cast("int")), "html")
    return read(spark, sf_dir, "pages").select("page_id", fetch.page_file(html, F.col("url")).alias("file"))


_BARE = "translate(lower(left(text, 200)), 'áàâãäéèêëíìîïóòôõöúùûüçñ', 'aaaaaeeeeiiiiooooouuuucn')"


@query(f"SELECT doc_id, coalesce(nullif(left(trim(regexp_replace({_BARE}, '[^a-z0-9]+', '-', 'g'), '-'), 80), ''), 'sem-titulo') AS slug, left(sha1('id' || doc_id), 16) AS key, CASE WHEN regexp_extract('in ' || (1700 + doc_id % 500), '([0-9]{{4}})', 1)::INT BETWEEN 1800 AND 2099 THEN (1700 + doc_id % 500)::INT END AS year FROM documents")
def slugs_keys_years(spark, sf_dir):
    y = F.concat(F.lit("in "), (F.col("doc_id") % 500 + 1700).cast("string"))
    return read(spark, sf_dir, "documents").select("doc_id", T.slug(F.left("text", F.lit(200))).alias("slug"), T.short_hash(F.concat(F.lit("id"), F.col("doc_id").cast("string"))).alias("key"), T.year(y).alias("year"))


@query(rf"SELECT count(*)::BIGINT AS n_docs, avg(len(list_filter(string_split(text, E'\n'), lambda x: trim(x, ' ') <> ''))) AS mean_paragraphs, avg(len(regexp_extract_all(text, '{W}'))) AS mean_words FROM documents")
def shard_statistics(spark, sf_dir):
    return K.sample_statistics(read(spark, sf_dir, "documents").withColumnRenamed("source", "shard"), 1.0)


@query("SELECT doc_id, md5(text || chr(10) || '<|endoftext|>') AS line FROM documents")
def delimited_text(spark, sf_dir):
    return K.delimited(read(spark, sf_dir, "documents"), keep=("doc_id",)).select("doc_id", F.md5(F.col("value").cast("binary")).alias("line"))


@query("SELECT doc_id, true AS same FROM documents")
def bpe_round_trip(spark, sf_dir):
    """Texts to ids of a public vocabulary and back."""
    import public_tokenizers

    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents").withColumn("ids", K.encoded(F.col("text"), path))
    return docs.select("doc_id", (K.decoded(F.col("ids"), path) == F.col("text")).alias("same"))


@query("SELECT vec_id, list_sum(list_transform(range(0, 8), lambda c: (((vec_id + 1)::VARCHAR || '.' || ((c + 1) % 10)::VARCHAR)::DOUBLE)))::DECIMAL(38, 3) AS total FROM embeddings")
def position_sums(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings").select("vec_id", K.position_table(F.col("vec_id"), 8).alias("p"))
    return v.select("vec_id", F.aggregate("p", F.lit(0.0), lambda a, x: a + x).cast("decimal(38,3)").alias("total"))
