"""Queries over the test tables, each with the SQL that a second engine answers it by."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.operators import corpus as C
from corpusloom.operators import inventory as I
from corpusloom.operators import structure as S
from corpusloom.plans.registry import QUERIES, SQL, query, read
from corpusloom.sources import records as R
from corpusloom.storage import shared_dir
from corpusloom.streaming.ingest import file_stream, ingest

W = r"[\p{L}\p{N}_]+"


_KEYED = r"""keyed AS (SELECT doc_id, lang, text, length(text) AS n, sha256(lower(trim(regexp_replace(text, '\s+', ' ', 'g'), E' \n\t\r'))) AS key FROM documents),
best AS (SELECT key, count(*) AS members, arg_max(doc_id, (n, -doc_id)) AS survivor FROM keyed GROUP BY key)"""


@query(f"WITH {_KEYED}, kept AS (SELECT k.* FROM keyed k JOIN best b ON k.key = b.key AND k.doc_id = b.survivor), w AS (SELECT lang, len(regexp_extract_all(text, '{W}')) AS n FROM kept) SELECT lang, count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_words, median(n)::DOUBLE AS median_words, max(n)::BIGINT AS most_words FROM w GROUP BY lang")
def corpus_summary(spark, sf_dir):
    w = C.survivors(read(spark, sf_dir, "documents")).select("lang", F.size(T.words(F.col("text"))).alias("n"))
    return w.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_words"), F.median("n").alias("median_words"), F.max("n").cast("long").alias("most_words"))


@query("SELECT lang, count(*)::BIGINT AS n FROM documents GROUP BY lang")
def lang_value_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def top_sources(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(10)


@query(f"SELECT doc_id, len(regexp_extract_all(text, '{W}'))::BIGINT AS n_words FROM documents")
def word_count(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(T.words(F.col("text"))).cast("long").alias("n_words"))


def _listed(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


#: Function words of all test languages: their texts have no Portuguese.
_STOPS = tuple(sorted({w for stop in T.STOPWORDS.values() for w in stop}))
_LANGS = dict(sorted((T.STOPWORDS | {"pt": T.PT}).items()))
_VOTES = ", ".join(f"struct_pack(n := len(list_filter(w, lambda x: list_contains({_listed(stop)}, x))), lang := '{k}')" for k, stop in _LANGS.items())
_LANGUAGE = rf"""lw AS (SELECT doc_id, unnest(CASE WHEN length(text) > 9000 THEN [substr(text, floor(length(text) * 0.25)::INT + 1, 3000), substr(text, floor(length(text) * 0.5)::INT + 1, 3000), substr(text, floor(length(text) * 0.75)::INT + 1, 3000)] ELSE [left(text, 5000)] END) AS t FROM documents),
lv AS (SELECT doc_id, [{_VOTES}] AS v FROM (SELECT doc_id, regexp_extract_all(lower(t), '{W}') AS w FROM lw)),
lb AS (SELECT doc_id, list_max(list_transform(v, lambda x: x.n)) AS top, list_sum(list_transform(v, lambda x: x.n)) AS total, v FROM lv),
ls AS (SELECT doc_id, list_filter(v, lambda x: x.n = top)[1].lang AS lang, top / total AS p FROM lb WHERE top > 0),
lc AS (SELECT doc_id, lang, count(*) AS n, avg(p) AS p FROM ls GROUP BY ALL), lr AS (SELECT doc_id, arg_max(lang, (n, p, lang)) AS language, arg_max(p, (n, p, lang)) AS confidence FROM lc GROUP BY doc_id)"""
_METRICS = rf"""{_LANGUAGE}, m AS (SELECT doc_id, lang, regexp_extract_all(text, '{W}') AS w, list_filter(string_split(text, E'\n'), lambda x: regexp_matches(x, '\S')) AS l, text FROM documents),
counts AS (SELECT doc_id, lang, len(w)::BIGINT AS n_words, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}')))::BIGINT AS n_alphabetic,
len(list_filter(w, lambda x: length(x) <= 2))::BIGINT AS n_short, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '#|…|\.\.\.'))::BIGINT AS n_symbols,
length(text)::BIGINT AS n_chars, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_duplicate_lines, len(list_filter(w[1:3000], lambda x: list_contains({_listed(_STOPS)}, lower(x))))::BIGINT AS n_stopwords FROM m),
metrics AS (SELECT counts.*, coalesce(n_alphabetic / nullif(n_words, 0), 0) AS alphabetic_share, coalesce(n_symbols / nullif(n_words, 0), 1) AS symbol_share, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word,
coalesce(n_duplicate_lines / nullif(n_lines, 0), 1) AS duplicate_line_share, coalesce(n_short / nullif(n_words, 0), 1) AS short_share, coalesce(n_words / nullif(n_lines, 0), 0) AS words_a_line,
coalesce(language, 'un') AS language, coalesce(confidence, 0) AS confidence FROM counts LEFT JOIN lr USING (doc_id))"""

def _metrics(spark, sf_dir):
    return C.metrics(read(spark, sf_dir, "documents"), _STOPS)


@query(f"WITH {_METRICS} SELECT * REPLACE (floor(confidence * 1000)::BIGINT AS confidence) FROM metrics")
def quality_metrics(spark, sf_dir):
    """Shares as they are; the confidence in thousandths."""
    return _metrics(spark, sf_dir).withColumn("confidence", F.floor(F.col("confidence") * 1000))


_REASONS = f"""r AS (SELECT doc_id, language, confidence, list_filter([CASE WHEN n_words < 20 THEN '{C.REASONS[0]}' END, CASE WHEN n_words > 400000 THEN '{C.REASONS[1]}' END,
CASE WHEN alphabetic_share < 0.75 THEN '{C.REASONS[2]}' END, CASE WHEN symbol_share > 0.10 THEN '{C.REASONS[3]}' END, CASE WHEN mean_word NOT BETWEEN 3.0 AND 10.0 THEN '{C.REASONS[4]}' END,
CASE WHEN n_stopwords < 8 THEN '{C.REASONS[5]}' END, CASE WHEN duplicate_line_share > 0.30 THEN '{C.REASONS[6]}' END, CASE WHEN short_share > 0.55 THEN '{C.REASONS[7]}' END,
CASE WHEN words_a_line < 3.0 THEN '{C.REASONS[8]}' END, CASE WHEN language <> 'en' THEN 'idioma_' || language || '_' || printf('%.2f', floor(confidence * 100 + 0.5) / 100) END], lambda x: x IS NOT NULL) AS reasons FROM metrics)"""


@query(f"WITH {_METRICS}, {_REASONS} SELECT doc_id, array_to_string(reasons, '|') AS reasons, len(reasons) = 0 AS approved, CASE WHEN language = 'en' AND confidence < 0.65 THEN 'confianca_baixa_' || printf('%.2f', floor(confidence * 100 + 0.5) / 100) END AS language_alert FROM r")
def quality_decision(spark, sf_dir):
    """The rules over texts of the test languages: 20 words at least, English expected."""
    return C.decide(_metrics(spark, sf_dir), "en", least=20)


@query(f"WITH {_METRICS} SELECT doc_id, n_lines, n_duplicate_lines FROM metrics WHERE n_duplicate_lines > 0")
def duplicate_line_ratio(spark, sf_dir):
    return _metrics(spark, sf_dir).where("n_duplicate_lines > 0").select("doc_id", "n_lines", "n_duplicate_lines")


def _stop_sql() -> str:
    counts = ", ".join(f"len(list_filter(w, lambda x: list_contains([{', '.join(repr(s) for s in stop)}], x)))::BIGINT AS n_{lang}" for lang, stop in sorted(T.STOPWORDS.items()))
    langs = sorted(T.STOPWORDS)
    best = f"greatest({', '.join('n_' + x for x in langs)})"
    guess = " ".join(f"WHEN n_{x} = {best} THEN '{x}'" for x in langs)
    return f"WITH w AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '{W}') AS w FROM documents), c AS (SELECT doc_id, lang, {counts} FROM w) SELECT *, CASE WHEN {best} = 0 THEN 'unknown' {guess} END AS guess FROM c"


@query(_stop_sql())
def stopword_language_score(spark, sf_dir):
    return C.stopword_scores(read(spark, sf_dir, "documents"))


@query(f"WITH {_METRICS} SELECT quality, toxic, count(*)::BIGINT AS n, sum(n_words)::BIGINT AS n_words FROM metrics JOIN labels USING (doc_id) GROUP BY quality, toxic")
def quality_vs_labels(spark, sf_dir):
    m = _metrics(spark, sf_dir).join(read(spark, sf_dir, "labels"), "doc_id")
    return m.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("n_words"))


@query(f"WITH {_KEYED} SELECT key, members::BIGINT AS members, survivor FROM best WHERE members > 1")
def exact_dup_groups(spark, sf_dir):
    return C.exact_map(read(spark, sf_dir, "documents")).where("members > 1").select("key", "members", "survivor").distinct()


@query(f"WITH {_KEYED} SELECT doc_id, survivor FROM keyed JOIN best USING (key)")
def exact_dedup_map(spark, sf_dir):
    return C.exact_map(read(spark, sf_dir, "documents")).select("doc_id", "survivor")


@query(f"WITH {_KEYED} SELECT doc_id, lang FROM keyed JOIN best USING (key) WHERE doc_id = survivor")
def exact_survivors(spark, sf_dir):
    return C.survivors(read(spark, sf_dir, "documents")).select("doc_id", "lang")


@query(
    r"""WITH p AS (SELECT doc_id, list_filter(list_transform(string_split(text, E'\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS p FROM documents),
k AS (SELECT doc_id, p, list_transform(p, lambda x: left(regexp_replace(lower(x), '[^\p{L}\p{N}_]+', '', 'g'), 400)) AS k FROM p),
f AS (SELECT doc_id, p, list_filter(p, lambda x, i: length(k[i]) < 60 OR list_position(k, k[i]) = i) AS kept FROM k),
s AS (SELECT doc_id, len(p) AS n, len(p) - len(kept) AS removed, round((len(p) - len(kept)) / greatest(len(p), 1), 4) AS share, kept FROM f)
SELECT doc_id, n::BIGINT AS paragraphs, removed::BIGINT AS removed, share, share > 0.30 AS rejected, md5(array_to_string(kept, E'\n')) AS kept FROM s"""
)
def internal_repetition(spark, sf_dir):
    """Lines for paragraphs: the test texts have no blank lines."""
    return C.internal_repetition(read(spark, sf_dir, "documents"), "\n").withColumn("kept", F.md5("text")).drop("text")


def _shingle_sql(table: str, key: str, n: int, name: str) -> str:
    return f"{name}_w AS (SELECT {key}, regexp_extract_all(lower(text), '{W}') AS w FROM {table}), {name} AS (SELECT DISTINCT {key}, array_to_string(w[i:i + {n - 1}], ' ') AS shingle FROM (SELECT {key}, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {name}_w WHERE len(w) >= {n}))"


@query(f"WITH {_shingle_sql('documents', 'doc_id', 5, 's')} SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id")
def shingle_counts(spark, sf_dir):
    return C.shingles(read(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_shingle_sql('documents', 'doc_id', 8, 'a')}, {_shingle_sql('benchmark', 'item_id', 8, 'b')} SELECT doc_id, item_id, count(*)::BIGINT AS shared FROM a JOIN b USING (shingle) GROUP BY doc_id, item_id HAVING count(*) >= 5")
def decontaminate(spark, sf_dir):
    return C.decontaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def near_dup_components(spark, sf_dir):
    return C.fuzzy_components(read(spark, sf_dir, "documents")).select(F.col("node").alias("doc_id"), "component")


@query()
def near_dup_survivors(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = C.fuzzy_components(docs).join(docs.select(F.col("doc_id").alias("node"), F.length("text").alias("n")), "node")
    best = found.groupBy("component").agg(F.max(F.struct("n", (-F.col("node")).alias("neg"))).alias("b"))
    removed = found.join(best, "component").where(F.col("node") != -F.col("b.neg")).select(F.col("node").alias("doc_id"))
    return docs.join(removed, "doc_id", "left_anti").select("doc_id")


_MAIL = T.EMAIL


@query(f"SELECT doc_id, len(regexp_extract_all(text, '{_MAIL}'))::BIGINT AS n FROM documents WHERE regexp_matches(text, '{_MAIL}')")
def pii_email_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(F.col("text").rlike(_MAIL)).select("doc_id", F.size(F.regexp_extract_all("text", F.lit(_MAIL), F.lit(0))).cast("long").alias("n"))


@query(f"SELECT doc_id, md5(regexp_replace(text, '{_MAIL}', '[EMAIL]', 'g')) AS masked FROM documents")
def pii_email_masked(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.masked_emails(F.col("text")).cast("binary")).alias("masked"))


def _cpf_sql() -> str:
    first = "+".join(f"substr(d, {i + 1}, 1)::INT * {10 - i}" for i in range(9))
    second = "+".join(f"substr(d, {i + 1}, 1)::INT * {11 - i}" for i in range(10))
    digit = lambda s: f"(CASE WHEN ({s}) % 11 < 2 THEN 0 ELSE 11 - ({s}) % 11 END)"
    return f"WITH c AS (SELECT o_orderkey, lpad((o_orderkey * 97 % 100000000000)::VARCHAR, 11, '0') AS d FROM orders) SELECT o_orderkey, length(replace(d, substr(d, 1, 1), '')) > 0 AND substr(d, 10, 1)::INT = {digit(first)} AND substr(d, 11, 1)::INT = {digit(second)} AS valid FROM c"


@query(_cpf_sql())
def check_digit_table(spark, sf_dir):
    d = F.lpad((F.col("o_orderkey") * 97 % 100000000000).cast("string"), 11, "0")
    return read(spark, sf_dir, "orders").select("o_orderkey", T.valid_cpf(d).alias("valid"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'), E' \n\t\r')) AS plain FROM documents")
def whitespace_normalized(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.collapsed(F.col("text")).cast("binary")).alias("plain"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[^\P{C}\n\t]', '', 'g')) AS plain FROM documents")
def control_stripped(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.without_controls(F.col("text")).cast("binary")).alias("plain"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[.\-_•·]{4,}', ' ', 'g')) AS plain FROM documents")
def leader_runs(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.without_leaders(F.col("text")).cast("binary")).alias("plain"))


@query("SELECT page_id, len(l)::BIGINT AS n_links, coalesce(l[1], '') AS first_link FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS l FROM pages)")
def html_links(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return read(spark, sf_dir, "pages").select("page_id", F.size(links).cast("long").alias("n_links"), F.coalesce(F.get(links, 0), F.lit("")).alias("first_link"))


_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1))"


@query(f"SELECT {_HOST} AS host, count(*)::BIGINT AS n FROM pages GROUP BY 1")
def url_host(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(T.host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query(r"SELECT page_id, regexp_replace(replace(url, '/en/', '//en//'), '([^:/])/{2,}', '\1/', 'g') AS url FROM pages")
def double_slash_fix(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.single_slashes(F.replace(F.col("url"), F.lit("/en/"), F.lit("//en//"))).alias("url"))


@query(rf"SELECT page_id, {_HOST} = '' OR regexp_matches({_HOST}, '^(localhost|127\.|10\.|192\.168\.|169\.254\.|0\.0\.0\.0|172\.(1[6-9]|2[0-9]|3[01])\.)') AS internal FROM pages")
def internal_host_filter(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.internal_host(T.host(F.col("url"))).alias("internal"))


_SPLIT = "g AS (SELECT source, lang, count(*) AS members FROM documents GROUP BY ALL), r AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || coalesce(source, '') || '|' || coalesce(lang, '')), source, lang) AS k, count(*) OVER () AS n FROM g), s AS (SELECT source, lang, members::BIGINT AS members, CASE WHEN k <= floor(n * 0.90) THEN 'train' WHEN k <= floor(n * 0.90) + floor(n * 0.05) THEN 'validation' ELSE 'test' END AS split FROM r)"


@query(f"WITH {_SPLIT} SELECT * FROM s")
def group_split(spark, sf_dir):
    return C.split_by_group(read(spark, sf_dir, "documents"), ["source", "lang"])


@query(f"WITH {_SPLIT} SELECT split, count(*)::BIGINT AS n_groups, sum(members)::BIGINT AS n_docs FROM s GROUP BY split")
def split_counts(spark, sf_dir):
    s = C.split_by_group(read(spark, sf_dir, "documents"), ["source", "lang"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("members").alias("n_docs"))


_CHUNKS = r"t AS (SELECT doc_id, regexp_extract_all(text, '\s*\S+') AS t FROM documents), c AS (SELECT doc_id, t, unnest(range(0, len(t), 90)) AS start FROM t WHERE len(t) > 0), k AS (SELECT doc_id, (start // 90)::BIGINT AS chunk, t[start + 1:start + 100] AS part FROM c), chunks AS (SELECT doc_id, chunk, len(part)::BIGINT AS words, regexp_replace(array_to_string(part, ''), '^\s+', '') AS text FROM k WHERE len(part) >= 50 OR chunk = 0)"


@query(f"WITH {_CHUNKS} SELECT doc_id, chunk, words, md5(text) AS digest FROM chunks")
def rag_chunks(spark, sf_dir):
    return C.chunks(read(spark, sf_dir, "documents")).select("doc_id", "chunk", "words", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(f"WITH {_CHUNKS} SELECT doc_id, count(*)::BIGINT AS n FROM chunks GROUP BY doc_id")
def chunk_counts(spark, sf_dir):
    return C.chunks(read(spark, sf_dir, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, lang || '-' || lpad(((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 500)::VARCHAR, 4, '0') AS shard FROM documents")
def pretrain_shards(spark, sf_dir):
    return C.shards(read(spark, sf_dir, "documents"))


@query(f"WITH w AS (SELECT doc_id, regexp_extract_all(text, '{W}') AS t FROM documents), s AS (SELECT doc_id, t, unnest(range(0, len(t) - 32, 16)) AS start FROM w WHERE len(t) > 32) SELECT doc_id, start::BIGINT AS start, md5(array_to_string(t[start + 1:start + 32], ' ')) AS input, md5(array_to_string(t[start + 2:start + 33], ' ')) AS target FROM s")
def token_windows(spark, sf_dir):
    return C.token_windows(read(spark, sf_dir, "documents")).select("doc_id", "start", F.md5("input").alias("input"), F.md5("target").alias("target"))


@query("SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS answer FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant' AND length(a.text) >= 200")
def sft_pairs(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    a = c.where("role = 'assistant'").where(F.length("text") >= 200).select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt")).join(a, ["conv_id", "turn"]).select("conv_id", "turn", "prompt", "answer")


@query("SELECT 'ret-' || doc_id AS id, left(text, 800) AS query, doc_id AS gold FROM documents WHERE length(text) > 300 ORDER BY md5('42|' || doc_id), doc_id LIMIT 300")
def bench_retrieval(spark, sf_dir):
    d = read(spark, sf_dir, "documents").where(F.length("text") > 300)
    d = d.orderBy(T.seeded_order(42, F.col("doc_id")), "doc_id").limit(300)
    return d.select(F.concat(F.lit("ret-"), F.col("doc_id")).alias("id"), F.left("text", F.lit(800)).alias("query"), F.col("doc_id").alias("gold"))


@query(f"SELECT 'ppl-' || doc_id AS id, array_to_string(regexp_extract_all(text, '{W}')[1:1024], ' ') AS text FROM (SELECT * FROM documents ORDER BY md5('13|' || doc_id), doc_id LIMIT 200)")
def bench_perplexity(spark, sf_dir):
    d = read(spark, sf_dir, "documents").orderBy(T.seeded_order(13, F.col("doc_id")), "doc_id").limit(200)
    return d.select(F.concat(F.lit("ppl-"), F.col("doc_id")).alias("id"), F.array_join(F.slice(T.words(F.col("text")), 1, 1024), " ").alias("text"))


@query(
    """WITH pool AS (SELECT DISTINCT source FROM documents), d AS (SELECT doc_id, source FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 150),
x AS (SELECT d.doc_id, d.source, p.source AS other, row_number() OVER (PARTITION BY d.doc_id ORDER BY md5('7|' || d.doc_id || '|' || p.source), p.source) AS k FROM d JOIN pool p ON p.source <> d.source)
SELECT 'mc-' || doc_id AS id, source AS answer, string_agg(other, '|' ORDER BY k) AS distractors FROM x WHERE k <= 3 GROUP BY doc_id, source"""
)
def bench_multiple_choice(spark, sf_dir):
    """Three wrong sources for each sampled document, from the pool of all sources.

    The pool is a column of few values; the sample has at most 150 rows, so the product is bounded by them.
    """
    docs = read(spark, sf_dir, "documents")
    pool = docs.agg(F.array_sort(F.collect_set("source")).alias("pool"))
    d = docs.orderBy(T.seeded_order(42, F.col("doc_id")), "doc_id").limit(150).select("doc_id", "source", F.lit(1).alias("one"))
    x = d.join(pool.withColumn("one", F.lit(1)), "one")
    order = lambda s: F.struct(F.md5(F.concat(F.lit("7|"), F.col("doc_id"), F.lit("|"), s)).alias("h"), s.alias("s"))
    others = F.slice(F.array_sort(F.transform(F.filter("pool", lambda s: s != F.col("source")), order)), 1, 3)
    return x.select(F.concat(F.lit("mc-"), F.col("doc_id")).alias("id"), F.col("source").alias("answer"), F.array_join(F.transform(others, lambda o: o.s), "|").alias("distractors"))


_QUOTA = "p AS (SELECT o_orderstatus, o_orderpriority, count(*) AS population FROM orders GROUP BY ALL), q AS (SELECT *, greatest(1, round_even(1000 * population / (SELECT count(*) FROM orders), 0))::BIGINT AS quota FROM p), quotas AS (SELECT o_orderstatus, o_orderpriority, population::BIGINT AS population, quota, least(population, quota * 4)::BIGINT AS queue FROM q)"


@query(f"WITH {_QUOTA} SELECT * FROM quotas")
def stratum_quotas(spark, sf_dir):
    return I.quotas(read(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], 1000)


@query(f"WITH {_QUOTA}, r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY md5('42|' || o_orderkey), o_orderkey) - 1 AS position FROM orders) SELECT o_orderkey, position::BIGINT AS position, position < quota AS in_quota FROM r JOIN quotas USING (o_orderstatus, o_orderpriority) WHERE position < queue")
def stratified_sample(spark, sf_dir):
    return I.stratified(read(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], "o_orderkey", 1000).select("o_orderkey", "position", "in_quota")


@query("SELECT c_custkey, c_nationkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY md5('42|' || c_custkey), c_custkey) <= 10")
def cap_per_group(spark, sf_dir):
    return I.capped(read(spark, sf_dir, "customer"), ["c_nationkey"], "c_custkey", 10).select("c_custkey", "c_nationkey")


@query(
    """WITH e AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS p FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM e)), m AS (SELECT o_orderpriority, max(p) AS last FROM e GROUP BY 1)
SELECT o_orderkey, o_orderpriority, (coalesce(last, -1) + row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey))::BIGINT AS position FROM n LEFT JOIN m USING (o_orderpriority)"""
)
def merge_candidates(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    queue = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority").withColumn("position", (F.row_number().over(Window.partitionBy("o_orderpriority").orderBy("o_orderkey")) - 1).cast("long"))
    new = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderpriority")
    return I.appended(queue, new, "o_orderkey", "o_orderpriority", "position").select("o_orderkey", "o_orderpriority", "position")


@query("SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 200)::BIGINT AS round FROM orders")
def round_robin_plan(spark, sf_dir):
    return I.rounds(read(spark, sf_dir, "orders"), "o_orderpriority", F.col("o_orderkey"), 200).select("o_orderkey", "round")


@query("SELECT p_brand, p_size, count(*)::BIGINT AS members FROM part GROUP BY ALL HAVING count(*) BETWEEN 2 AND 400")
def linkage_blocks(spark, sf_dir):
    return read(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("members")).where("members between 2 and 400")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b, levenshtein(a.p_name, b.p_name)::BIGINT AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE levenshtein(a.p_name, b.p_name) <= 2")
def linkage_pairs(spark, sf_dir):
    return I.linkage_pairs(read(spark, sf_dir, "part"), "p_partkey", "p_name", F.concat("p_brand", F.lit("|"), F.col("p_size").cast("string")))


@query("SELECT p_brand, arg_max(p_partkey, (p_size, -p_partkey)) AS best, max(p_retailprice) AS price, count(*)::BIGINT AS members FROM part GROUP BY p_brand")
def golden_record(spark, sf_dir):
    best = F.max_by("p_partkey", F.struct("p_size", (-F.col("p_partkey")).alias("n")))
    return read(spark, sf_dir, "part").groupBy("p_brand").agg(best.alias("best"), F.max("p_retailprice").alias("price"), F.count(F.lit(1)).alias("members"))


_IN = ("license", "general public", "rights reserved")
_OUT = ("idiot", "trash", "scum")


@query(f"SELECT doc_id FROM documents WHERE {' OR '.join(f'''contains(lower(text), '{x}')''' for x in _IN)}")
def scope_include(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(T.any_term(F.lower("text"), _IN)).select("doc_id")


@query("WITH p AS (SELECT doc_id, '_' || regexp_replace(replace(lower(text), 'trash bin', ' '), '[^a-z0-9]+', '_', 'g') || '_' AS t FROM documents) SELECT doc_id, " + " OR ".join(f"contains(t, '_{x}_')" for x in _OUT) + " AS excluded FROM p")
def scope_exclude(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.any_word(F.col("text"), _OUT, ("trash bin",)).alias("excluded"))


@query("SELECT doc_id, lang AS lang_raw, CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' WHEN 'es' THEN 'spa' END AS lang FROM documents")
def standardized_vocab(spark, sf_dir):
    codes = {"en": "eng", "fr": "fra", "de": "deu", "es": "spa"}
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("lang_raw"), table[F.col("lang")].alias("lang"))


@query("SELECT (y // 5 * 5)::VARCHAR || '-' || (y // 5 * 5 + 4)::VARCHAR AS band, count(*)::BIGINT AS n FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY 1")
def year_band(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(T.year_band(F.year("o_orderdate")).alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def integrity_orphans(spark, sf_dir):
    return I.orphans(read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_orderstatus = 'P'"), "c_custkey", "o_custkey").select("c_custkey")


@query("SELECT count(*)::BIGINT AS broken FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 3)")
def integrity_fk(spark, sf_dir):
    """Orders whose key ends in 3 are taken away first, so that some lines are broken."""
    return I.orphans(read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders").where("o_orderkey % 10 <> 3"), "l_orderkey", "o_orderkey").agg(F.count(F.lit(1)).alias("broken"))


@query("SELECT (count(*) - count(DISTINCT (p_name, p_size)))::BIGINT AS repeated FROM part")
def repeated_titles(spark, sf_dir):
    return read(spark, sf_dir, "part").agg((F.count(F.lit(1)) - F.count_distinct("p_name", "p_size")).alias("repeated"))


@query(
    """WITH e AS (SELECT user_id, ts, event_id, (event_type = 'error')::INT AS bad FROM events), r AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM e),
g AS (SELECT user_id, run, sum(bad) AS length, count(*) AS n FROM r GROUP BY ALL) SELECT user_id, max(length)::BIGINT AS longest_run, sum(n)::BIGINT AS attempts, sum(length)::BIGINT AS failures FROM g GROUP BY user_id"""
)
def breaker_runs(spark, sf_dir):
    return I.failure_runs(read(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query("SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL")
def facet_counts(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT conv_id, array_to_string(list(role ORDER BY turn)[1:12], '; ') AS roles FROM conversations GROUP BY conv_id")
def group_concat_topn(spark, sf_dir):
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.slice(ordered, 1, 12), lambda x: x.role), "; ").alias("roles"))


@query("SELECT conv_id, arg_min(text, turn) AS first_text FROM conversations GROUP BY conv_id")
def first_per_group(spark, sf_dir):
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("first_text"))


@query(
    """WITH b AS (SELECT min(o_orderdate)::DATE AS low, max(o_orderdate)::DATE AS high FROM orders),
w AS (SELECT unnest(range(0, date_diff('day', low, high) + 1, 30)) AS d, low, high FROM b),
n AS (SELECT date_diff('day', low, o_orderdate::DATE) // 30 AS position, count(*) AS n FROM orders, b GROUP BY ALL)
SELECT (d // 30)::BIGINT AS position, (low + d::INTEGER)::DATE AS first_day, least(low + d::INTEGER + 29, high)::DATE AS last_day, coalesce(n, 0)::BIGINT AS n FROM w LEFT JOIN n ON n.position = d // 30"""
)
def harvest_windows(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    bounds = orders.agg(F.min("day").alias("low"), F.max("day").alias("high"))
    place = F.floor(F.datediff("day", "low") / 30).alias("position")
    n = orders.join(F.broadcast(bounds), how="cross").groupBy(place).agg(F.count(F.lit(1)).alias("n"))  # bounds is one row
    return R.date_windows(bounds, 30).join(n, "position", "left").select("position", "first_day", "last_day", F.coalesce("n", F.lit(0)).alias("n"))


def _gate_sql() -> str:
    leaves = {"documents": ("text", "lang", "source"), "conversations": ("role", "text"), "pages": ("url", "html")}
    one = lambda t, c, d, p: f"SELECT '{t}' AS product, '{c}' AS path, '{d}' AS detector, coalesce(sum(len(regexp_extract_all({c}, '{p}'))), 0)::BIGINT AS hits FROM {t}"
    return "SELECT * FROM (" + " UNION ALL ".join(one(t, c, d, p) for t, cs in leaves.items() for c in cs for d, p in S.DETECTORS.items()) + ") WHERE hits > 0"


@query(_gate_sql())
def pii_gate_hits(spark, sf_dir):
    a, b, c = (S.gate_hits(read(spark, sf_dir, t), t) for t in ("documents", "conversations", "pages"))
    return a.unionByName(b).unionByName(c)


@query(
    """WITH p AS (SELECT conv_id, turn, list_filter(list_transform(string_split('Running head' || chr(10) || text || chr(10) || 'page foot', E'\\n'), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM conversations),
e AS (SELECT DISTINCT conv_id, turn, unnest(list_concat(l[1:2], l[-2:])) AS line FROM p),
c AS (SELECT conv_id, line, count(*)::BIGINT AS n_pages FROM e WHERE length(line) BETWEEN 3 AND 120 GROUP BY ALL), n AS (SELECT conv_id, count(DISTINCT turn) AS pages FROM conversations GROUP BY conv_id)
SELECT conv_id, line, n_pages FROM c JOIN n USING (conv_id) WHERE pages >= 4 AND n_pages >= greatest(floor(pages * 0.6::DOUBLE), 3)"""
)
def page_edge_lines(spark, sf_dir):
    """Conversations as pages, each with a running head and foot."""
    pages = read(spark, sf_dir, "conversations").withColumn("text", F.concat(F.lit("Running head\n"), F.col("text"), F.lit("\npage foot")))
    return S.page_edges(pages, "conv_id", "turn", "text")


@query("SELECT event_type, count(*)::BIGINT AS n, min(event_id)::BIGINT AS first_event FROM (SELECT DISTINCT event_id, event_type FROM events) GROUP BY event_type")
def streamed_events(spark, sf_dir):
    into = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    stream = file_stream(spark, sf_dir, read(spark, sf_dir, "events").schema, "parquet", "events.parquet")
    taken = ingest(stream, f"{into}/table", ["event_id"], f"{into}/state")
    return taken.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from corpusloom.plans import records, texts  # noqa: F401 - they register theirs

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
