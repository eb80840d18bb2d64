"""Operators on records and their sources, against worked examples and made-up networks."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import normalize, pii, robots
from corpusloom.functions import text as T
from corpusloom.operators import corpus, curated, inventory, linkage, neardup, processed, reports, staging
from corpusloom.sources import fetch, oai, search, tables


def _with_check(body, digit):
    return body + str(digit)


def test_check_digits():
    rng = random.Random(1)
    for _ in range(50):
        b = "".join(str(rng.randrange(10)) for _ in range(12))
        c = b[:9]
        for n in (9, 10):
            c += str(pii._check(sum(int(d) * w for d, w in zip(c, range(n + 1, 1, -1), strict=True))))
        assert pii.cpf(c) and not pii.cpf(c[:-1] + str((int(c[-1]) + 1) % 10))
        p = b[:10] + str(pii._check(sum(int(d) * w for d, w in zip(b, pii.PIS_WEIGHTS, strict=False))))
        assert pii.pis(p) and not pii.pis(p[:-1] + str((int(p[-1]) + 1) % 10))
    assert pii.cpf("52998224725") and not pii.cpf("11111111111") and pii.cnpj("11222333000181") and not pii.cnpj("11222333000182")
    assert pii.phone("8632155678") and pii.phone("5586999991234") and not pii.phone("0632155678") and not pii.phone("8620082009")


def test_check_digit_columns_equal_functions(spark):
    rng = random.Random(2)
    rows = [("".join(str(rng.randrange(10)) for _ in range(n)),) for n in (8, 10, 11, 12, 12, 13, 14, 15) for _ in range(60)] + [("529982247250"[:11],), ("11222333000181",), ("8632155678",), ("",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    for column, f in ((pii.valid_cnpj, pii.cnpj), (pii.valid_pis, pii.pis), (pii.valid_voter_id, pii.voter_id), (pii.valid_health_card, pii.health_card), (pii.valid_phone, pii.phone)):
        assert all(bool(r.v) == bool(r.d and f(r.d)) for r in df.select("d", column(F.col("d")).alias("v")).collect())


@pytest.mark.parametrize("kept", ["código 0101020058", "PEG6000 e ABC", "2008\n2009", "0000-0002-1825-0097", "doi:10.1590/1234567890123", "2010 2011 2012 2013", "RG 2050"])
def test_numbers_that_are_no_personal_data_stay(kept):
    assert pii.masked(kept).text == kept


@pytest.mark.parametrize("phone", ["(86) 3215-5678", "(86)\n3215-5678", "+55 86 99999-1234", "+55 (86) 3215 5678", "86 3215-5678"])
def test_phones_are_masked(phone):
    assert pii.masked(f"tel {phone} fim").text == "tel [TELEFONE] fim"


def test_masks_contexts_and_strategies(spark):
    t = "a.b@x.org ligou: CPF 529.982.247-25; https://www.linkedin.com/in/ana https://x.com.br/q?a=52998224725 CEP 64000-040"
    got = pii.masked(t)
    assert got.counts == {"EMAIL": 1, "URL_PERFIL": 1, "CPF": 1, "CEP": 1} and "52998224725" in got.text and pii.masked(got.text).text == got.text
    assert all("529.982" not in c and "a.b@" not in c for _, c in got.contexts)
    assert "[" not in pii.masked(t, strategy="remove").text and pii.masked(t, frozenset({"CEP"})).counts == {"CEP": 1}
    assert pii.masked("x@y.org", strategy="hash").text.startswith("[EMAIL:")
    with pytest.raises(ValueError):
        pii.masked(t, frozenset())
    names = lambda part: [(part.index("Ana"), part.index("Ana") + 3)] if "Ana" in part else []
    rows = spark.createDataFrame([("Ana a@b.org",), (None,), ("",)], "t string").select(pii.personal(F.col("t"), recognise=names).alias("p")).collect()
    assert rows[0].p.text == "[NOME] [EMAIL]" and rows[0].p.counts == {"EMAIL": 1, "NOME": 1} and rows[1].p.text is None and rows[2].p.text == ""


def test_normalisation(spark):
    pages = "\f".join(f"Cabeçalho\nlinha {p} do texto\n{p}" for p in range(5))
    text = "ﬁm da arqui-\ntetura … ok\u200b\nSumário ........ 9\n\n\n\nfim &amp; &eacute;" + "\f" + pages
    rows = [(1, text), (2, None), (3, ""), (4, "e\u0301 cafÃ©")]
    got = dict(spark.createDataFrame(rows, "k int, t string").select("k", normalize.plain(F.col("t"), front=False, back=False)).collect())
    assert got[1].startswith("fim da arquitetura ... ok\nSumário 9\n\nfim & &eacute;") and "Cabeçalho" not in got[1] and got[2] is None and got[3] == ""
    full = dict(normalize.with_plain(spark.createDataFrame(rows, "k int, t string"), "t", front=False, back=False).collect())
    assert "fim & é" in full[1] and full[2] is None
    framed = "capa\nRESUMO\n" + "corpo do texto\n" * 40 + "5.7 REFERÊNCIAS\nA\n" + "mais corpo\n" * 5 + "6 REFERÊNCIAS\nB\nANEXO A - X\nfim"
    annex = "RESUMO\n" + "corpo do texto\n" * 40 + "ANEXO A\nx\nANEXO B\ny"
    cut = [r[0] for r in spark.createDataFrame([(framed,), (annex,)], "t string").select(normalize.plain(F.col("t"))).collect()]
    assert cut[0].startswith("RESUMO") and cut[0].endswith("mais corpo") and cut[1].endswith("corpo do texto")


@pytest.mark.parametrize(
    ("status", "body", "want"),
    [
        (None, "", (False, "inacessivel")), (200, "please solve the captcha", (False, "desafio_anti_robo")), (404, "", (True, "sem_robots")), (410, "", (True, "sem_robots")), (403, "", (False, "http_403")), (503, "", (False, "http_503")),
        (200, "<!doctype html><html>", (True, "robots_html_sem_regras")), (200, "User-agent: GPTBot\nUser-agent: Other\nDisallow: /x", (False, "veto_robos_ia")), (200, "User-agent: GPTBot\nDisallow:", (True, "ok")),
        (200, "User-agent: *\nDisallow: /", (False, "bloqueia_nosso_agente")), (200, "User-agent: *\nCrawl-delay: 5\nDisallow: /admin", (True, "ok")),
    ],
)
def test_robots(status, body, want):
    assert robots.verdict(status, body, "ours")[:2] == want


def test_robots_evidence_is_captured_and_applied(spark):
    pages = spark.createDataFrame([("https://a.org/1",), ("https://a.org/2",), ("https://b.org/1",), (None,)], "url string")
    evidence = robots.capture(pages, "url", lambda url: (200, "User-agent: *\nDisallow: /") if "b.org" in url else (404, ""), "ours")
    assert {r.origin: r.reason for r in evidence.collect()} == {"https://a.org": "sem_robots", "https://b.org": "bloqueia_nosso_agente"}
    assert robots.permitted(pages.where("url is not null"), "url", evidence).count() == 2


def test_internal_hosts(spark):
    urls = {"http://localhost:4000/x": True, "http://10.0.0.1/": True, "http://x.localhost/": True, "http://[::1]/": True, "http://172.20.1.1/": True, "https://repo.org/": False, "http://172.40.1.1/": False, "": True}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", T.internal_host(T.host(F.col("u"))).alias("i")).collect()
    assert {r.u: r.i for r in got} == urls and all(fetch.internal(h) for h in ("", "127.0.0.1", "fe80::1")) and not fetch.internal("repo.org")


def _oai(records):
    """An endpoint that fails on some days and gives two records a page."""

    def transport(url, asked):
        if asked["verb"] == "ListRecords":
            if "resumptionToken" in asked:
                assert set(asked) == {"verb", "resumptionToken"}
                a, b, at = asked["resumptionToken"].split("|")
            else:
                a, b, at = asked["from"], asked["until"], 0
            days = [d for d in sorted(records) if a <= d <= b]
            if any(records[d] is None for d in days):
                return 500, {}, ""
            every = [(d, n) for d in days for n in records[d]]
            if not every:
                return 200, {}, f'<OAI-PMH xmlns="{oai.NS["oai"]}"><error code="noRecordsMatch"/></OAI-PMH>'
            at = int(at)
            rows = "".join(f'<record><header{" status=\"deleted\"" if n < 0 else ""}><identifier>r{n}</identifier></header></record>' for _, n in every[at : at + 2])
            token = f"<resumptionToken>{a}|{b}|{at + 2}</resumptionToken>" if at + 2 < len(every) else ""
            return 200, {}, f'<OAI-PMH xmlns="{oai.NS["oai"]}"><ListRecords>{rows}{token}</ListRecords></OAI-PMH>'
        raise AssertionError(asked)

    return transport


def test_oai_windows_are_halved_around_a_broken_day(spark):
    first = date(2024, 1, 1)
    days = {(first + timedelta(k)).isoformat(): [3 * k, 3 * k + 1, -1, 0] for k in range(20)}
    days["2024-01-07"] = None
    got = oai.windowed(oai.Client("http://e", _oai(days), tries=1), "oai_dc", first, first + timedelta(19), 10)
    assert set(got.records) == {f"r{n}" for d in days.values() if d for n in d if n >= 0} and [(a, b) for a, b, _ in got.lost] == [(date(2024, 1, 7),) * 2] and not got.stopped
    dead = oai.windowed(oai.Client("http://e", lambda *a: (500, {}, ""), tries=1), "x", first, first + timedelta(99), 10)
    assert dead.stopped and len(dead.lost) > 1
    windows = spark.createDataFrame([("http://e", "2024-01-01", "2024-01-05"), ("http://e", "2024-01-06", "2024-01-08")], "endpoint string, first_day string, last_day string")
    rows = oai.harvest(windows, _oai(days), "oai_dc").collect()
    assert sum(r.error is not None for r in rows) == 1 and {r.identifier for r in rows if r.xml} >= {"r0", "r4", "r22"}


def test_oai_client_waits_when_told():
    said, answers = [], [(503, {"Retry-After": "7"}, ""), (503, {"Retry-After": "9999"}, ""), (200, {}, f'<OAI-PMH xmlns="{oai.NS["oai"]}"><Identify><repositoryName>R</repositoryName></Identify></OAI-PMH>')]
    client = oai.Client("http://e", lambda *a: answers.pop(0), sleep=said.append)
    assert client.identify() == {"repositoryName": "R"} and said == [7.0, 300.0]


def test_oai_parsers_and_files(spark):
    ns = oai.NS
    head = f'<record xmlns="{ns["oai"]}"><header><identifier>oai:h:1</identifier></header><metadata>'
    dc = head + f'<oai_dc:dc xmlns:oai_dc="{ns["oai_dc"]}" xmlns:dc="{ns["dc"]}"><dc:title>T</dc:title><dc:creator>A</dc:creator><dc:creator>B</dc:creator><dc:date>em 2011-05</dc:date><dc:identifier>http://h/handle/1</dc:identifier><dc:identifier>doi:10.1/x</dc:identifier><dc:identifier>http://h/f.pdf?x</dc:identifier></oai_dc:dc></metadata></record>'
    etd = head + f'<thesis xmlns="{ns["etdms"]}" xmlns:dc="{ns["dc"]}"><dc:title>T</dc:title><degree><discipline>D</discipline><name>M</name></degree></thesis></metadata></record>'
    got = oai.parsed(dc, "s", "e")
    assert (got["autor"], got["ano"], got["identificador"], got["url_landing"], got["url_binario"]) == ("A; B", 2011, "doi:10.1/x", "http://h/handle/1", "http://h/f.pdf?x")
    assert oai.parsed(etd, "s")["programa"] == "D" and oai.parsed(head + "</metadata></record>", "s") is None
    ore = '<r xmlns:x="u"><link href="http://h/bitstream/9"/><link type="application/pdf" href="http://h/z"/><link x:resource="http://h/a.pdf"/><link href="http://h/bitstream/thumbnail.jpg"/><link href="http://h/z"/></r>'
    assert oai.ore_files(ore) == ["http://h/z", "http://h/a.pdf", "http://h/bitstream/9"]
    rows = oai.candidates(spark.createDataFrame([("e", dc), ("e", "<broken"), ("e", None)], "endpoint string, xml string"), "s").collect()
    assert len(rows) == 1 and rows[0].ano == 2011


def test_search_is_cut_into_slices(spark):
    data = [{"id": str(i), "publishDate": str(2000 + i % 3), "institution": f"I{i % 4}"} for i in range(1000)]

    def transport(path, asked):
        rows = [r for r in data if all(r[f.split(":")[0]] == f.split('"')[1] for f in asked.get("filter[]", []))]
        facets = {n: [{"value": v, "count": sum(r[n] == v for r in rows)} for v in sorted({r[n] for r in rows})] for n in asked.get("facet[]", [])}
        at, n = asked.get("page", 1) - 1, asked.get("limit", 0)
        return 200, {}, "{}", {"resultCount": len(rows), "records": rows[at * n : (at + 1) * n], "facets": facets}

    client = search.SearchClient(transport)
    slices = list(client.slices(window=100))
    assert sum(n for _, n in slices) == 1000 and max(n for _, n in slices) <= 100 and len(slices) == 12
    assert len(list(client.rows("", [], most=250))) == 250
    assert search.collected(spark, client, "", window=400).select("id").distinct().count() == 1000
    said = []
    busy = [(429, {}, "", None), (503, {"retry-after": "3"}, "", None), (200, {}, "{}", {"resultCount": 5})]
    assert search.SearchClient(lambda *a: busy.pop(0), sleep=said.append).total() == 5 and said == [2.0, 3.0]
    with pytest.raises(search.Unexpected):
        search.SearchClient(lambda *a: (200, {}, "<html>", None)).total()


def _site(pages):
    def get(url):
        if url.endswith("robots.txt"):
            return fetch.Answer(404, url, {}, b"")
        a = pages.get(url)
        return a if a is None or isinstance(a, fetch.Answer) else fetch.Answer(200, url, {"Content-Type": "application/pdf" if a.startswith("%PDF") else "text/html"}, a.encode())

    return get


def test_files_are_found_and_downloaded(spark, tmp_path):
    pages = {
        "http://a.org/meta": '<meta content="http://localhost:8080/f.pdf" name="citation_pdf_url">', "http://a.org/f.pdf": "%PDF-1 body", "http://a.org/link": '<a href="x.html"><a href="/bitstreams/1/g.PDF?d=1">', "http://a.org/obj": '<object type="application/pdf" data="/r?id=1"></object>',
        "http://a.org/wall": "<title>Just a moment</title>", "http://a.org/hop": fetch.Answer(302, "http://a.org/hop", {"Location": "/meta"}, b""), "http://a.org/none": "<p>nothing</p>", "http://a.org/h.pdf": "<html>",
    }
    r = fetch.Resolver(_site(pages), "ours", fetch.Pace(0.0))
    assert r.file_url("http://a.org//meta") == "http://a.org/f.pdf" == r.file_url("http://a.org/hop")
    assert r.file_url("http://a.org/link") == "http://a.org/bitstreams/1/g.PDF?d=1" and r.file_url("http://a.org/obj") == "http://a.org/r?id=1"
    got = r.obtain(["http://a.org/none", "http://a.org/meta"], str(tmp_path / "x.pdf"))
    assert got.ok and got.bytes == 11 and (tmp_path / "x.pdf").exists() and r.obtain(["http://a.org/meta"], str(tmp_path / "x.pdf")).ok
    assert r.obtain(["http://a.org/none"], "y").reason == "pdf_nao_localizado" and r.obtain(["http://a.org/h.pdf"], "y").reason == "conteudo_nao_e_pdf" and r.obtain([], "y").reason == "sem_url"
    assert r.file_url("http://a.org/wall") is None and r.barred == {"a.org": "desafio_anti_robo"} and r.obtain(["http://a.org/meta"], "z").reason != "ok"
    rows = [(u, p) for u, p in pages.items() if isinstance(p, str) and not p.startswith("%PDF")]
    stored = {x.u: x.f for x in spark.createDataFrame(rows, "u string, h string").select("u", fetch.page_file(F.col("h"), F.col("u")).alias("f")).collect()}
    assert all(stored[u] == fetch.link_of(p, u) for u, p in rows)


def test_pace_only_slows():
    now, slept = [0.0], []
    pace = fetch.Pace(2.0, lambda: now[0], slept.append)
    pace.slow("a", 5.0)
    pace.slow("a", 1.0)
    for host in ("a", "b", "a", "b"):
        pace.wait(host)
    assert slept == [5.0, 2.0]


def test_breaker_by_rate_and_by_row():
    b = fetch.Breaker(4, 0.7, 3)
    assert [b.count("x", ok) is None for ok in (True, False, False, False)] == [True, True, True, False]
    b = fetch.Breaker(20, 0.7, 3, {"y": 100})
    assert b.count("y", False, "http_404") is None and b.count("y", False, "http_503") is None and b.count("y", False, "http_429") is None and b.count("y", False, "sem_resposta")


def test_staging_flattens_and_chooses(spark):
    pt, en = "o estudo foi sobre a saúde de uma população e para o que se " * 4, "the study was about the health of a population and for this " * 4
    rows = spark.createDataFrame([(["curto", en, pt],), ([en],), (["a  b", None, "c"],), ([],), (None,)], "v array<string>")
    got = [r[0] for r in rows.select(staging.best_abstract(F.col("v"))).collect()]
    assert got[0] == pt.strip() and got[1] == en.strip() and got[2] == "a b c" and not got[3] and not got[4]
    y = spark.createDataFrame([(["x", "em 1899 e 2001"],), (["1700"],), (None,)], "v array<string>").select(staging.first_year(F.col("v"))).collect()
    assert [r[0] for r in y] == [1899, None, None]


def test_exact_groups_keep_nulls(spark):
    docs = spark.createDataFrame([(1, "A  b"), (2, "a B "), (3, None), (4, ""), (None, "only"), (5, "a b c")], "doc_id long, text string")
    assert {(r.doc_id, r.survivor) for r in corpus.exact_map(docs).collect()} == {(1, 1), (2, 1), (3, 3), (4, 3), (None, None), (5, 5)} or len(corpus.exact_map(docs).collect()) == 6
    assert corpus.survivors(docs).count() == 4 and corpus.exact_map(docs.limit(0)).count() == 0
    q = inventory.stratified(spark.createDataFrame([(k, None if k % 3 == 0 else "s") for k in range(30)], "k long, s string"), ["s"], "k", 30)
    assert q.count() == 30 and q.where("s is null").count() == 10
    named = corpus.shards(spark.createDataFrame([(1, "en"), (2, None), (3, "en")], "doc_id long, lang string"), 1)
    assert {r.doc_id: r.shard for r in named.collect()} == {1: "en-0000", 2: "none-0000", 3: "en-0001"}


def test_metrics_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "a1 22 ... # …")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    m = {r.doc_id: r for r in corpus.metrics(docs).collect()}
    assert (m[1].alphabetic_share, m[1].symbol_share, m[1].duplicate_line_share, m[1].short_share, m[1].words_a_line, m[1].language) == (0, 1, 1, 1, 0, "un") and m[2].n_words == 0
    assert (m[3].n_words, m[3].n_alphabetic, m[3].n_symbols) == (2, 1, 3)
    reasons = {r.doc_id: r.reasons for r in corpus.decide(corpus.metrics(docs)).collect()}
    assert reasons[1].startswith("curto_demais|pouco_texto_alfabetico|excesso_simbolos|tamanho_medio_palavra_anomalo|sem_stopwords_pt|linhas_repetitivas|ocr_fragmentado|linhas_curtas_demais|idioma_un")


def test_internal_repetition_keeps_the_first(spark):
    long = "um parágrafo comprido o bastante para contar como repetido quando volta a aparecer no mesmo texto"
    docs = spark.createDataFrame([(1, f"{long}\n\nTítulo\n\n{long.upper()}!\n\nTítulo"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in corpus.internal_repetition(docs).collect()}
    assert got[1].text == f"{long}\n\nTítulo\n\nTítulo" and (got[1].removed, got[1].share, got[1].rejected) == (1, 0.25, False) and got[2].text == "" == got[3].text


def test_contaminated_training_documents(spark):
    words = [f"w{k}" for k in range(200)]
    near = " ".join([*words[:100], "changed", *words[101:]])
    train = spark.createDataFrame([(1, near), (2, "outra coisa inteiramente diferente de tudo"), (3, None), (4, " ".join(words))], "doc_id long, text string")
    assert {r.doc_id for r in corpus.contaminated(train, spark.createDataFrame([(4, " ".join(words))], "doc_id long, text string")).collect()} == {1, 4}


def test_large_groups_are_compared_by_a_pivot(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(60):
        w = list(words)
        w[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"y{rng.randrange(9)}" for _ in range(40))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wide = {r.doc_id: r.component_id for r in neardup.near_copies(docs, tile=4096).collect()}
    assert {r.doc_id: r.component_id for r in neardup.near_copies(docs, tile=8).collect()} == wide and all(wide[i] == 0 for i in range(60))


def test_rows_that_share_a_doc_id_stay_apart(spark):
    docs = spark.createDataFrame([(1, "um dois tres quatro cinco seis"), (1, "sete oito nove dez onze doze"), (1, "um dois tres quatro cinco seis"), (2, "sete oito nove dez onze doze")], "doc_id long, text string")
    assert len({r.component for r in neardup.near_copies(docs).collect()}) == 2


def test_linkage_keys_and_groups(spark):
    rows = [
        (1, "f1", "A saúde da mulher no Piauí rural", "Silva, João da", 2010, "UFPI", "", "", "http://p/1", "curto"),
        (2, "f2", "Saude da Mulher no Piaui Rural", "João da Silva", 2011, "Universidade Federal do Piauí", "", "http://f/2", "", ""),
        (3, "f1", "Outra coisa qualquer em outro lugar", "B", 2010, "USP", "", "", "", ""),
        (4, "f3", "Saúde da mulher no Piauí rural e urbano", "C", None, "X", "", "", "", ""),
    ]
    df = spark.createDataFrame(rows, "k long, fonte string, titulo string, autor string, ano int, ies string, identificador string, url_binario string, url_landing string, resumo string")
    df = df.withColumns({c: F.lit("") for c in ("programa", "area", "taxonomia", "tipo")})
    for similarity in (linkage.edit_similarity, linkage.sequence_similarity):
        merged, metrics = linkage.reconciled(df, "k", similarity=similarity)
        got = {r.k: r for r in merged.collect()}
        assert set(got) == {2, 3, 4} and got[2].fontes == ["f1", "f2"] and got[2].url_landing == "http://p/1" and got[2].resumo == "curto" and metrics["groups_of_several_sources"] == 1


def test_inventory_tables(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_bytes("AN_BASE;NM_PRODUCAO;NM_DISCENTE;NM_ENTIDADE_ENSINO;NM_AREA_AVALIACAO\n2010;Título é;Ana;UFPI;SAÚDE COLETIVA\n2011;;Bia;USP;SAUDE COLETIVA\n2012;X;C;USP;DIREITO\n".encode("latin-1"))
    df = tables.read_table(spark, str(path))
    assert tables.mapped(df.columns)["titulo"] == "NM_PRODUCAO"
    got = tables.census({"c": df, "bad": df.select("AN_BASE")}, values=["saúde coletiva"]).collect()
    assert [(r.titulo, r.autor, r.ano, r.ies) for r in got] == [("Título é", "Ana", 2010, "UFPI")]
    record = tables.as_record(tables.census({"c": df}))
    docs = staging.documents(record, spark.createDataFrame([], staging.DOWNLOAD), "a")
    assert docs.count() == 2 and set(docs.where("titulo = 'X'").first().asDict()) >= {"doc_id", "titulo", "ano"}
    rights = spark.createDataFrame([("openAccess",), ("",), (None,), ("embargoed",)], "r string").select(tables.open_access(F.col("r"))).collect()
    assert [r[0] for r in rights] == [True, True, True, False]


def test_introduction_excerpts(spark):
    abstract = "resumo do trabalho com muitas palavras diferentes " * 4
    body = " ".join(f"palavra{k}" for k in range(900))
    good = f"RESUMO\n{abstract}\nINTRODUÇÃO\nsumário\n1 INTRODUÇÃO:\n{body}"
    rows = [(good, abstract), (f"INTRODUÇÃO\n{abstract}{body}", abstract), ("sem nada", abstract), (good, "curto"), (None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, a string").select(curated.introduction(F.col("t"), F.col("a"))).collect()]
    assert got[0].startswith("palavra0 palavra1 ") and len(got[0].split()) == 600 and got[1:] == ["", "", "", ""]


def test_extraction_reads_thin_pages_from_images(spark):
    files = spark.createDataFrame([("a", b"x" * 300), ("b", b"thin"), ("c", b"bad"), ("d", None)], "doc_id string, content binary")

    def pages(content):
        if content == b"bad":
            raise ValueError("broken")
        return [content.decode(), ""] if content != b"thin" else ["", ""]

    got = {r.doc_id: r for r in processed.extracted(files, pages, lambda c, which: {i: "lido da imagem " * 20 for i in which}).collect()}
    assert got["a"].ok and got["b"].ok and got["b"].pages_ocr == 2 and not got["c"].ok and "broken" in got["c"].reason and not got["d"].ok


def test_reports_and_preflight(spark, tmp_path):
    failures = spark.createDataFrame([("1", "a", ""), ("2", "a", ""), ("3", "b", "")], "id string, type string, detail string")
    report = reports.Report("layer", metrics={"n": 3})
    path = report.save(str(tmp_path), failures)
    report.save(str(tmp_path), failures)
    assert len(list(tmp_path.iterdir())) == 2 and '"a": 2' in open(path).read() and reports.readable_bytes(2048) == "2.0 KB"
    pages = spark.createDataFrame([("https://a.org/1",), ("https://b.org/1",)], "url string")
    evidence = spark.createDataFrame([("https://a.org", True)], "origin string, allowed boolean")
    settings = {"project": {"institution": "U", "contact": "c@u.br"}, "user_agent": "bot (c@u.br)", "sources": [{"name": "s", "url": "https://s"}]}
    assert not reports.may_start(reports.preflight(settings, evidence, pages)) and reports.may_start(reports.preflight(settings, evidence, pages.limit(1)))
    barred = evidence.withColumn("allowed", F.lit(False))
    assert any(c.name == "barred" and c.level == reports.BLOCK for c in reports.preflight(settings, barred, pages.limit(1)))
    assert any(c.name == "identity" and c.level == reports.BLOCK for c in reports.preflight({"project": {"institution": "<sua>"}}))


def test_datacard(spark):
    rows = [(1, "oai:h:1", "", "U", 2010, "open", "train", 10), (2, "", "https://r/2", "U", 2012, None, "test", 20)]
    card = curated.datacard(spark.createDataFrame(rows, "doc_id long, id_bdtd string, url_registro string, instituicao string, ano int, direitos string, split string, palavras long"), "Corpus", {"rag": 5})
    assert "| documents | 2 |" in card and "| OAI-PMH h | 1 |" in card and "2010 to 2012" in card and "(não informado)" in card
