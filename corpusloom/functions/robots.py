"""Verdicts on robots.txt answers, and pages that ask for a proof of humanity."""

from __future__ import annotations

import urllib.robotparser
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Agents of AI crawlers, marks of a challenge in robots.txt and in pages, and paths of items and files.
AI_AGENTS = frozenset(
    """gptbot chatgpt-user oai-searchbot claudebot claude-web anthropic-ai ccbot google-extended amazonbot applebot-extended bytespider
    meta-externalagent perplexitybot cohere-ai diffbot omgilibot""".split()
)
CHALLENGE_MARKS = ("cf-chl", "challenge-platform", "turnstile", "just a moment", "checking your browser", "captcha", "attention required", "ddos-guard")
PAGE_MARKS = (
    "cf-chl", "/cdn-cgi/challenge-platform", "<title>just a moment", "checking your browser", "attention required! | cloudflare", "ddos-guard",
    "não é um bot", "nao e um bot", "you are not a robot", "are you a robot", "estamos validando sua requisição", "estamos validando sua requisicao",
)
ITEM_PATHS = ("/handle/1/1", "/bitstream/1/1/tese.pdf", "/jspui/handle/1/1", "/items/1", "/tde_busca/arquivo.php")
VERDICT = "allowed boolean, reason string, crawl_delay double"


def challenge_page(html: Column, first: int = 20_000) -> Column:
    """Whether a page's first characters hold a mark of a challenge; false for null."""
    head = F.lower(F.left(F.coalesce(html, F.lit("")), F.lit(first)))
    return F.exists(F.array(*map(F.lit, PAGE_MARKS)), lambda m: F.contains(head, m))


def groups(text: str) -> Iterator[tuple[set[str], list[tuple[str, str]]]]:
    """Agents and (field, value) rules of each group; consecutive agent lines share the rules that follow."""
    agents, rules = set(), []
    for raw in text.splitlines():
        name, colon, value = raw.partition("#")[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if not colon:
            continue
        if name == "user-agent":
            if rules:
                yield agents, rules
                agents, rules = set(), []
            agents.add(value.lower().partition("/")[0])
        elif name in ("allow", "disallow"):
            rules.append((name, value))
    if agents:
        yield agents, rules


def bars_ai(text: str) -> bool:
    return any(agents & AI_AGENTS and any(n == "disallow" and v for n, v in rules) for agents, rules in groups(text))


def verdict(status: int | None, body: str | None, agent: str) -> tuple[bool, str, float | None]:
    """allowed, reason, crawl delay; the first of the cases that applies, in this order."""
    body = body or ""
    head = body[:5000].lower()
    if status is None:
        return False, "inacessivel", None
    if any(m in head for m in CHALLENGE_MARKS):
        return False, "desafio_anti_robo", None
    if status in (404, 410):
        return True, "sem_robots", None
    if status != 200:
        return False, f"http_{status}", None
    if head.lstrip().startswith("<") or "<html" in head[:500]:
        return True, "robots_html_sem_regras", None
    if bars_ai(body):
        return False, "veto_robos_ia", None
    rules = urllib.robotparser.RobotFileParser()
    rules.parse(body.splitlines())
    if not any(rules.can_fetch(agent, path) for path in ITEM_PATHS):
        return False, "bloqueia_nosso_agente", None
    delay = rules.crawl_delay(agent) or rules.crawl_delay("*")
    return True, "ok", float(delay) if delay else None


def verdicts(status: Column, body: Column, agent: str) -> Column:
    """Struct of the verdict on each answer."""

    @F.pandas_udf(VERDICT)
    def run(s: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([verdict(None if pd.isna(x) else int(x), y, agent) for x, y in zip(s, b, strict=True)], columns=["allowed", "reason", "crawl_delay"])

    return run(status, body)


def origin(url: Column) -> Column:
    """Scheme and authority, in lower case; null if there are none."""
    found = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1))
    return F.when(found != "", found)


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """(origin, allowed, reason, crawl_delay) from stored evidence, one JSON object a file; of several for an origin the latest."""
    schema = "origin string, robots_txt string, status int, body string, checked_at timestamp, verdict struct<allowed:boolean,reason:string,crawl_delay:double>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.where("origin is not null").groupBy("origin").agg(F.max_by("verdict", F.struct("checked_at", "robots_txt")).alias("v")).select("origin", "v.*")


def permitted(candidates: DataFrame, url: str, evidence: DataFrame) -> DataFrame:
    """Candidates whose origin no verdict bars; origins without evidence stay."""
    barred = evidence.where("not allowed").select("origin")
    return candidates.withColumn("_origin", origin(F.col(url))).join(barred.withColumnRenamed("origin", "_origin"), "_origin", "left_anti").drop("_origin")


def capture(candidates: DataFrame, url: str, fetch: Callable[[str], tuple[int | None, str | None]], agent: str, most_chars: int = 200_000) -> DataFrame:
    """Evidence by one request for each distinct origin, with its verdict and the first characters of the body.

    ``fetch`` gives status and body. Write the result before it is used: a task that runs again asks again.
    """
    distinct = candidates.select(origin(F.col(url)).alias("origin")).where("origin is not null").distinct()

    def run(batches):
        for batch in batches:
            rows = []
            for o in batch["origin"]:
                status, body = fetch(f"{o}/robots.txt")
                rows.append((o, f"{o}/robots.txt", status, (body or "")[:most_chars], *verdict(status, body, agent)))
            yield pd.DataFrame(rows, columns=["origin", "robots_txt", "status", "body", "allowed", "reason", "crawl_delay"]).astype({"status": "Int32"})

    found = distinct.repartition("origin").mapInPandas(run, f"origin string, robots_txt string, status int, body string, {VERDICT}")
    return found.withColumn("checked_at", F.current_timestamp())
