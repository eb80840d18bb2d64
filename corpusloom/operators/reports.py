"""Reports of a layer, failures by type, versions of what is overwritten, and checks before a run."""

from __future__ import annotations

import json
import os
import re
import shutil
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, WARN, OK = "block", "warn", "ok"
#: What an unfinished configuration holds in place of a value.
PLACEHOLDER = re.compile(r"^\s*$|<[^>]*>|TODO|CHANGE_?ME|PREENCH|SEU_|SUA_|exemplo\.|example\.(?:com|org)|xxx", re.I)


def now() -> str:
    """UTC time as ISO text."""
    return datetime.now(UTC).isoformat()


def readable_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{n:.1f} {unit}"
        n /= 1024
    raise AssertionError


def failures_by_type(failures: DataFrame) -> DataFrame:
    """(type, n), most first."""
    return failures.groupBy("type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "type")


@dataclass
class Report:
    """What a layer read, wrote and measured; failures stay a table, and the report holds their counts and some examples."""

    layer: str
    inputs: dict = field(default_factory=dict)
    outputs: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    parameters: dict = field(default_factory=dict)
    started: str = field(default_factory=now)

    def save(self, folder: str, failures: DataFrame | None = None, examples: int = 200) -> str:
        """Writes <layer>.json (a former one is kept beside it) and gives its path."""
        body = asdict(self) | {"finished": now()}
        if failures is not None:
            body["failures_by_type"] = {r.type: r.n for r in failures_by_type(failures).collect()}
            body["failures"] = [r.asDict() for r in failures.orderBy("type", "id").limit(examples).collect()]
        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, f"{self.layer}.json")
        keep_former(path)
        with open(path, "w", encoding="utf-8") as f:
            json.dump(body, f, ensure_ascii=False, indent=1, default=str)
        return path


def keep_former(path: str) -> str | None:
    """Moves what stands at a path beside it, under its time; gives the new place."""
    if not os.path.exists(path):
        return None
    kept = f"{path}.{datetime.now(UTC):%Y%m%dT%H%M%S%f}.bak"
    shutil.move(path, kept)
    return kept


@dataclass(frozen=True)
class Check:
    level: str
    name: str
    message: str


def placeholder(value) -> bool:
    return value is None or (isinstance(value, str) and PLACEHOLDER.search(value) is not None)


def preflight(settings: dict, evidence: DataFrame | None = None, candidates: DataFrame | None = None, free_bytes: int | None = None) -> list[Check]:
    """Checks before a harvest: identity, sources, evidence for each host, barred hosts among candidates, protocol, conduct, room, environment.

    ``settings``: project (institution, contact), user_agent, sources (list of dicts with name, url, enabled), protocol (path),
    rate (requests a second), goal_bytes. ``evidence`` has (origin, allowed); ``candidates`` has url. A run may start if no
    check blocks.
    """
    out = []
    project = settings.get("project") or {}
    bad = [k for k in ("institution", "contact") if placeholder(project.get(k))]
    out.append(Check(BLOCK, "identity", f"not filled in: {', '.join(bad)}") if bad else Check(OK, "identity", project["contact"]))
    agent = settings.get("user_agent", "")
    out.append(Check(BLOCK, "agent", "the user agent names no contact") if placeholder(agent) or not re.search(r"@|https?://", agent) else Check(OK, "agent", agent))
    sources = [s for s in settings.get("sources") or [] if s.get("enabled", True)]
    unset = [s.get("name", "?") for s in sources if placeholder(s.get("url"))]
    out.append(Check(BLOCK, "sources", "no source is enabled" if not sources else f"without address: {', '.join(unset)}") if not sources or unset else Check(OK, "sources", f"{len(sources)} enabled"))
    if candidates is not None:
        from corpusloom.functions.robots import origin

        hosts = candidates.select(origin(F.col("url")).alias("origin")).where("origin is not null").distinct()
        if evidence is None:
            out.append(Check(BLOCK, "evidence", "no robots evidence"))
        else:
            missing = [r.origin for r in hosts.join(evidence.select("origin"), "origin", "left_anti").orderBy("origin").limit(5).collect()]
            out.append(Check(BLOCK, "evidence", f"hosts without evidence: {', '.join(missing)}") if missing else Check(OK, "evidence", "every host has evidence"))
            barred = [r.origin for r in hosts.join(evidence.where("not allowed").select("origin"), "origin", "left_semi").orderBy("origin").limit(5).collect()]
            out.append(Check(BLOCK, "barred", f"barred hosts in the inventory: {', '.join(barred)}") if barred else Check(OK, "barred", "no barred host"))
    protocol = settings.get("protocol")
    out.append(Check(OK, "protocol", protocol) if protocol and os.path.exists(protocol) else Check(WARN, "protocol", "no protocol document"))
    rate = settings.get("rate", 0.5)
    out.append(Check(BLOCK, "conduct", f"{rate} requests a second are too many") if rate > 2 else Check(WARN, "conduct", f"{rate} requests a second") if rate > 1 else Check(OK, "conduct", f"{rate} requests a second"))
    goal = settings.get("goal_bytes", 0)
    if free_bytes is not None and goal:
        out.append(Check(BLOCK, "room", f"{readable_bytes(free_bytes)} free, {readable_bytes(goal)} needed") if free_bytes < goal else Check(OK, "room", readable_bytes(free_bytes)))
    return out


def may_start(checks: list[Check]) -> bool:
    return all(c.level != BLOCK for c in checks)
