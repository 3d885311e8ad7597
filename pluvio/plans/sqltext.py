"""Small builders for the DuckDB oracle text (kept next to the catalog)."""

from __future__ import annotations

from typing import Iterable, Sequence

from ..config import AUDIT_TOKENS
from ..sources.obs import obs_sql


def q(name: str) -> str:
    return '"' + name + '"'


def lit_list(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def missing(c: str, tokens: Sequence[str] = AUDIT_TOKENS) -> str:
    return f"({q(c)} IS NULL OR lower(trim(CAST({q(c)} AS VARCHAR))) IN ({lit_list(t.lower() for t in tokens)}))"


def token(c: str, tokens: Sequence[str]) -> str:
    return f"(lower(trim(CAST({q(c)} AS VARCHAR))) IN ({lit_list(t.lower() for t in tokens)}))"


def pct(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) * 100.0 / NULLIF({den}, 0), 6)"


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def with_obs(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH obs AS ({obs_sql()}){extra}\n{body}"


def union_all(parts: Iterable[str]) -> str:
    return "\nUNION ALL\n".join(parts)
