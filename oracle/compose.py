from __future__ import annotations

import re

from oracle import raw, staging

_NAMES = re.compile(r"\b[a-z][a-z0-9_]*\b")


def _all_fragments() -> dict[str, str]:
    from oracle import marts, quality, reports, star

    return {**raw.FRAGMENTS, **staging.FRAGMENTS, **star.FRAGMENTS, **marts.FRAGMENTS, **reports.FRAGMENTS,
            **quality.FRAGMENTS}


def compose(body: str) -> str:
    """``body`` with every fragment it refers to, directly or not, as a CTE before it."""
    fragments = _all_fragments()
    ordered: list[str] = []

    def need(sql: str, inside: str | None = None) -> None:
        for name in _NAMES.findall(sql):
            if name in fragments and name != inside and name not in ordered:
                need(fragments[name], name)
                if name not in ordered:
                    ordered.append(name)

    need(body)
    if not ordered:
        return body
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({fragments[name]})" for name in ordered)
    return f"WITH {ctes}\n{body}"
