"""DuckDB oracle SQL per registered query (tables are pre-registered views)."""

from __future__ import annotations

from snapfold.plans.oracle_fixtures import with_fixtures

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    if name in ORACLE:
        raise KeyError(f"duplicate oracle {name}")
    ORACLE[name] = with_fixtures(sql)


def load_all() -> dict[str, str]:
    from snapfold.plans import registry
    registry.load_all()
    return dict(ORACLE)


# Referrer classification as SQL, first match wins.
REFERRER_CASE_SQL = """CASE
    WHEN referrer LIKE '%shop.example%' THEN 'On-site'
    WHEN referrer LIKE '%t.co%' THEN 'Twitter'
    WHEN referrer LIKE '%linkedin%' THEN 'Linkedin'
    WHEN referrer LIKE '%reddit%' THEN 'Reddit'
    WHEN referrer IS NULL THEN 'Direct'
    ELSE 'Other' END"""


def render_list_sql(expr: str, fmt: str | None = None) -> str:
    """DuckDB twin of ``pgcompat.render_list``."""
    if fmt:
        return f"array_to_string(list_transform({expr}, lambda x: strftime(x, '{fmt}')), ',')"
    return f"array_to_string(list_transform({expr}, lambda x: CAST(x AS VARCHAR)), ',')"
