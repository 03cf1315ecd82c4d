"""Settings of a run from the environment, with defaults; a value that can't be read gives the default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    sources: tuple[str, ...] = ()
    limit: int = 0
    page_delay_ms: int = 500
    dry_run: bool = False
    force_refresh: bool = False
    states_path: str = ""
    codes_path: str = ""


def _read(kind: str, text: str):
    if kind == "bool":
        low = text.strip().lower()
        if low in ("1", "true", "yes", "on"):
            return True
        if low in ("0", "false", "no", "off"):
            return False
        raise ValueError(text)
    if kind == "int":
        return int(text.strip())
    return tuple(x.strip() for x in text.split(",") if x.strip()) if kind.startswith("tuple") else text


def load(env: Mapping[str, str] | None = None, prefix: str = "WATTLAKE_") -> Settings:
    env = os.environ if env is None else env
    found = {}
    for f in fields(Settings):
        text = env.get(prefix + f.name.upper(), "")
        if text:
            try:
                found[f.name] = _read(str(f.type), text)
            except ValueError:
                continue
    return Settings(**found)


def plain_dsn(dsn: str, drop: tuple[str, ...] = ("schema",)) -> str:
    """A database address without the query parameters that only other clients know; what isn't a postgres address stays."""
    from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

    u = urlsplit(dsn)
    if u.scheme not in ("postgres", "postgresql"):
        return dsn
    kept = [(k, v) for k, v in parse_qsl(u.query, keep_blank_values=True) if k not in drop]
    return urlunsplit(u._replace(query=urlencode(kept)))
