"""All knobs in one frozen record.  `now` is always given, never read from the clock inside an operator."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    now: float = 0.0
    ttl_ok_s: float = 3 * 86400.0
    ttl_dead_s: float = 7 * 86400.0
    ttl_blocked_s: float = 1 * 86400.0
    ttl_vod_s: float = 30 * 86400.0
    strike_gap_s: float = 4 * 3600.0
    recent_dead_s: float = 24 * 3600.0
    list_ttl_s: float = 24 * 3600.0
    breaker_misses: int = 3
    breaker_cooldown_s: float = 300.0
    host_interval_s: float = 0.25
    name_url_cap: int = 5
    harvest_per_page: int = 40
    harvest_cap: int = 3000
    backlog_cap: int = 20000
    site_cap: int = 300
    max_sites: int = 40
    rescore_cap: int = 400
    iframe_cap: int = 120
    solver_cap: int = 60
    segments_cap: int = 4
    sample_cap: int = 3
    files_per_repo: int = 6
    max_repos: int = 14
    max_files: int = 40
    max_pages: int = 30
    max_hops: int = 8
    bundle_cap: int = 5
    endpoint_cap: int = 8
    query_window: int = 900
    coverage_min: float = 50.0
    honour_gone_status: bool = True
    safe_attributes: bool = False
    language: str = "All"

    @classmethod
    def from_env(cls, prefix: str = "LINKLOOM_", **given) -> Config:
        """Each field may be set by an environment variable of its upper-case name after the prefix; arguments win."""
        out = {}
        for f in fields(cls):
            raw = os.environ.get(prefix + f.name.upper())
            if raw is not None:
                out[f.name] = raw.lower() in ("1", "true", "yes") if isinstance(f.default, bool) else type(f.default)(raw)
        return cls(**(out | given))
