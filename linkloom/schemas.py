"""Schemas of the records."""

from __future__ import annotations

CHANNEL = "url string, name string, language string, category string, source string, logo string, extinf string, tvg_id string, tvg_name string, group_title string, score int, quality string"
CANDIDATE = "url string, name string, referer string, user_agent string, quality string, source string, extinf string, logo string, language string"
RESPONSE = "url string, final_url string, status int, headers map<string,string>, body binary, latency_ms double, captured_at timestamp"
VERDICT = "url string, status string, kind string, score int, detail string, checked_at double"
STATE_LINE = "t string, lang string, updated_at double, " + VERDICT + ", " + ", ".join(c for c in CHANNEL.split(", ") if c.split()[0] not in ("url", "score"))
RUN = "lang string, queries_sent int, urls_found int, urls_valid int, errors array<string>, incomplete boolean"
RESUME = "lang string, kind string, item string"
TARGETS = "timestamp string, language string, total bigint, channels array<struct<name: string, languages: array<string>, categories: array<string>>>"
PLATFORMS = "source string, title string, total bigint, platforms array<struct<s_no: bigint, name: string, entity: string>>, fetched_at string"
STREAM_ROWS = "channel string, title string, url string, quality string, referrer string, user_agent string"
CSV = {
    "channels": "id string, name string, alt_names string, network string, owners string, country string, categories string, is_nsfw string, launched string, closed string, website string",
    "feeds": "channel string, id string, name string, is_main string, broadcast_area string, timezones string, languages string, format string",
    "logos": "channel string, url string, width string, height string, format string, in_use string",
    "blocklist": "channel string, reason string",
    "languages": "code string, name string",
    "categories": "id string, name string, description string",
    "countries": "name string, code string, languages string, flag string",
}
