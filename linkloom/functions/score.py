"""Scores, qualities, categories and verdict rules as plain expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as K
from linkloom.functions.text import text


def lookup(values: dict, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key), default)


def steps(value: Column, rules: tuple, last: object) -> Column:
    """The first (bound, result) whose bound the value reaches."""
    out = F.when(F.lit(False), F.lit(last))
    for bound, result in rules:
        out = out.when(value >= bound, result)
    return out.otherwise(last)


def quality_rank(q: Column | str, empty: int = 0) -> Column:
    """2 for an unknown quality, `empty` for none."""
    return lookup(K.QUALITY_RANK, F.lower(text(q)), F.when(text(q) != "", 2).otherwise(empty))


def quality_tier(q: Column | str) -> Column:
    n = F.regexp_extract(text(q), r"(\d{3,4})", 1).try_cast("int")
    return F.when(n.isNull(), "unknown").otherwise(steps(n, ((1080, "fhd"), (720, "hd"), (480, "sd")), "low"))


def quality_from_resolution(resolution: Column, bandwidth: Column) -> Column:
    """The height if it is 200 or more, else a step of the bandwidth."""
    h = F.regexp_extract(F.lower(text(resolution)), r"x\s*([+-]?\d+)\s*$", 1).try_cast("int")
    by_rate = steps(bandwidth, K.BANDWIDTH_QUALITY, "")
    return F.when(h >= 200, F.concat(h.cast("string"), F.lit("p"))).otherwise(by_rate)


def score_parts(*, parsed: Column, segments_ok: Column, quality: Column, bandwidth: Column, latency_ms: Column, verified: Column, needs_ua: Column, entries: Column) -> Column:
    """0..100 from what a probe has found."""
    yes = lambda c, a, b=0: F.when(c, a).otherwise(b)
    rate = F.when(bandwidth > 0, steps(bandwidth, ((4_000_000, 15), (2_000_000, 11), (1_000_000, 7)), 4)).otherwise(yes(parsed, 8))
    wait = F.when(latency_ms > 0, F.when(latency_ms < 300, 10).when(latency_ms < 800, 7).when(latency_ms < 2000, 4).otherwise(1)).otherwise(yes(parsed, 6))
    rows = F.when(entries > 0, F.least(F.lit(30), F.lit(5) + F.floor(entries / 5).cast("int") * 5)).otherwise(0)
    points = lookup(K.QUALITY_POINTS, F.lower(text(quality)), yes(parsed, 8))
    total = F.lit(20) + yes(parsed, 20) + steps(segments_ok, ((2, 15), (1, 8)), 0) + points + rate + wait + rows + yes(verified, 10) - yes(needs_ua, 10)
    return F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("int")


def category_of(blob: Column, given: Column | None = None, rules: tuple = K.CATEGORY_RULES, default: str = "Other") -> Column:
    """The category with most matching patterns, the first of equals; what is given stays."""
    low = F.lower(text(blob))
    counts = [sum((low.rlike(p).cast("int") for p in patterns), F.lit(0)) for _, patterns in rules]
    top = F.greatest(*counts)
    out = F.when(top == 0, default)
    for (name, _), n in zip(rules, counts, strict=True):
        out = out.when(n == top, name)
    return out if given is None else F.when(text(given) != "", given).otherwise(out)


def vod_stats(manifest: Column) -> tuple[Column, Column]:
    """Number of segments and their seconds near the start of a manifest."""
    head = F.substring(text(manifest), 1, 8000)
    secs = F.transform(F.regexp_extract_all(head, F.lit(r"#EXTINF:([\d.]+)"), F.lit(1)), lambda x: F.coalesce(x.try_cast("double"), F.lit(0.0)))
    return F.regexp_count(head, F.lit("#EXTINF:")), F.aggregate(secs, F.lit(0.0), lambda s, x: s + x)


def looks_like_vod(manifest: Column | str) -> Column:
    """A finite clip by its tags, or by a short list that starts at sequence 0."""
    head = F.substring(text(manifest), 1, 8000)
    n, secs = vod_stats(text(manifest))
    seq = F.regexp_extract(head, r"#EXT-X-MEDIA-SEQUENCE:(\d+)", 1)
    short = (n > 0) & (n <= 8) & (secs > 0) & (secs <= 400)
    return F.when(head.contains("#EXT-X-PLAYLIST-TYPE:EVENT"), False).when(vod_is_told(manifest), True).when(~seq.rlike("^0+$"), False).otherwise(short)


def vod_is_told(manifest: Column | str) -> Column:
    """The playlist's own tags say that it is finite."""
    head = F.substring(text(manifest), 1, 8000)
    return head.contains("#EXT-X-PLAYLIST-TYPE:VOD") | head.contains("#EXT-X-ENDLIST")


def is_definitively_dead(vod: Column, vod_inferred: Column, blocked: Column, note: Column, honour_gone: bool = True) -> Column:
    """The probe proves that the URL is gone or no channel.  honour_gone: 404 and 410 count."""
    notes = K.GONE_NOTES if honour_gone else tuple(n for n in K.GONE_NOTES if not n.startswith("http"))
    return F.when(vod, ~vod_inferred).when(blocked, False).otherwise(text(note).isin(*notes))


def magic(body: Column) -> Column:
    return F.hex(F.substring(body, 1, 192))


def looks_media(body: Column) -> Column:
    """Magic bytes of a media container or transport."""
    h, n = magic(body), F.octet_length(body)
    box = lambda a, b: F.substring(h, 2 * a + 1, 2 * (b - a))
    known = (
        (box(4, 8) == "66747970")
        | (box(0, 4) == "1A45DFA3")
        | ((box(0, 4) == "52494646") & box(8, 12).isin("57415645", "41564920"))
        | box(0, 4).isin("4F676753", "664C6143")
        | (box(0, 3) == "494433")
        | h.rlike("^FF[EF]")
        | ((box(0, 1) == "47") & (n >= 189) & (box(188, 189) == "47"))
    )
    return (n >= 64) & known


def is_finished_file(body: Column) -> Column:
    """A static container, never a live feed; raw transport streams are not."""
    h, n = magic(body), F.octet_length(body)
    raw_ts = (F.substring(h, 1, 2) == "47") & (n >= 189) & (F.substring(h, 377, 2) == "47")
    return (n >= 32) & ~raw_ts & looks_media(body)
