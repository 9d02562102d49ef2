"""Name normalisation and token functions: Column -> Column, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom import constants as K


def let(value: Column, f) -> Column:
    """f(value), where value is worked out once; inside a lambda an outer expression would be worked out for every element."""
    return F.get(F.transform(F.array(value), f), 0)


def text(c: Column | str) -> Column:
    """Missing text is empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fallback(*cols: Column) -> Column:
    """The first that is neither null nor empty; else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def squeeze(c: Column) -> Column:
    """Unicode white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def norm_name(c: Column | str) -> Column:
    """Lower case without bracketed parts, quality marks and separators."""
    n = F.lower(text(c))
    for rx in (r"\([^)]*\)", r"\[[^\]]*\]", r"(?U)\b\d{3,4}[pi]\b", r"[|_/\\-]+"):
        n = F.regexp_replace(n, rx, " ")
    return squeeze(n)


def words(c: Column) -> Column:
    """The words of a squeezed text; none for an empty one."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def tokens(c: Column | str) -> Column:
    return words(norm_name(c))


def without(ts: Column, drop: tuple[str, ...]) -> Column:
    return F.filter(ts, lambda t: ~t.isin(*drop))


def coverage_key(c: Column | str) -> Column:
    """The normalised name without quality tokens."""
    return F.array_join(without(tokens(c), K.QUALITY_TOKENS), " ")


def token_set_key(ts: Column) -> Column:
    """A set of tokens in canonical form, for equi-joins."""
    return F.array_join(F.array_sort(F.array_distinct(ts)), " ")


def core_key(ts: Column) -> Column:
    """The token set less the extras that variants of one name may add."""
    return token_set_key(without(ts, K.SAFE_EXTRAS))


def compact(ts: Column, drop: tuple[str, ...] = ()) -> Column:
    """Tokens joined in order; empty under four characters."""
    j = F.array_join(without(ts, drop) if drop else ts, "")
    return F.when(F.length(j) >= 4, j).otherwise("")


def norm_strict(c: Column | str) -> Column:
    """As norm_name, but a bracketed part goes only if it is all quality; extras and quality tokens go anywhere."""
    n = F.lower(text(c))
    # bracketed parts one after another: "(a b)" -> a and b kept unless every word is a quality word
    quality = "(?:" + "|".join(K.STRICT_QUALITY) + r"|\d{3,4}[pi])"
    n = F.regexp_replace(n, rf"(?U)\(\s*{quality}(?:\s+{quality})*\s*\)", " ")
    n = F.regexp_replace(n, r"(?U)\(\s*([^()]*?)\s*\)", " $1 ")
    for rx in (r"\[[^\]]*\]", r"(?U)\b\d{3,4}[pi]\b", r"[|_/\\-]+"):
        n = F.regexp_replace(n, rx, " ")
    return F.array_join(without(words(squeeze(n)), tuple(dict.fromkeys(K.SAFE_EXTRAS + K.QUALITY_TOKENS))), " ")


def quality_of_name(c: Column | str) -> Column:
    """'1080p' from a name that says so; else empty."""
    n = F.regexp_extract(text(c), r"(?i)\b(\d{3,4})\s*[pi]\b", 1)
    return F.when(n != "", F.concat(n, F.lit("p"))).otherwise("")


def to_int(c: Column) -> Column:
    """An integer, or 0 where there is none."""
    return F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")).try_cast("int"), F.lit(0))


def file_name(c: Column | str) -> Column:
    return F.replace(F.lower(text(c)), F.lit(" "), F.lit("_"))


def clean_name(c: Column | str) -> Column:
    """A usable list name, or null: white space collapsed, two characters or more, not only digits."""
    n = squeeze(text(c))
    return F.when((F.length(n) >= 2) & ~n.rlike(r"^\d+$"), n)


def list_category(c: Column | str) -> Column:
    """Categories of a list's category cell."""
    key = F.lower(F.trim(text(c)))
    known = F.element_at(F.create_map(*[F.lit(x) for kv in K.LIST_CATEGORIES.items() for x in kv]), key)
    return F.when(known.isNotNull(), F.array(known)).when(key.contains("news") & ~key.startswith("non"), F.array(F.lit("News"))).otherwise(F.array().cast("array<string>"))


def list_languages(c: Column | str) -> Column:
    """Explicit languages of a comma list, spelling variants mapped, in order and once each."""
    parts = F.transform(F.split(text(c), ","), lambda t: F.trim(t))
    alias = F.create_map(*[F.lit(x) for kv in K.LANGUAGE_ALIASES.items() for x in kv])

    def one(t: Column) -> Column:
        low = F.lower(t)
        named = t.isin(*K.SCHEDULED_LANGUAGES, "English")
        skip = low.isin(*K.NO_LANGUAGE) | low.contains("all indian scheduled")
        return F.when(skip, F.lit(None)).otherwise(F.coalesce(F.try_element_at(alias, low), F.when(named, t)))

    return F.array_distinct(F.filter(F.transform(parts, one), lambda t: t.isNotNull()))


def language_of_code(c: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in K.ISO_LANGUAGE.items() for x in kv]), c)


def primary_language(codes: Column | str) -> Column:
    """Of a ';' list of codes: the first listed language other than English, else English if it is there, else null."""
    named = F.filter(F.transform(F.split(text(codes), ";"), lambda t: language_of_code(F.trim(t))), lambda t: t.isin(*K.LIST_LANGUAGES))
    return F.coalesce(F.get(F.filter(named, lambda t: t != "English"), 0), F.when(F.array_contains(named, "English"), F.lit("English")))


def first_category(c: Column | str) -> Column:
    """The first of a ';' list, in title case."""
    return F.initcap(F.trim(F.get(F.split(text(c), ";"), 0)))


def iso_age_s(stamp: Column, now: Column) -> Column:
    """Seconds from an ISO time to now."""
    return now - F.unix_micros(F.try_to_timestamp(stamp)) / F.lit(1e6)
