"""Secret scans: base patterns, and dictionary-primed zstandard novelty for what they miss.

Base kinds are assign, access and hex (the patterns below).  Besides, each candidate - a token of 16 or more characters of
letters, digits and +/_=-. with at least two character classes, after a word of sensitive context on the same line or on the
line before - is measured: its marginal compressed bytes are those of (surrounding text + candidate) less those of the
surrounding text alone, both under a zstandard dictionary of code and of the words that `LEARN_DOCS` or more documents of
the corpus have near sensitive words.  Text that is like its surroundings, like code or like the corpus's identifiers
costs few bytes; a candidate that costs 0.65 bytes a character, or from 40 characters on `novelty` of what random ones of its
classes would, is reported as kind novel, unless a base span overlaps it.  A candidate of over 512 characters is measured in pieces and reported whole if one of them is novel.  A line
with a secret is itself context of the next line, so that a key of many lines is found to its last one of 16 characters or more.

Defined results: null is empty text, with no spans.  Positions are code points, ends exclusive.  Spans are ordered by start,
then kind in the order assign, access, hex, novel.  Other columns are ignored; repeated rows all appear; empty tables work.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import common as C

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
SENSITIVE = re.compile(r"(?ai:pass(?:word|wd|phrase)?|secret|token|api[_-]?key|credential|bearer|auth(?:orization)?|private[_ -]?key|access[_-]?key|signature|client[_-]?id)")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
PIECE, CODED = 512, 40
#: Parts of identifiers; those near sensitive words in LEARN_DOCS documents or more prime the compressor, the LEARN_WORDS most common at most.
PART = re.compile(r"[A-Z]?[a-z]{3,23}|[A-Z]{4,24}")
LEARN_DOCS, LEARN_WORDS = 10, 4000
_WORDS = (b"password", b"passwd", b"secret", b"token", b"api", b"pass", b"credential", b"bearer", b"auth", b"private", b"access", b"signature", b"client")
_HEX = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_RUN = b"\x01" * 16
#: What code and settings around a secret look like; it primes the compressor.
DICTIONARY = " ".join(
    """def class return import from self None True False const let var function async await public private protected static final
    void string int boolean export default require module package struct interface implements extends override config settings
    environment os.environ getenv process.env localhost database username password passwd secret token api_key apikey access_key
    client_id client_secret authorization bearer credential connection_string endpoint http https www example.com github.com
    application/json content-type user-agent accept-language charset utf-8 request response headers session cookie
    aws_access_key_id aws_secret_access_key private_key public_key certificate signature version 1.0.0 timestamp created_at
    updated_at user_id account_id customer_id get_user set_value load_config read_file write_file parse_json to_string
    YOUR_API_KEY_HERE your-token-here changeme placeholder xxxxxxxxxxxxxxxx 0000000000000000 1234567890 abcdefghijklmnopqrstuvwxyz
    ABCDEFGHIJKLMNOPQRSTUVWXYZ authentication authenticate validator validation failure failed success exception handler manager
    service provider security controller repository factory builder client server component module application document report
    default minutes seconds interval timeout expire expires rotation refresh length number index count total value values source
    target main java python script resources static assets images storage upload download account profile preferences message
    notification event listener callback context session cookie middleware router template layout form field label button input
    output format encode decode encrypt decrypt generate create update delete insert select remove append search filter order group
    company billing payment invoice customer product order item status active enabled disabled required optional internal external
    src/main/java/com/ src/test/ node_modules/ docs/ .json .html .yaml .java .py .js -starter- -plugin- -core- get_ set_ is_ has_ _name _id
    _path _file _type _key _token the of and to in is for that with this are be on as by it from or an at was""".split()
).encode()


class Novelty:
    def __init__(self, learned: tuple[str, ...] = ()):
        # what stands last in a dictionary is cheapest to refer to
        self.dict = zstandard.ZstdCompressionDict(" ".join(reversed(learned)).encode() + b" " + DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.c = zstandard.ZstdCompressor(level=3, dict_data=self.dict, write_content_size=False)

    def size(self, data: bytes) -> int:
        return len(self.c.compress(data))

    def most(self, before: bytes, candidate: bytes, after: bytes) -> float:
        """The marginal bytes of the most novel of its pieces of equal length, of at most PIECE bytes."""
        n = -(-len(candidate) // PIECE)
        cuts = [len(candidate) * i // n for i in range(n + 1)]
        return max(self.marginal(before + after, candidate[a:z]) for a, z in zip(cuts, cuts[1:], strict=False))

    def marginal(self, around: bytes, candidate: bytes) -> float:
        """Marginal compressed bytes for each byte of the candidate."""
        return (self.size(around + candidate) - self.size(around)) / max(1, len(candidate))


def classes(s: str) -> int:
    return any(c.islower() for c in s) + any(c.isupper() for c in s) + any(c.isdigit() for c in s) + any(c in "+/=_-." for c in s)


def capacity(s: str) -> float:
    """Bytes that a random character of the candidate's classes takes: hexadecimal digits are a class of their own."""
    has = lambda f: any(map(f, s))
    low, up = (f and (6 if all(c in "abcdef0123456789-" for c in s.lower()) else 26) for f in (has(str.islower), has(str.isupper)))
    return math.log2(max(2, low + up + 10 * has(str.isdigit) + len(set(s) & set("+/=_-.")))) / 8


def bound(token: str, novelty: float) -> float:
    """Marginal bytes a character of a novel token: a short one is not entropy-coded; a long one takes what its classes take."""
    return 0.65 if len(token) < CODED else min(0.65, novelty * capacity(token))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end): leftmost and non-overlapping within each kind; matches that are too short are consumed and dropped."""
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    out = []
    if any(w in low for w in _WORDS[:5]):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if _RUN in raw.translate(_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: float, tool: Novelty, context: int = 96) -> list[tuple[int, int, int]]:
    low = text.encode("utf-8", "surrogatepass").lower()
    if not any(w in low for w in _WORDS):
        return []
    out: list[tuple[int, int, int]] = []
    line_end = lambda at: len(text) if (e := text.find("\n", at)) < 0 else e
    done = -1  # all before is searched
    for m in SENSITIVE.finditer(text):
        at, end = max(m.end(), done), line_end(min(len(text), line_end(m.end()) + 1))
        while at < end:  # ends are those of lines, so no token is cut
            c = CANDIDATE.search(text, at, end)
            if not c:
                break
            at = c.end()
            token = c[0].strip(".-=")
            s = c.start() + c[0].find(token) if token else c.start()
            e = s + len(token)
            if len(token) < 16 or classes(token) < 2:
                continue
            if not any(a < e and s < z for a, _, z in base):
                sides = text[max(0, s - context) : s], text[e : e + context]
                if not sides[0].rpartition("\n")[2].strip() and not sides[1].partition("\n")[0].strip():
                    sides = tuple(CANDIDATE.sub("", x) for x in sides)  # alone on its line: the other lines of a key are like it
                before, after = (x.encode("utf-8", "surrogatepass") for x in sides)
                if tool.most(before, token.encode(), after) < bound(token, novelty):
                    continue
                out.append((s, 3, e))
            end = max(end, line_end(min(len(text), line_end(e) + 1)))
        done = max(done, end)
    return sorted(set(out))


def windows(text: str) -> list[str]:
    """The rest of each line with a sensitive word, and the next line."""
    low = text.encode("utf-8", "surrogatepass").lower()
    if not any(w in low for w in _WORDS):
        return []
    out, done = [], -1
    for m in SENSITIVE.finditer(text):
        if m.start() >= done:
            end = text.find("\n", m.end())
            done = len(text) if end < 0 or (more := text.find("\n", end + 1)) < 0 else more
            out.append(text[m.start() : done])
    return out


def learned_words(docs: DataFrame, least: int = LEARN_DOCS, most: int = LEARN_WORDS) -> tuple[str, ...]:
    """Parts of identifiers near sensitive words, by the number of distinct texts that have them; at most `most` reach the driver."""

    def run(batches):
        for b in batches:
            for t in b.column("text").to_pylist():
                words = sorted({x.lower() for w in windows(t) for x in PART.findall(w)})
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([hash_text(t)] * len(words), pa.int64())], ["word", "th"])

    each = docs.mapInArrow(run, "word string, th long").groupBy("word").agg(F.approx_count_distinct("th").alias("n"))
    got = each.where(F.col("n") >= least).orderBy(F.col("n").desc(), "word").limit(most).collect()
    return tuple(r["word"] for r in got)


def hash_text(t: str) -> int:
    return xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, novelty: float = 0.85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: array of (kind, start, end), base ones and those of the method."""
    d = C.keyed(docs, id_col, text_col).select("doc_id", "text")
    learned = learned_words(d)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        tool = Novelty(learned)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                out = []
                for t in part.column("text").to_pylist():
                    base = base_spans(t)
                    out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base + novel_spans(t, base, novelty, tool))])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    return d.mapInArrow(run, f"doc_id {dict(d.dtypes)['doc_id']}, spans array<struct<kind: string, start: long, end: long>>")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: counts and digest of base spans, and all spans."""
    s = scan(C.table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"] != "novel")
    return s.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def brute(text: str | None) -> tuple[int, int, int, str]:
    """The base columns by the plain patterns, without any shortcut."""
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if m.end() - m.start() >= 16]
    n = [sum(k == j for _, k, _ in out) for j in range(3)]
    return *n, hashlib.sha256(joined(sorted(out)).encode()).hexdigest()
