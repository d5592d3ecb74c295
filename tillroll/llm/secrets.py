"""Secret scan: fixed patterns, and strings of sensitive contexts that zstandard can't compress.

The patterns find assignments to password-like names, access key ids and long
hexadecimal runs.  Beyond them, a candidate is a run of key-like characters
with a letter and a digit that follows a sensitive word on its line.
Its novelty is its marginal size: the bytes that it adds to the compressed text
around it, by a zstandard coder primed with a dictionary of identifiers, for
each of its characters.  Identifiers, placeholders and what the neighbourhood
repeats cost next to nothing; a random key costs nearly its length and is
reported.

The dictionary is a fixed list of common names and the letter words that occur
in the contexts of candidates of most documents of the corpus, counted in Spark
over all of them and cut at ``DICTIONARY`` bytes, which bounds what is broadcast.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.chunks import own_columns
from tillroll.llm.graph import cut

# fixed values: kinds and patterns
BASE = ("assign", "access", "hex")
NOVEL = "novel"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST = 6  # characters of an assigned value
# fixed values: words of a sensitive context
SENSITIVE = re.compile(r"passw(?:or)?d|pwd|secret|token|api_?key|private|credential|auth|bearer|login|access|signature|key",
                       re.I | re.A)
# fixed values: names and placeholders of code that are no secrets
NAMES = """abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 1234567890 deadbeef 00000000
xxxxxxxxxxxxxxxx XXXXXXXXXXXXXXXX changeme example placeholder default test sample dummy undefined null none true false
password passwd secret token api_key apikey access_key secret_key private_key public_key client_id client_secret
username user_name user_id account session session_id authorization bearer basic credential credentials signature
login logout config configuration environment variable process env getenv os.environ your_api_key_here YOUR_TOKEN
localhost http:// https:// www. .com .org .net /usr/local/bin /etc/ /home/ application/json text/html Content-Type
import from return function class public private static const string integer boolean version release debug error
encrypt decrypt encode decode hash md5 sha1 sha256 sha512 base64 utf-8 uuid key_id key-id key_name value""".split()

HINTS = ("passw", "pwd", "secret", "token", "api", "private", "credential", "auth", "bearer", "login", "access", "signature", "key")

SHORT = 12          # characters of the shortest candidate
BEGIN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d}" % SHORT)
RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
REACH = 48          # code points from a sensitive word to the candidate
BEFORE, AFTER = 160, 64  # code points around a candidate that prime its coder
NOVELTY = 0.7       # marginal bytes for each character, at least
DICTIONARY = 32 << 10
LEVEL = 12
WORD = re.compile(r"[A-Za-z_]{4,40}")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost non-overlapping per kind."""
    found = []
    if any(c in text for c in ":="):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def candidates(text: str, spans: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """(start, end) of key-like runs behind a sensitive word on its line that no base span touches."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    taken = sorted((s, e) for s, _, e in spans)
    starts, reached = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    out, done = [], 0
    for m in SENSITIVE.finditer(text):
        line = text.find("\n", m.end(), m.end() + REACH)
        limit = line if line >= 0 else m.end() + REACH
        c = BEGIN.search(text, max(m.end(), done), limit + SHORT)
        while c:
            s, done = c.start(), RUN.match(text, c.start()).end()
            run = text[s:done]
            before = bisect_left(starts, done)
            if (any(map(str.isdigit, run)) and any(map(str.isalpha, run))
                    and not (before and reached[before - 1] > s)):
                out.append((s, done))
            c = BEGIN.search(text, done, limit + SHORT)
    return out


class Coder:
    """Marginal compressed sizes under a dictionary of identifiers."""

    def __init__(self, words: bytes):
        import zstandard

        primed = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed, write_content_size=False, write_checksum=False,
                                              write_dict_id=False)

    def novelty(self, before: str, run: str, after: str) -> float:
        """Bytes that ``run`` adds to its surroundings (without its own repeats), for each of its characters."""
        around = (before + "\n" + after + "\n").replace(run, "").encode()
        own = run.encode()
        return (len(self._zstd.compress(around + own)) - len(self._zstd.compress(around))) / len(own)


def dictionary(found: DataFrame, size: int = DICTIONARY) -> bytes:
    """The fixed names and the letter words of the most contexts' documents, the commonest last (nearest to the text)."""
    word = F.explode(F.array_distinct(F.flatten(F.transform("candidates", lambda c: F.regexp_extract_all(
        F.concat_ws("\n", c["before"], c["after"]), F.lit(WORD.pattern), F.lit(0)))))).alias("word")
    # a word takes 5 bytes at least, so these are all that fit
    common = (found.where(F.size("candidates") > 0).select(word).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
              .where("n > 1").orderBy(F.desc("n"), "word").limit(size // 5).collect())
    out, room = [], size - sum(len(x) + 1 for x in NAMES)
    for r in common:
        room -= len(r["word"]) + 1
        if room < 0:
            break
        out.append(r["word"])
    return " ".join([*reversed(out), *NAMES]).encode()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: float = NOVELTY) -> DataFrame:
    """``docs`` without the text, with spans: array of (kind, start, end, novelty), by start, then kind as listed.

    Places are code points, the end exclusive; kinds are assign, access, hex
    (novelty NULL) and novel.  Each kind's spans don't overlap; a novel span
    touches no other.  A column named spans is replaced, the others stay.  A
    NULL or empty text has no spans.  Repeated rows are scanned each, NULL ids
    like any other; an empty table gives an empty table.
    """
    own = [c for c in own_columns(docs, "spans") if c != text_col]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    comma = ", " if own else ""
    kinds = (*BASE, NOVEL)
    part = "array<struct<start:int,end:int,run:string,before:string,after:string>>"
    part_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("run", pa.string()),
                                    ("before", pa.string()), ("after", pa.string())]))
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())]))

    def scan(batches):
        for batch in batches:
            base, near = [], []
            for t in batch.column(len(own)).to_pylist():
                spans = base_spans(t) if t else []
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                near.append([{"start": s, "end": e, "run": t[s:e], "before": t[max(0, s - BEFORE):s], "after": t[e:e + AFTER]}
                             for s, e in (candidates(t, spans) if t else [])])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(own)], pa.array(base, base_type), pa.array(near, part_type)],
                                             [*own, "base", "candidates"])

    found = cut(docs.select(*own, F.col(text_col).cast("string").alias("__text")).mapInArrow(
        scan, f"{fields}{comma}base array<struct<start:int,kind:string,end:int>>, candidates {part}"))
    shared = docs.sparkSession.sparkContext.broadcast(dictionary(found))  # DICTIONARY bytes

    def judge(batches):
        coder = Coder(shared.value)
        for batch in batches:
            out = []
            for base, near in zip(*(batch.column(len(own) + j).to_pylist() for j in (0, 1))):
                spans = [(b["start"], kinds.index(b["kind"]), b["end"], None) for b in base]
                for c in near:
                    score = coder.novelty(c["before"], c["run"], c["after"])
                    if score >= novelty:
                        spans.append((c["start"], len(BASE), c["end"], score))
                out.append([{"kind": kinds[k], "start": s, "end": e, "novelty": x} for s, k, e, x in sorted(
                    spans, key=lambda z: z[:2])])
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(own)], pa.array(out, span_type)], [*own, "spans"])

    return found.mapInArrow(
        judge, f"{fields}{comma}spans array<struct<kind:string,start:int,end:int,novelty:double>>")
