"""Secret scans: fixed patterns, and novelty against a primed dictionary.

Besides the patterns, strings in a sensitive context are measured by the
bytes they add to the zstandard frame of the text around them, compressed
with a dictionary of identifiers common in code.  Words, paths and names
that occur in the surroundings or the dictionary add little; random strings
add about their length and are reported as ``novel``.  Strings that read like
words, once cut at signs and changes of case, are not measured: no dictionary
holds them all.
"""
from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # as [0-9a-f]+, which ends with its run, kept from 24 characters on
SENSITIVE = re.compile(r"password|passwd|passphrase|pass_phrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key"
                       r"|credential|bearer|authorization", re.I | re.A)
STRING = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
#: lines of a PEM body whose end is missing
PEM_LINES = re.compile(r"(?:[^A-Za-z0-9+/]{0,48}[A-Za-z0-9+/=]{16,})*")
#: from the end of a sensitive word in a name to its value, in one run
VALUE = re.compile(r"[^=]*=+(?=[A-Za-z0-9+/_=-]{16})")
#: what may stand between the lines of a value
LINE_END = re.compile(r"[^A-Za-z0-9]*\n[^A-Za-z0-9]*")
#: a text without any of these has no span (RE2 pattern, a superset of the above)
HINT = (r"(?i:password|passwd|passphrase|pass_phrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key"
        r"|credential|bearer|authorization)"
        r"|AKIA|[0-9a-f]{24}")
#: identifiers that prime the dictionary
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key credential bearer authorization client_secret "
    "client_id user username user_name account config configuration settings environment default example placeholder "
    "changeme your_token_here your_api_key insert_here xxxxxxxxxxxxxxxx 0123456789 1234567890 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ getElementById addEventListener document window function return const import export "
    "public private protected static class interface string integer boolean null undefined true false self this super "
    "http https www localhost 127.0.0.1 example.com github.com application/json Content-Type charset utf-8 base64 "
    "SELECT INSERT UPDATE DELETE WHERE session request response header cookie service database connection host port "
    "path file directory index value name type length size count number result error message exception handler "
    "manager factory builder provider controller repository test_ _test get_ set_ is_ has_ from_ to_ __init__ main"
)
#: fixed values: the pairs of letters that most words of English, German, French and Spanish are made of
PAIRS = frozenset((
    "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro "
    "ic ne ea ra ce li ch ll be ma si om ur ca el ta la ns di fo ho pe ec pr no ct us ac ot il tr ly nc et ut ss so "
    "rs un lo wa ge ie wh ee wi em ad ol rt po we na ul ni ts mo ow pa im mi ai sh ir su id os iv ia am fi ci vi pl "
    "ig tu ev ld ry mp fe bl ab gh ty op wo sa ay ex ke fr oo av ag if ap gr od bo sp rd do uc bu ei ov by rm ep tt "
    "oc fa ef cu rn sc gi da yo cr cl du ga qu ue ff ba ey ls va um pp ua up lu go ht ru ug ds lt pi rc rr eg au ck "
    "ew mu br bi pt ak pu ui rg ib tl ny ki rk ys").split())
#: pieces of a name or path: words in capitals, words, numbers
PIECES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: least share of the letters in pieces of three or more, and of their pairs
#: among PAIRS, and the most digits, of a string that reads like words
IN_WORDS, COMMON_PAIRS, MOST_DIGITS = 0.85, 0.7, 4
#: characters of context on either side, how far ahead the sensitive word may
#: be, and the least share of its own length that a novel string adds
CONTEXT, REACH, NOVELTY = 256, 48, 0.6
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


@lru_cache(maxsize=1)
def _compressor():
    import zstandard
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=3, dict_data=primed, write_checksum=False, write_content_size=False)


def novelty(before: str, string: str, after: str) -> float:
    """Bytes that ``string`` adds to its compressed surroundings, per byte of it."""
    c = _compressor()
    around = f"{after}\n{before}".encode("utf-8", "surrogatepass")
    own = string.encode("utf-8", "surrogatepass")
    return (len(c.compress(around + own)) - len(c.compress(around))) / max(1, len(own))


def reads_like_words(string: str) -> bool:
    """Whether a string is a name or a path: cut at changes of case and at
    signs, its letters stand in words, and these have the pairs of letters
    that words have."""
    pieces = PIECES.findall(string)
    letters, digits = sum(c.isalpha() for c in string), sum(c.isdigit() for c in string)
    long = [p.lower() for p in pieces if len(p) > 2 and not p[0].isdigit()]
    if digits > MOST_DIGITS or not letters or sum(map(len, long)) < IN_WORDS * letters:
        return False
    pairs = [p[i:i + 2] for p in long for i in range(len(p) - 1)]
    return sum(x in PAIRS for x in pairs) >= COMMON_PAIRS * len(pairs)


def _pem_bodies(text: str):
    """Spans between the marks of PEM private keys; of a key without its end
    mark, the lines that look like one."""
    end = 0
    for m in PEM.finditer(text):
        if m.end() < end:
            continue
        b = m.end()
        end = text.find("-----", b)  # an end mark or the next key
        while end >= 0 and not text.startswith(("-----END", "-----BEGIN"), end):
            end = text.find("-----", end + 1)
        if end < 0 or text.startswith("-----BEGIN", end):
            end = PEM_LINES.match(text, b).end()
        if STRING.search(text, b, end):
            yield b, end


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of a text in code points, by start, then kind
    in the order of KINDS.  Novel spans lie outside the others.

    Measured are the bodies of PEM private keys; values behind '=' in a run
    that has a sensitive word before it; runs within REACH after a sensitive
    word, on its line or a later one; and the next line of a novel run."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    taken = sorted((s, e) for _, s, e in found)
    sensitive = [m.end() for m in SENSITIVE.finditer(text)]

    def novel(s: int, e: int) -> bool:
        return not reads_like_words(text[s:e]) and novelty(text[max(0, s - CONTEXT):s], text[s:e], text[e:e + CONTEXT]) >= NOVELTY
    bodies = [(s, e) for s, e in _pem_bodies(text) if novelty("", text[s:e], "") >= NOVELTY] if sensitive else []
    t = 0
    for s, e in bodies:  # around the other spans
        at = s
        while t < len(taken) and taken[t][0] < e:
            found += [("novel", at, taken[t][0])] if taken[t][0] > at else []
            at = max(at, taken[t][1])
            t += 1
        found += [("novel", at, e)] if e > at else []
    taken = sorted(taken + bodies)
    k = t = w = 0
    reach = last = -1  # the end of the taken spans so far, and of the last novel run
    for m in STRING.finditer(text) if sensitive else ():
        s, e = m.span()
        while k + 1 < len(sensitive) and sensitive[k + 1] <= s:
            k += 1
        while w < len(sensitive) and sensitive[w] <= s:
            w += 1
        near = sensitive[k] <= s <= sensitive[k] + REACH or 0 <= last <= s <= last + REACH and LINE_END.fullmatch(text, last, s)
        word = sensitive[w] if w < len(sensitive) and sensitive[w] < e else -1  # the first that ends inside
        value = VALUE.match(text, word, e) if word >= 0 else None
        if value:
            s = value.end()
        elif not near or word >= 0 and ("=" in m[0] or text[e:e + 1] == ":") and not any(c.isdigit() for c in m[0]):
            continue  # far from any, or a name
        while t < len(taken) and taken[t][0] < e:
            reach = max(reach, taken[t][1])
            t += 1
        if reach > s:
            continue
        if novel(s, e):
            found.append(("novel", s, e))
            last = e
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _spans(texts: pa.Array) -> list[list[dict]]:
    hit = pc.match_substring_regex(texts, HINT).to_pylist()
    return [[dict(zip(("kind", "start", "end"), x)) for x in find(texts[i].as_py())] if h else []
            for i, h in enumerate(hit)]


@F.arrow_udf(SPANS)
def _scan(texts: pa.Array) -> pa.Array:
    return pa.array(_spans(texts), pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start and end of every secret in the
    whole text (null has none).  An input column ``spans`` is replaced."""
    return without(docs, ["spans"]).withColumn("spans", _scan(F.col(text)))


def redacted(text: str, spans, mark: str) -> str:
    out, at = [], 0
    for x in spans:
        if x["end"] > at:
            out += [text[at:x["start"]], mark] if x["start"] >= at else []
            at = x["end"]
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``, once where
    spans overlap; other rows, and nulls, stay as they are."""
    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        found = _spans(texts)
        if not any(found):
            return texts
        return pa.array([redacted(x.as_py(), f, mark) if f else x.as_py() for x, f in zip(texts, found)], pa.string())
    return docs.withColumn(text, clean(F.col(text)))
