"""Secret scan: keyword automaton first, anchored patterns at its hits, checksums last."""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from postloom.llm.common import pick

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
FORGE = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
WEB_TOKEN = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
KEY_BLOCK = re.compile(r"-----BEGIN (?P<kind>[A-Z ]*PRIVATE KEY)-----(?P<body>[A-Za-z0-9+/=\s]+)-----END (?P=kind)-----")
# A web token's parts are runs of these characters.
TOKEN_RUN = re.compile(r"[A-Za-z0-9_-]+")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _decoded(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_", validate=True)
    except (binascii.Error, ValueError):
        return None


def forge_checksum(body: str) -> str:
    """The six base62 digits of a CRC-32 that close tokens of code forges."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = BASE62[d] + digits
    return digits


def _web_token(m: re.Match) -> bool:
    try:
        header = json.loads(_decoded(m[1]) or b"")
        return isinstance(header, dict) and "alg" in header and _decoded(m[2]) is not None
    except ValueError:
        return False


# kind, keywords (lower case), anchored pattern, what a match must pass. The order breaks ties.
# ``hex`` has no keyword: every run of its characters is a hit.
KEYWORD_KINDS = (
    ("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"), ASSIGN, lambda m: len(m[2]) >= 12),
    ("access", ("akia",), ACCESS, lambda m: len(m[0]) >= 18),
    ("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), FORGE, lambda m: forge_checksum(m[1]) == m[2]),
    ("web_token", ("eyj",), WEB_TOKEN, _web_token),
    ("key_block", ("-----begin ",), KEY_BLOCK, lambda m: _decoded("".join(m["body"].split())) is not None),
)
KINDS = ("assign", "access", "hex", "forge", "web_token", "key_block")
BASE_KINDS = KINDS[:3]


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, (_, keywords, _, _) in enumerate(KEYWORD_KINDS):
        for word in keywords:
            found.add_word(word, (number, len(word)))
    found.make_automaton()
    return found


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then by the order of the kinds.

    Per kind the matches are leftmost and do not overlap: a pattern is tried at keyword
    hits from left to right, and hits inside its last match are passed over, whether or
    not that match was dropped by its length or checksum. A web token that does not match
    from one hit matches from no other hit in the same run of token characters, since
    what must follow the run is the same: those hits are passed over too, so a run of
    keywords is read a bounded number of times.
    """
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only: positions stay
    spans = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    hits = sorted((number, end + 1 - size) for end, (number, size) in _automaton().iter(lowered))
    current, free = -1, 0
    for number, start in hits:
        if number != current:
            current, free = number, 0
        if start < free:
            continue
        kind, _, pattern, valid = KEYWORD_KINDS[number]
        match = pattern.match(text, start)
        if match:
            free = match.end()
            if valid(match):
                spans.append((kind, match.start(), match.end()))
        elif kind == "web_token":
            free = TOKEN_RUN.match(text, start).end()
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            [dict(zip(("kind", "start", "end"), span)) for span in find_secrets(text)] if text else []
            for text in (value.as_py() for value in batch.column("text"))
        ]
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.list_(SPAN))], ["key", "secrets"])


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, secrets array<struct<kind, start, end>>)``, one row per input row.

    Every row is a task-local scan of the whole text; nothing is shuffled. A null text has
    no secrets. Repeated rows and null keys keep their rows; other columns are left out.
    """
    rows = pick(df, key=key, text=text)
    found = rows.mapInArrow(_scan, f"key {rows.schema['key'].dataType.simpleString()}, secrets array<struct<kind:string,start:bigint,end:bigint>>")
    return found.withColumnRenamed("key", key)
