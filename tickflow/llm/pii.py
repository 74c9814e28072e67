"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors in a text: at-signs, schemes, a plus before a digit, pairs of
digits, digits before a dot, and identifier cues, in any case of ASCII letters.  A small deterministic parser then expands each anchor
to the whole item and validates it.  Kinds, in the order that breaks ties:

* email, ip, card, phone: the fixed grammars below, leftmost and non-overlapping within a kind; a match
  that fails its validation is dropped and not retried;
* url: a scheme and the address after it, with a host;
* account: an account number after a cue (or an IBAN whose check digits hold);
* secret: a value with digits after a cue such as ``token =``.

Spans are code points, end exclusive.  Defined results: a null or empty text has no spans.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate

KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")

# The grammars of the four base kinds.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

URL = re.compile(r"[A-Za-z0-9._~%-]+(?::[0-9]+)?(?:[/?#][^\s\"'<>\\^`{|}]*)?")
# What may stand between a cue and its value, in any case of letters. "NO", "NR" and "IS" before a digit start a value
# (country codes of account numbers); "no" and "No" do not.
_BETWEEN = (
    r"[\"']?\s?(?:(?i:number|n[or]\.|n[or](?![0-9a-z]))|[Nn][or])?(?:\s{0,2}(?i:is(?![0-9a-z])))?\s{0,2}[:=#]?\s{0,2}[\"']?"
)
VALUE = re.compile(_BETWEEN + r"(?P<value>[A-Za-z0-9][A-Za-z0-9_/+.=-]*[A-Za-z0-9=])")
ACCOUNT_VALUE = re.compile(_BETWEEN + r"(?P<value>[A-Z]{0,2}[0-9](?:[ -]?[A-Z0-9]){5,33})")

SCHEMES = ("http://", "https://", "ftp://")
ACCOUNT_CUES = ("account", "iban", "passport", "ssn", "social security")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key", "private_key")


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    digits = "0123456789"
    found.add_word("@", ("email", 1))
    for a in digits:
        found.add_word("+" + a, ("phone", 2))
        for b in digits:
            # A dotted or plain pair of digits starts an address or a number.
            found.add_word(f"{a}.{b}", ("ip", 3))
            for between in ("", " ", "-"):
                found.add_word(a + between + b, ("card", 2 + len(between)))
    for kind, cues in (("url", SCHEMES), ("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _lowered(text: str) -> str:
    """``text`` with its ASCII letters in lower case; code points keep their places."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _iban(value: str) -> bool:
    x = re.sub("[ -]", "", value)
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}", x):
        return False
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def _digit(c: str) -> bool:
    return "0" <= c <= "9"


def _ascii_digits(x: str) -> str:
    return "".join(c for c in x if _digit(c))


def _word_end(text: str, at: int) -> bool:
    return at >= len(text) or not (text[at].isalnum() or text[at] == "_")


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all items, in order of start, then kind."""
    out: list[tuple[int, int, str]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _automaton().iter(_lowered(text)):
        at = last - size + 1
        past = done[kind]
        if at < past:
            continue
        if kind == "card":
            m = CARD.match(text, at)
            done[kind] = m.end()
            digits = _ascii_digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((at, m.end(), kind))
        elif kind == "ip":
            while at > past and _digit(text[at - 1]):
                at -= 1
            m = IP.match(text, at)
            if m:
                done[kind] = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append((at, m.end(), kind))
        elif kind == "email":
            m = DOMAIN.match(text, at)
            begin = at
            if m:
                while begin > past and text[begin - 1] in LOCAL:
                    begin -= 1
            if m and begin < at:
                done[kind] = m.end()
                out.append((begin, m.end(), kind))
        elif kind == "phone":
            m = PHONE.match(text, at)
            if m:
                done[kind] = m.end()
                if 10 <= len(_ascii_digits(m[0])) <= 15:
                    out.append((at, m.end(), kind))
        elif kind == "url":
            m = URL.match(text, last + 1)
            if m:
                end = last + 1 + len(m[0].rstrip(".,;:!?)"))
                if end > last + 1:
                    done[kind] = end
                    out.append((at, end, kind))
        elif at == 0 or not text[at - 1].isalpha():
            m = (ACCOUNT_VALUE if kind == "account" else VALUE).match(text, last + 1)
            if m and _valid(kind, text, last + 1, m):
                done[kind] = m.end("value")
                out.append((*m.span("value"), kind))
    out.sort(key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return out


def _valid(kind: str, text: str, after: int, m: re.Match) -> bool:
    value, between = m["value"], text[after : m.start("value")]
    if kind == "account":
        return bool(between.strip() or between == " ") and (_iban(value) or 6 <= len(_ascii_digits(value)) <= 34)
    # A secret follows a sign and has digits, so that prose after the word stays prose.
    return any(c in between for c in ":=") and len(value) >= 8 and any(map(_digit, value)) and _word_end(text, m.end())


FIELDS = [
    T.StructField(
        "found",
        T.ArrayType(
            T.StructType(
                [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]
            )
        ),
    )
]


def find(docs: DataFrame) -> DataFrame:
    """``_row`` (the columns of ``docs``) and ``found``: the spans of every whole text."""

    def fn(texts: pa.Array) -> dict:
        return {"found": [[dict(zip(("start", "end", "kind"), x, strict=True)) for x in spans(t)] for t in texts.to_pylist()]}

    return annotate(docs, FIELDS, fn)


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of their spans, all spans."""
    found = F.col("found")
    base = F.filter(found, lambda x: x["kind"].isin("email", "ip", "card", "phone"))

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:4]]
    return find(docs.select("doc_id", "text")).select(
        f"{ROW}.doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(found).alias("spans")
    )


def masked(text: str) -> str:
    """``text`` with every item replaced by its kind in angle brackets; overlapping items are one."""
    out, at = [], 0
    for start, end, kind in spans(text):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their items masked; ``n_chars`` follows the text where there is such a column."""
    fields = [T.StructField("clean", T.StringType())]

    def fn(texts: pa.Array) -> dict:
        return {"clean": [masked(t) for t in texts.to_pylist()]}

    text = F.when(F.col(f"{ROW}.text").isNotNull(), F.col("clean"))
    columns = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return annotate(docs, fields, fn).select(*[columns.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])
