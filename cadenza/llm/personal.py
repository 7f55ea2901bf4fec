"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs before a digit, URL schemes,
account cues and the shortest pieces that every address or card number holds (two digits beside each
other, or with a dot, blank or hyphen between). From an anchor a parser of its own kind expands to the
boundaries and validates what it finds; anchors inside what a kind has already consumed are skipped,
so a text is read a constant number of times, whatever it holds.

Kinds, in the order in which spans of equal start are listed: email, ip, card, phone are the base; url,
iban and account are added. A kind's matches are leftmost and do not overlap; one that fails its test
goes and is not tried again from a later start. Spans are code points, end exclusive; iban and account
give the number after the cue.

Defined results: a null or empty text has no spans; a row without doc_id is scanned like any other;
repeated rows give repeated results; a very long text is one row, scanned whole, and left expansion
doubles its window, so the cost stays linear; an empty table gives an empty table; columns other than
doc_id and text are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import bounded_batches, packed, plain_docs, spread, unpacked

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
BASE = 4
#: What a kind's matches look like. The parsers below expand to the same boundaries; the SQL uses these as they stand.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "url": r"(?:https?|ftp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%\[\]-]*[A-Za-z0-9/]",
    "iban": r"(?:IBAN|Iban|iban):?\x20?([A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?))",
    "account": r"(?:[Aa]ccount|ACCOUNT|[Aa]cct)(?:\x20(?:number|no\.?|nr\.?))?[:#]?\x20?([0-9]+)",
}
CUES = {"url": ("http://", "https://", "ftp://"), "iban": ("IBAN", "Iban", "iban"), "account": ("Account", "account", "ACCOUNT", "Acct", "acct")}

DIGITS = "0123456789"
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + DIGITS + "._%+-"
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_numbers = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_match: dict[str, re.Pattern] = {kind: re.compile(p) for kind, p in PATTERNS.items()}

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def automaton() -> ahocorasick.Automaton:
    """Anchors to (kinds, length of the anchor); a kind's parser gets the place where the anchor starts."""
    words: dict[str, list[int]] = {"@": [0]}
    for a in DIGITS:
        words["+" + a] = [3]
        for b in DIGITS:
            words[f"{a}.{b}"] = [1]
            for between in ("", " ", "-"):
                words[a + between + b] = [2]
    for kind, cues in CUES.items():
        for cue in cues:
            words.setdefault(cue, []).append(KINDS.index(kind))
    found = ahocorasick.Automaton()
    for word, kinds in words.items():
        for kind in kinds:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def back(text: str, at: int, low: int, chars: str) -> int:
    """Where the run of ``chars`` that ends before ``at`` begins, not before ``low``."""
    width = 64
    while True:
        cut = max(low, at - width)
        kept = len(text[cut:at].rstrip(chars))
        if kept or cut == low:
            return cut + kept
        width *= 4


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The check of an international account number: letters count from 10, the first four characters go last."""
    rest = 0
    for c in account[4:] + account[:4]:
        x = int(c, 36)
        rest = (rest * (10 if x < 10 else 100) + x) % 97
    return rest == 1


def _email(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    start = back(text, at, low, LOCAL)
    found = _domain.match(text, at) if start < at else None
    if found is None:
        return low
    keep(start, found.end())
    return found.end()


def _ip(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    """A chain of numbers with dots between is consumed whole, four numbers at a time."""
    start = back(text, at, low, DIGITS)
    chain = _numbers.match(text, start)
    parts, place = chain.group().split("."), start
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        end = place + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
            keep(place, end)
        place = end + 1
    return chain.end()


def _card(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    chain = _match["card"].match(text, at)
    digits = chain.group().replace(" ", "").replace("-", "")
    if 14 <= len(digits) <= 19 and luhn(digits):
        keep(at, chain.end())
    return chain.end()


def _phone(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    found = _match["phone"].match(text, at)
    if found is None:
        return low
    if 10 <= sum(c in DIGITS for c in found.group()) <= 15:
        keep(at, found.end())
    return found.end()


def _url(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    found = _match["url"].match(text, at)
    if found is None:
        return low
    keep(at, found.end())
    return found.end()


def _iban(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    found = _match["iban"].match(text, at)
    if found is None:
        return low
    if mod97(found.group(1).replace(" ", "")):
        keep(*found.span(1))
    return found.end()


def _account(text: str, at: int, low: int, keep: Callable[[int, int], None]) -> int:
    found = _match["account"].match(text, at)
    if found is None:
        return low
    if 6 <= len(found.group(1)) <= 17:
        keep(*found.span(1))
    return found.end()


#: Each gets the text, an anchor's start, the end of what its kind has consumed, and where to put a valid span; each returns the new end.
PARSERS = (_email, _ip, _card, _phone, _url, _iban, _account)
_anchors: list[ahocorasick.Automaton] = []


def personal_spans(text: str) -> list[Span]:
    """All spans of a text, sorted by start and then in the order of KINDS."""
    if not _anchors:
        _anchors.append(automaton())
    found: list[Span] = []
    done = [0] * len(KINDS)
    for last, (kind, width) in _anchors[0].iter(text):
        at = last + 1 - width
        if at >= done[kind]:
            done[kind] = PARSERS[kind](text, at, done[kind], lambda start, end, kind=kind: found.append((start, kind, end)))
    return sorted(found)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


DIGEST = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in range(BASE)]
            hashes, listed = [], []
            for text in batch.column("text"):
                spans = personal_spans(text.as_py())
                base = [s for s in spans if s[1] < BASE]
                for kind, out in enumerate(counts):
                    out.append(sum(s[1] == kind for s in base))
                hashes.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                listed.append(_listed(spans))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(listed, pa.string())]
            yield pa.record_batch(columns, names=[x.split()[0] for x in DIGEST.split(", ")])

    return spread(plain_docs(documents)).mapInArrow(digest, DIGEST)


def redacted(text: str) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first names all."""
    out, at = [], 0
    for start, kind, end in personal_spans(text):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with personal data in texts replaced, and n_chars set anew."""
    bounded_batches(documents.sparkSession)
    rows = packed(documents).select("kept", "text")
    schema = StructType([*rows.schema.fields, StructField("clean", StringType())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            made = pa.array([None if t is None else redacted(t) for t in texts], pa.string())
            yield pa.record_batch([*batch.columns, made], names=["kept", "text", "clean"])

    found = spread(rows).mapInArrow(clean, schema)
    new = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        changed = F.col("clean").isNotNull() & (F.col("clean") != F.col("text"))
        new["n_chars"] = F.when(changed, F.length("clean").cast(kind)).otherwise(F.col("kept.n_chars"))
    return unpacked(found, documents.columns, **new)


def _oracle() -> str:
    """DuckDB: cut each text at a kind's matches, add up the lengths, test every match."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    tests = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(x AS HUGEINT), 999) > 255)) = 0",
        "card": "length(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 THEN d[i]::INT WHEN d[i]::INT > 4 THEN 2 * d[i]::INT - 9 ELSE 2 * d[i]::INT END)) % 10 = 0",
        "phone": "length(d) BETWEEN 10 AND 15",
        "url": "true",
        "iban": "list_reduce(list_prepend(0, list_transform(string_split(substr(replace(g, ' ', ''), 5) || substr(replace(g, ' ', ''), 1, 4), ''), lambda x: (CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END)::INT)), lambda r, v: CASE WHEN v < 10 THEN (r * 10 + v) % 97 ELSE (r * 100 + v) % 97 END) = 1",
        "account": "length(g) BETWEEN 6 AND 17",
    }
    found = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS kind, regexp_extract_all(t, {quoted(PATTERNS[k])}) AS ms, regexp_extract_all(t, {quoted(PATTERNS[k])}, {int(k in ('iban', 'account'))}) AS gs, string_split_regex(t, {quoted(PATTERNS[k])}) AS ps FROM d WHERE regexp_matches(t, {quoted(PATTERNS[k])})"
        for i, k in enumerate(KINDS)
    )
    valid = " ".join(f"WHEN {i} THEN {tests[k]}" for i, k in enumerate(KINDS))
    names = ", ".join(quoted(k) for k in KINDS)
    counted = ", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(KINDS[:BASE]))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
u AS (SELECT doc_id, kind, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[:len(ms)]) AS p, unnest(range(1, len(ms) + 1)) AS i FROM f),
s AS (
  SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d, sum(length(p) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS s1 FROM u
),
k AS (SELECT doc_id, kind, (s1 - length(g))::BIGINT AS s0, s1::BIGINT AS s1, [{names}][kind + 1] || ':' || (s1 - length(g))::BIGINT || ':' || s1::BIGINT AS said FROM s WHERE CASE kind {valid} END),
a AS (SELECT doc_id, {counted}, string_agg(said, ',' ORDER BY s0, kind) FILTER (kind < {BASE}) AS base, string_agg(said, ',' ORDER BY s0, kind) AS spans FROM k GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS[:BASE])}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE = _oracle()
