"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Five kinds are certain once their check holds (e-mail address, IP address, card
number with its Luhn digit, international phone number, bank account number with
its mod-97 remainder). IPv6 addresses must parse. Secrets are private key blocks,
tokens of a known prefix, web tokens whose header decodes, passwords of addresses
and assignments, and long runs mixed of letters and digits. These runs, like
national numbers, have no check and count only with a telling word nearby; words
such as "example" or "checksum" nearby lower a score. The four base kinds stay
whatever their score. Every search runs in time linear in the text.

An account number ends where its country's length says, whatever capitals or
digits follow after a space; for countries without a known length the ends of
its groups are tried from the longest on.

Spans are code points, end exclusive. Defined cases: a null or empty text has no
spans; a null id stays null; rows with equal ids are searched one by one; an
empty table gives an empty result; extra columns are not read by :func:`find`
and passed on unchanged by :func:`redact`. One pass, no shuffle.
"""

from __future__ import annotations

import base64
import binascii
import ipaddress
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import as_bytes, free_name, map_arrow

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "national_id", "ip6", "private_key", "secret"]
ORDER = {kind: i for i, kind in enumerate(KINDS)}

# Score of a proposed span, what a passed check adds, what a word nearby adds, what a word of doubt takes.
PROPOSED = {
    "email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "national_id": 0.3,
    "ip6": 0.3, "private_key": 0.9, "secret": 0.3,
}
CHECKED = 0.4
NEARBY = 0.3
DOUBT = 0.3
THRESHOLD = 0.6
CONTEXT_CHARS = 48
CONTEXT = {
    "email": {"email", "e-mail", "mail", "contact", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "call", "tel", "mobile", "fax", "telefon", "telephone", "telefono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "national_id": {"ssn", "social", "security", "tax", "passport"},
    "ip6": {"ip", "ipv6", "address", "host", "server", "adresse"},
    "private_key": {"key", "private"},
    "secret": {"secret", "token", "password", "passwd", "passwort", "apikey", "key", "bearer", "credential", "credentials"},
}
# Words that speak against a find; digests and revisions look like keys.
DOUBTFUL = {"example", "sample", "dummy", "placeholder", "fake", "checksum", "digest", "sha", "md", "commit", "revision", "hash"}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?(?![A-Za-z0-9])")
# Lengths of account numbers by country, from the IBAN registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IP6 = re.compile(r"(?<![A-Za-z0-9:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![A-Za-z0-9:])")
KEY_BEGIN = re.compile(r"-----BEGIN (?:[A-Z0-9]{1,16} ){0,4}PRIVATE KEY(?: BLOCK)?-----")
KEY_END = re.compile(r"-----END (?:[A-Z0-9]{1,16} ){0,4}PRIVATE KEY(?: BLOCK)?-----")
# Documented prefixes of access keys and tokens.
KNOWN_TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}|github_pat_[A-Za-z0-9_]{22,255}"
    r"|glpat-[A-Za-z0-9_-]{20,255}|xox[abeoprs]-[A-Za-z0-9-]{10,255}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}"
    r"|[rs]k_(?:live|test)_[A-Za-z0-9]{16,255}|SG\.[A-Za-z0-9_-]{16,64}\.[A-Za-z0-9_-]{16,64})(?![A-Za-z0-9_-])"
)
WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++")
URL_LOGIN = re.compile(r"://([^\s:/@\[\]]{1,128}:[^\s/@]{1,128})@")
PASSWORD = re.compile(r"(?i)(?<![a-z])(?:password|passwd|passwort|pwd)[\"']?[ \t]{0,4}[:=][ \t]{0,4}[\"']?([^\s\"',;]{6,128})")
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")

SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses. Only an ``@`` can make one, so the search goes from each to the next."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        # What lies before this sign can't belong to a later address.
        done = match.end() if match else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def small_part(part: str) -> bool:
    rest = part.lstrip("0")
    return len(rest) <= 3 and int(rest or "0") <= 255


def only_digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def ip_ok(text: str) -> bool:
    return all(map(small_part, text.split(".")))


def card_ok(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def phone_ok(text: str) -> bool:
    return 10 <= len(only_digits(text)) <= 15


def iban_ok(text: str) -> bool:
    account = text.replace(" ", "")
    return 15 <= len(account) <= 34 and mod97(account)


def ip6_ok(text: str) -> bool:
    """A real address; what code and clocks write with colons has too few groups."""
    if sum(map(bool, text.split(":"))) < 3 or not DIGIT.search(text):
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def web_token_ok(header: str) -> bool:
    try:
        fields = json.loads(base64.urlsafe_b64decode(header + "=" * (-len(header) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(fields, dict) and "alg" in fields


def random_run(run: str) -> bool:
    """Letters and digits in a mix that words, numbers and paths don't have: one in eight characters, and many changes."""
    digits = [c.isdigit() for c in run]
    changes = sum(a != b for a, b in zip(digits, digits[1:]))
    return min(sum(digits), len(run) - sum(digits)) * 8 >= len(run) and changes * 6 >= len(run) and len(set(run)) >= 8


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers, leftmost first. A match takes in what may follow, so the search goes on right after its number."""
    match = IBAN.search(text)
    while match:
        whole = match.group()
        # Ends of groups; a number never ends within a run.
        ends = [len(whole), *(i for i in range(len(whole) - 1, 0, -1) if whole[i] == " ")]
        length = IBAN_LENGTHS.get(whole[:2].upper())
        if length:
            # Known countries: their length, or else the whole match.
            ends = [e for e in ends if e - whole.count(" ", 0, e) == length] + [len(whole)]
        elif not whole[:2].isupper():
            ends = []
        end = next((e for e in ends if iban_ok(whole[:e])), None)
        if end:
            yield match.start(), match.start() + end
        match = IBAN.search(text, match.start() + (end or 1))


def private_keys(text: str) -> Iterator[tuple[int, int]]:
    """Blocks from their first to their last line; an unclosed one is its first line."""
    begin = KEY_BEGIN.search(text)
    while begin:
        end = KEY_END.search(text, begin.end())
        follows = KEY_BEGIN.search(text, begin.end())
        closed = end and (not follows or end.start() < follows.start())
        yield begin.start(), end.end() if closed else begin.end()
        begin = KEY_BEGIN.search(text, end.end()) if closed else follows
        if not end:
            # No later block is closed either.
            while begin:
                yield begin.span()
                begin = KEY_BEGIN.search(text, begin.end())


def secrets(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether form or header confirm it), each place once."""
    found: dict[tuple[int, int], bool] = {}
    for match in KNOWN_TOKEN.finditer(text):
        found[match.span()] = True
    if "eyJ" in text:
        for match in WEB_TOKEN.finditer(text):
            if web_token_ok(match.group(1)):
                found[match.span()] = True
    if "://" in text:
        for match in URL_LOGIN.finditer(text):
            found[match.span(1)] = True
    for match in PASSWORD.finditer(text):
        # A sentence about passwords goes on with a plain word.
        if not match.group(1).isalpha():
            found[match.span(1)] = True
    sure, i = sorted(found), 0
    for match in RUN.finditer(text):
        while i < len(sure) and sure[i][1] <= match.start():
            i += 1
        if random_run(match.group()) and not (i < len(sure) and sure[i][0] < match.end()):
            found[match.span()] = False
    for (start, end), ok in found.items():
        yield start, end, ok


PATTERNS = [("ip", IP, ip_ok), ("card", CARD, card_ok), ("phone", PHONE, phone_ok)]


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a check has passed); spans whose check fails are dropped."""
    for start, end in emails(text):
        yield "email", start, end, False
    if "PRIVATE KEY" in text:
        for start, end in private_keys(text):
            yield "private_key", start, end, False
    for start, end, ok in secrets(text):
        yield "secret", start, end, ok
    if not DIGIT.search(text):
        return
    if ":" in text:
        for match in IP6.finditer(text):
            if ip6_ok(match.group()):
                yield "ip6", match.start(), match.end(), True
    for kind, pattern, check in PATTERNS:
        if kind == "phone" and "+" not in text:
            continue
        for match in pattern.finditer(text):
            if check(match.group()):
                yield kind, match.start(), match.end(), kind == "card"
    for start, end in ibans(text):
        yield "iban", start, end, True
    for match in NATIONAL_ID.finditer(text):
        yield "national_id", match.start(), match.end(), False


def score(text: str, kind: str, start: int, end: int, checked: bool) -> float:
    around = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = {w.lower() for w in WORD.findall(around)}
    near, doubt = not CONTEXT[kind].isdisjoint(words), not DOUBTFUL.isdisjoint(words)
    return round(max(0.0, min(1.0, PROPOSED[kind] + CHECKED * checked + NEARBY * near - DOUBT * doubt)), 2)


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """All spans by start, then kind."""
    found = [(kind, a, b, score(text, kind, a, b, ok)) for kind, a, b, ok in proposals(text)]
    return sorted((x for x in found if x[0] in BASE_KINDS or x[3] >= THRESHOLD), key=lambda x: (x[1], ORDER[x[0]], x[2]))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [(t or b"").decode("utf-8", "replace") for t in batch.column(batch.num_columns - 1).to_pylist()]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    names = ("kind", "start", "end", "score")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        spans = pa.array([[dict(zip(names, s)) for s in spans_of(t)] for t in _texts(batch)], type=kind)
        yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    return map_arrow(rows, run, f"doc_id long, spans {SPANS}")


def masked(text: str) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for kind, start, end, _ in spans_of(text):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the personal data in the text masked. Null stays null."""
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [None if t is None else masked(t.decode("utf-8", "replace")) for t in batch.column(batch.num_columns - 1).to_pylist()]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        columns[place] = pa.array(texts, type=pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    rows = docs.select("*", as_bytes(text_col).alias(free_name(docs, "_text_bytes")))
    out = map_arrow(rows, run, docs.schema)
    if "n_chars" in docs.columns:
        kept = F.char_length(text_col).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(kept))
    return out


def joined(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns from the spans of :func:`find`."""
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(k) for k in KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(BASE_KINDS))
    return find(docs).select(
        "doc_id",
        *counts[: len(BASE_KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        *counts[len(BASE_KINDS) :],
        F.size(spans).cast("long").alias("n_spans"),
    )
