"""Personal data by anchor expansion.

One Aho-Corasick automaton reads each text once and stops at anchors: at-signs, schemes, a plus before a digit, two
digits that a number could hold next to each other, and words that announce an account. From an anchor a parser of its
kind walks outwards to the boundaries of the email, address or account, and checks what it holds: octets,
check digits, numbers of digits. What a parser has read ends the room of the next one of its kind, so spans of a
kind never overlap and equal the leftmost matches of its grammar, whether or not they pass the check.

Defined cases: a null text is empty and has no spans; very long texts are read in stretches that overlap by the longest anchor,
and every parser works in time that its own span bounds; touching finds of one kind stay apart; repeated rows are returned as
often as they came; other columns are ignored; an empty table gives an empty result. Positions are code points.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "tel", "iban", "account")
STRETCH = 1 << 22  # characters that the automaton reads at a time
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
OCTETS = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What follows an anchor of the kinds beside the base; group 1 is the span.
LOGIN, TEL, IBAN, ACCOUNT = r"://([A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%+!$&*-]+)@", r"tel:([0-9][0-9-]{5,18}[0-9])", r"IBAN[ :]{1,3}([A-Z]{2}[0-9]{2}[A-Z0-9]{11,})", r"(?:[Aa]ccount|ACCOUNT|[Aa]cct|ACCT)(?: (?:no|number))?[ .:#]{1,3}([0-9]{6,})"
AFTER = {"login": re.compile(LOGIN), "tel": re.compile(TEL), "iban": re.compile(IBAN), "account": re.compile(ACCOUNT)}
CUES = {"login": ["://"], "tel": ["tel:"], "iban": ["IBAN"], "account": ["account", "Account", "ACCOUNT", "acct", "Acct", "ACCT"]}


@lru_cache(1)
def automaton():
    import ahocorasick

    anchors: dict[str, str] = {"@": "email"}
    anchors |= {f"{a}.{b}": "ip" for a in DIGITS for b in DIGITS}
    anchors |= {f"{a}{between}{b}": "card" for a in DIGITS for between in ("", " ", "-") for b in DIGITS}
    anchors |= {f"+{a}": "phone" for a in DIGITS}
    anchors |= {cue: kind for kind, cues in CUES.items() for cue in cues}
    out = ahocorasick.Automaton()
    for anchor, kind in anchors.items():
        out.add_word(anchor, (len(anchor), kind))
    out.make_automaton()
    return out, max(map(len, anchors))


def back(text: str, end: int, least: int, letters: str) -> int:
    """Where the run of letters that ends at `end` begins, not before `least`."""
    at, size = end, 64
    while at > least:
        part = text[max(least, at - size) : at]
        kept = len(part.rstrip(letters))
        at -= len(part) - kept
        if kept:
            break
        size *= 2
    return at


def email(text: str, at: int, least: int):
    start = back(text, at, least, LOCAL)
    tail = DOMAIN.match(text, at + 1) if start < at else None
    return (start, tail.end(), True) if tail else None


def ip(text: str, at: int, least: int):
    if at < least:
        return None
    found = OCTETS.match(text, back(text, at, least, DIGITS))
    if not found:
        return None
    parts = [p.lstrip("0") for p in found[0].split(".")]
    return *found.span(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def luhn(digits: str) -> bool:
    """Whether the check digit fits: every second digit from the right is doubled, and sums of digits end in 0."""
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def card(text: str, at: int, least: int):
    found = NUMBER.match(text, at)
    digits = found[0].replace(" ", "").replace("-", "") if found.end() - at <= 37 else ""  # 19 digits and what is between
    return *found.span(), 13 <= len(digits) <= 19 and luhn(digits)


def phone(text: str, at: int, least: int):
    found = PHONE.match(text, at)
    return (*found.span(), 9 <= sum(c in DIGITS for c in found[0]) <= 15) if found else None


def after(kind: str):
    def parse(text: str, at: int, least: int):
        found = AFTER[kind].match(text, at)
        if not found:
            return None
        own = found[1]
        ok = {"iban": lambda: len(own) <= 34 and int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1, "account": lambda: len(own) <= 17}.get(kind, lambda: True)()
        return *found.span(1), ok

    return parse


PARSERS = {"email": email, "ip": ip, "card": card, "phone": phone} | {kind: after(kind) for kind in AFTER}


def anchors(text: str):
    """(place, kind) of all anchors, in order inside a kind."""
    found, longest = automaton()
    for lo in range(0, len(text), STRETCH):
        for end, (size, kind) in found.iter(text[lo : lo + STRETCH + longest - 1]):
            at = end - size + 1
            if at < STRETCH:
                yield lo + at, kind


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all finds, by kind as listed and place."""
    out = {kind: [] for kind in KINDS}
    least = dict.fromkeys(KINDS, 0)
    for at, kind in anchors(text):
        if at >= least[kind] and (found := PARSERS[kind](text, at, least[kind])):
            start, least[kind], ok = found
            if ok:
                out[kind].append((kind, start, least[kind]))
    return [s for own in out.values() for s in own]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): personal data of every text, as structs (kind, start, end)."""
    small_batches(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def written(found) -> F.Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Digest rows of all documents."""
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    return find(docs).select("doc_id", *(count(k) for k in BASE), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, all columns as before, with the kind in brackets in place of every span; overlapping spans share the first one's.

    A null text stays null.
    """
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            out = []
            for value in batch.column(at):
                text = value.as_py()
                if text is not None:
                    parts, last = [], 0
                    for kind, start, end in sorted(spans(text), key=lambda s: (s[1], -s[2])):
                        if start >= last:
                            parts += [text[last:start], f"[{kind}]"]
                        last = max(last, end)
                    text = "".join(parts) + text[last:]
                out.append(text)
            yield batch.set_column(at, text_col, pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)
