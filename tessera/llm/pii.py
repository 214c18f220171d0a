"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Kinds in listed order: email, ip, card (Luhn), phone, iban (mod-97). The first
four follow fixed patterns and are always reported once their check holds; an
iban is the method's addition and needs its checksum. Each span starts from its
kind's prior, gains if a word of its kind stands within CONTEXT characters, and
loses if a word that speaks against it does; ``score`` is in 0..1.

Nulls count as empty texts, which have no spans. Spans of different kinds may
overlap; spans of one kind don't. Offsets are code points, ends exclusive.
Context words are whole words. Repeated rows are scanned row by row, texts whole
however long; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

KINDS = ("email", "ip", "card", "phone", "iban")
#: Characters on each side in which context words count.
CONTEXT = 48

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from within too, so only
# starts of runs are tried and no run is given back.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Characters of an iban by country.
LENGTHS = {c: n for n, cs in {15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC"}.items() for c in cs.split()}
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.6, "phone": 0.6, "iban": 0.8}


def near(words: str) -> re.Pattern:
    """Any of the words, with a plural's s at most, where no letter adjoins."""
    return re.compile(rf"(?<![^\W\d_])(?:{words})s?(?![^\W\d_])", re.I)


FOR = {
    "email": near("e-?mail|contact|address|write to|mail to"),
    "ip": near("ip|ipv4|host|server|login|client|address"),
    "card": near("card|visa|mastercard|amex|credit|payment|cvv|expiry|expires|expiration"),
    "phone": near("phone|telephone|tel|call|mobile|fax|cell"),
    "iban": near("iban|account|bank|transfer|bic|swift"),
}
AGAINST = {
    "email": near("noreply|no-reply"),
    "ip": near("version|release|section|chapter"),
    "card": near("isbn|order|invoice|tracking|serial|sha|hash"),
    "phone": near("isbn|serial|part no"),
    "iban": near("serial|part no|model"),
}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; walks from one @ to the next, since any match
    has its local part in the run of characters before one."""
    out, past, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        past = max(past, at)  # what stands before this @ belongs to no later local part
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            past = m.end()
        at = text.find("@", max(past, at + 1))
    return out


def ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping. A pattern may run into the words behind, so its
    ends at spaces are tried too: the one of the country's length first, then from
    the longest. What holds no iban is searched again behind its first letters."""
    out, m = [], IBAN.search(text)
    while m:
        ends = [m.end(), *(m.start() + k for k in range(len(m[0]) - 1, 0, -1) if m[0][k] == " ")]
        ends.sort(key=lambda b: len(text[m.start() : b].replace(" ", "")) != LENGTHS.get(m[0][:2]))
        end = next((b for b in ends if 15 <= len(x := text[m.start() : b].replace(" ", "")) <= 34 and mod97(x)), None)
        if end is not None:
            out.append((m.start(), end))
        m = IBAN.search(text, m.start() + 2 if end is None else end)
    return out


def propose(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of all confirmed spans, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x := g.lstrip("0")) <= 3 and int(x or 0) <= 255 for g in m.groups())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]
    out += [(a, 4, b) for a, b in ibans(text)]
    return sorted(out)


def score(text: str, start: int, kind: str, end: int) -> float:
    around = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    s = PRIOR[kind] + 0.2 * bool(FOR[kind].search(around)) - 0.3 * bool(AGAINST[kind].search(around))
    return round(min(1.0, max(0.0, s)), 2)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array of (kind, start, end, score)) of every row."""

    def work(rows):
        out = []
        for t in rows["text"]:
            t = t or ""
            out.append([{"kind": KINDS[k], "start": a, "end": b, "score": score(t, a, KINDS[k], b)} for a, k, b in propose(t)])
        return {"id": rows["id"], "spans": out}

    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    made = map_batches(picked, work, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return made.withColumnRenamed("id", id_col)


def joined(spans):
    """kind:start:end of an array of spans, comma-joined, as a Column."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def sha_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
