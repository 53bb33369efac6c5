"""Personal data by anchors: an Aho-Corasick pass finds signs and cues, local parsers expand and validate."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, select_texts

KINDS = ("email", "ip", "card", "phone", "url", "iban", "account")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
#: Words that announce an identifier; what follows must hold as many digits.
CUES = {"ssn": 9, "passport": 6, "account": 6, "acct": 6, "konto": 6, "cuenta": 6, "compte": 6}
#: Length of an IBAN by country.
IBAN_LENGTHS = {
    c: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in codes.split()
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def iban_end(text: str, begin: int, end: int) -> int | None:
    """Where the IBAN ends that begins a match: after its country's length; for other countries at the longest end that
    passes the check."""
    ends = [i + 1 for i in range(begin, end) if text[i] != " "]
    size = IBAN_LENGTHS.get(text[begin : begin + 2])
    sizes = [size] if size else range(len(ends), 14, -1)
    return next((ends[n - 1] for n in sizes if n <= len(ends) and iban_ok(text[begin : ends[n - 1]])), None)


class Finder:
    """One pass over a text's anchors. Each kind keeps the end of its last match, so matches do not overlap; a match
    that fails its check is used up all the same."""

    def __init__(self):
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for sign in ("@", "+", "://", *DIGITS):
            self.anchors.add_word(sign, ("digit" if sign in DIGITS else sign, len(sign)))
        for cue in ("iban", *CUES):
            for form in (cue, cue.upper(), cue.capitalize()):
                self.anchors.add_word(form, (cue, len(form)))
        self.anchors.make_automaton()
        self.domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
        self.ip = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
        self.card = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
        self.phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
        self.userinfo = re.compile(r"://[^\s/@:]+:[^\s/@]+@[^\s/@]+")
        self.scheme = re.compile(r"[A-Za-z0-9+.-]")
        self.iban = re.compile(r"[\s:#=-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
        self.number = re.compile(r"(?:\s?(?:no|nr|number|num)\b\.?)?[\s:#=.-]{1,4}((?:[A-Z]{0,3}[0-9][0-9-]*[0-9]))", re.I | re.A)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out = []
        end = dict.fromkeys(KINDS, 0)
        for last, (kind, size) in self.anchors.iter(text):
            at = last - size + 1
            if kind == "digit":
                if at and text[at - 1] in DIGITS:
                    continue
                if at >= end["ip"] and (m := self.ip.match(text, at)):
                    end["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                        out.append(("ip", at, m.end()))
                if at >= end["card"] and (m := self.card.match(text, at)):
                    end["card"] = m.end()
                    if m.end() - at <= 40:
                        digits = m[0].replace(" ", "").replace("-", "")
                        if 16 <= len(digits) <= 19 and luhn(digits):
                            out.append(("card", at, m.end()))
            elif kind == "@":
                begin = at
                while begin > end["email"] and text[begin - 1] in LOCAL:
                    begin -= 1
                if begin < at and (m := self.domain.match(text, at)):
                    end["email"] = m.end()
                    out.append(("email", begin, m.end()))
            elif kind == "+":
                if at >= end["phone"] and (m := self.phone.match(text, at)):
                    end["phone"] = m.end()
                    if 8 <= sum(c in DIGITS for c in m[0]) <= 15:
                        out.append(("phone", at, m.end()))
            elif kind == "://":
                if at >= end["url"] and (m := self.userinfo.match(text, at)):
                    begin = at
                    while begin > end["url"] and self.scheme.match(text[begin - 1]):
                        begin -= 1
                    end["url"] = m.end()
                    if begin < at:
                        out.append(("url", begin, m.end()))
            elif kind == "iban":
                m = self.iban.match(text, last + 1)
                if m and m.start(1) >= end["iban"] and (stop := iban_end(text, *m.span(1))):
                    end["iban"] = stop
                    out.append(("iban", m.start(1), stop))
            elif not (at and text[at - 1].isalnum()):
                m = self.number.match(text, last + 1)
                if m and m.start(1) >= end["account"] and sum(c in DIGITS for c in m[1]) >= CUES[kind]:
                    end["account"] = m.end(1)
                    out.append(("account", m.start(1), m.end(1)))
        return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def _scan(batches):
    finder = Finder()
    names = [f"n_{k}" for k in KINDS[:4]]
    for batch in chunks(batches):
        rows = {k: [] for k in (*names, "base_sha256", "spans", "found")}
        for text in batch["text"].to_pylist():
            spans = finder.spans(text)
            for name, kind in zip(names, KINDS, strict=False):
                rows[name].append(sum(k == kind for k, _, _ in spans))
            base = joined([s for s in spans if s[0] in KINDS[:4]])
            rows["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            rows["spans"].append(joined(spans))
            rows["found"].append([text[s:e] for _, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1]))])
        kinds = {"base_sha256": pa.string(), "spans": pa.string(), "found": pa.list_(pa.string())}
        yield pa.RecordBatch.from_arrays([batch["id"], *[pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]], names=["id", *rows])


def personal_data(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Personal data of every text: e-mail, IP, card, phone by the stated patterns; further user names in URLs, IBANs
    and numbers after identifier cues.

    Anchors are the at-sign, the plus sign, `://`, digits and cue words. From an anchor a parser for its kind expands to
    the left and right as the stated pattern would, from left to right without overlap, and checks parts, Luhn sums,
    digit counts or IBAN remainders; an IBAN ends at its country's length, so capitals and digits may follow it. One row
    per input row: id, counts of the four stated kinds, base_sha256, spans (code points, by kind, then start), found (the
    texts). A null text is empty. Repeated rows give repeated rows. Other
    columns are not read. A narrow pass: no shuffle.
    """
    src = select_texts(df, id_col, text_col)
    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, found array<string>"
    return src.mapInArrow(_scan, schema).withColumnRenamed("id", id_col)
