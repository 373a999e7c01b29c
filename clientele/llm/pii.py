"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds its anchors: at-signs (plain and written around),
schemes (``://``, ``tel:``), and identifier cues (a digit before a dot, digits side by side, a
plus before a digit, ``::``, words such as ``account``). Every anchor is handed to a local
parser, which expands it to the left and right as far as the kind's characters go, then
validates what it found. Nothing away from an anchor is looked at.

Base kinds, leftmost and non-overlapping per kind, a failing candidate used up and dropped:
* ``email``: local part, at-sign, a domain of two labels or more;
* ``ip``: four numbers joined by dots, each at most 255;
* ``card``: 12 to 19 digits, single spaces or hyphens between them, Luhn's sum divisible by 10;
* ``phone``: plus and 9 to 15 digits with spaces, dots, hyphens and brackets between them.

Further findings (``base`` false), by the anchors that the base forms do not have:
* ``email`` with ``(at)``, ``[at]``, ``%40``, ``&#64;`` or a full-width at-sign, and a domain
  whose dots may be written ``(dot)`` or ``[dot]``;
* ``ip``: addresses of version 6 with three written groups or more;
* ``phone`` behind ``tel:``, without the plus;
* ``account``: bank account numbers with a right checksum (modulo 97), and identifiers of 6 to
  20 letters and digits, 6 digits at least, behind a cue word;
* ``login``: user and password before the host of a URL.
A further finding equal in kind to a base one and inside it is left out.

Scale. Rows are scanned where they are read: no shuffle, memory of one block of texts. Every
parser reads each character a bounded number of times, so the time is linear in the text.

Defined results. Null text: empty, no finding. Very long texts: scanned whole. Repeated rows:
one result each. Empty table: empty result. Extra columns: ignored.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.workers import tidy

# Kinds in their order; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "account", "login")
MAX_PART = 255
CARD_DIGITS = (12, 19)
PHONE_DIGITS = (9, 15)
IBAN_LENGTH = (15, 34)
AT_SIGNS = ("%40", "&#64;", "\uff20", "(at)", "[at]", "{at}")
CUES = ("account", "acct", "iban", "konto", "compte", "cuenta", "passport", "ssn")

_DIGITS = "0123456789"
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_SPELT_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[{]dot[)\]}]\x20?)[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]++")
_TEL = re.compile(r"\x20?[(0-9][\x20().0-9-]*[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IDENTIFIER = re.compile(r"(?i:\x20?(?:no|nr|num|number|id)\b\.?)?[\x20:#=]{1,3}([A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)(?![A-Za-z0-9])")
_LOGIN = re.compile(r"[^\s/?#@:]{1,256}(?::[^\s/?#@]{0,256})?(?=@[A-Za-z0-9\[])")
_COLON_RUN = frozenset("0123456789abcdefABCDEF:.")

Found = list[tuple[int, int, int, bool]]  # start, kind, end, base


def _anchors() -> ahocorasick.Automaton:
    """Anchor -> name of its parser. Texts are lower-cased (A-Z) before they are searched."""
    found = ahocorasick.Automaton()
    spelt = {"@": "at", "://": "scheme", "tel:": "tel", "::": "colons"}
    spelt |= {sign: "spelt at" for sign in AT_SIGNS} | {cue: "cue" for cue in CUES}
    spelt |= {f"{d}.": "dotted" for d in _DIGITS} | {f"+{d}": "plus" for d in _DIGITS}
    spelt |= {f"{a}{gap}{b}": "digits" for a in _DIGITS for gap in ("", " ", "-") for b in _DIGITS}
    spelt |= {f":{h}": "colons" for h in "0123456789abcdef"}
    for anchor, parser in spelt.items():
        found.add_word(anchor, (len(anchor), parser))
    found.make_automaton()
    return found


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes_mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _left(text: str, at: int, lowest: int, allowed: frozenset) -> int:
    while at > lowest and text[at - 1] in allowed:
        at -= 1
    return at


class Scan:
    """The parsers of one text; ``used`` is where the last candidate of each kind ended."""

    def __init__(self, text: str):
        self.text = text
        self.found: Found = []
        self.used = dict.fromkeys(("email", "ip", "card", "colons", "spelt", "account"), 0)

    def add(self, kind: str, start: int, end: int, base: bool) -> None:
        self.found.append((start, KINDS.index(kind), end, base))

    def at(self, lo: int, hi: int) -> None:
        start = _left(self.text, lo, self.used["email"], _LOCAL)
        domain = _DOMAIN.match(self.text, hi) if start < lo else None
        if domain:
            self.add("email", start, domain.end(), True)
            self.used["email"] = domain.end()

    def spelt_at(self, lo: int, hi: int) -> None:
        text, end = self.text, lo
        if end > 0 and text[end - 1] == " " and text[lo] in "([{":
            end -= 1
        start = _left(text, end, max(self.used["spelt"], end - 64), _LOCAL)
        domain = _SPELT_DOMAIN.match(text, hi + (text[hi:hi + 1] == " " and text[lo] in "([{"))
        if start < end and domain:
            self.add("email", start, domain.end(), False)
            self.used["spelt"] = domain.end()

    def dotted(self, lo: int, hi: int) -> None:
        if lo < self.used["ip"]:
            return
        numbers = _DOTTED.match(self.text, _left(self.text, lo, self.used["ip"], frozenset(_DIGITS)))
        if numbers:
            self.used["ip"] = numbers.end()
            parts = [p.lstrip("0") for p in numbers.groups()]
            if all(len(p) <= 3 and int(p or "0") <= MAX_PART for p in parts):
                self.add("ip", *numbers.span(), True)

    def digits(self, lo: int, hi: int) -> None:
        if lo < self.used["card"]:
            return
        number = _CARD.match(self.text, lo)
        self.used["card"] = number.end()
        digits = _digits(number.group())
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and passes_luhn(digits):
            self.add("card", *number.span(), True)
        if lo >= 2:
            self.iban(lo - 2)

    def iban(self, lo: int) -> None:
        if lo < self.used["account"] or (lo > 0 and self.text[lo - 1].isalnum()):
            return
        account = _IBAN.match(self.text, lo)
        if account:
            plain = account.group().replace(" ", "")
            if IBAN_LENGTH[0] <= len(plain) <= IBAN_LENGTH[1] and passes_mod97(plain):
                self.add("account", *account.span(), False)
                self.used["account"] = account.end()

    def plus(self, lo: int, hi: int) -> None:
        number = _PHONE.match(self.text, lo)
        if number is None:
            return
        whole = number.group().rstrip(" ().-")
        if len(whole) >= 4 and PHONE_DIGITS[0] <= len(_digits(whole)) <= PHONE_DIGITS[1]:
            self.add("phone", lo, lo + len(whole), True)

    def tel(self, lo: int, hi: int) -> None:
        inside_word = lo > 0 and self.text[lo - 1].isalnum()
        number = None if inside_word else _TEL.match(self.text, hi)
        if number and PHONE_DIGITS[0] <= len(_digits(number.group())) <= PHONE_DIGITS[1]:
            self.add("phone", number.start() + (number.group()[0] == " "), number.end(), False)

    def colons(self, lo: int, hi: int) -> None:
        if lo < self.used["colons"]:
            return
        text = self.text
        start = _left(text, lo, max(self.used["colons"], lo - 4), _COLON_RUN)
        end = lo
        while end < len(text) and text[end] in _COLON_RUN:
            end += 1
        self.used["colons"] = end
        outside = any(c.isalnum() for c in (text[start - 1:start], text[end:end + 1]) if c)
        run = text[start:end].rstrip(".")
        run = run[:-1] if run.endswith(":") and not run.endswith("::") else run
        if outside or run.count(":") < 2 or len(run) > 45:
            return
        try:
            ipaddress.IPv6Address(run)
        except ValueError:
            return
        if sum(map(bool, run.split(":"))) >= 3:
            self.add("ip", start, start + len(run), False)

    def cue(self, lo: int, hi: int) -> None:
        if lo < self.used["account"] or (lo > 0 and self.text[lo - 1].isalnum()):
            return
        number = _IDENTIFIER.match(self.text, hi)
        if number:
            name = number.group(1).replace("-", "")
            if 6 <= len(name) <= 20 and len(_digits(name)) >= 6:
                self.add("account", *number.span(1), False)
                self.used["account"] = number.end()

    def scheme(self, lo: int, hi: int) -> None:
        login = _LOGIN.match(self.text, hi)
        if login and lo > 0 and self.text[lo - 1].isalnum():
            self.add("login", *login.span(), False)


_PARSERS: dict[str, Callable] = {
    "at": Scan.at, "spelt at": Scan.spelt_at, "dotted": Scan.dotted, "digits": Scan.digits,
    "plus": Scan.plus, "tel": Scan.tel, "colons": Scan.colons, "cue": Scan.cue, "scheme": Scan.scheme}


def personal_data(text: str, anchors: ahocorasick.Automaton) -> list[dict]:
    """All findings of a text by start, then kind."""
    scan = Scan(text)
    for last, (length, parser) in anchors.iter(text.encode("utf-8").lower().decode("utf-8")):
        _PARSERS[parser](scan, last + 1 - length, last + 1)
    inside_of: dict[int, int] = {}  # kind -> furthest end of its base findings so far
    seen, out = set(), []
    for start, kind, end, base in sorted(scan.found, key=lambda f: (f[0], f[1], not f[3], f[2])):
        if base:
            inside_of[kind] = end
        elif end <= inside_of.get(kind, 0) or (start, kind, end) in seen:
            continue
        seen.add((start, kind, end))
        out.append({"kind": KINDS[kind], "start": start, "end": end, "base": base,
                    "found": text[start:end]})
    return out


FINDINGS = "array<struct<kind:string,start:long,end:long,base:boolean,found:string>>"
_FINDING = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                      ("base", pa.bool_()), ("found", pa.string())])
BLOCK_ROWS = 512


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = _anchors()
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(lo, BLOCK_ROWS)
            found = [personal_data(text.as_py(), anchors) for text in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(_FINDING))],
                                             names=["doc_id", "findings"])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and findings (kind, start, end in code points, base, found)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInArrow(tidy(_scan_batches), f"doc_id long, findings {FINDINGS}")
    return found.withColumnRenamed("doc_id", id_col)
