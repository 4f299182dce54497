"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in whole texts: at-signs, scheme marks,
a plus or a dot before a digit, two digits that belong together, and cue words
of accounts. A local parser per kind expands an anchor to the left and right,
never over the end of the last match of its kind, and validates what it has.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import give_back, small_batches

# The kinds in the order of the result, first those of the contract, then those the method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
# Words before an account number.
CUES = ("IBAN", "Account", "Konto", "Kontonummer", "Cuenta", "Compte")

_SLICE = 1 << 20
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_WORD = _LOCAL - set(".%+-")
# What a parser reads from its anchor on.
DOMAIN = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
NUMBERS = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ADDRESS = rf"://{DOMAIN}(?::[0-9]+)?(?:[/?#](?:[A-Za-z0-9._~%!$&'()*+,;=:@/?#-]*[A-Za-z0-9_~%=&/#+-])?)?"
IBAN = r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"
ACCOUNT = rf"[\x20:#.=-]{{1,4}}({IBAN}|[0-9](?:[\x20-]?[0-9]){{5,19}})"


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def _iban(text: str) -> bool:
    packed = text.replace(" ", "")
    rest = 0
    for c in packed[4:] + packed[:4]:
        rest = (rest * (10 if c in _DIGITS else 100) + int(c, 36)) % 97
    return rest == 1


class Finder:
    """The automaton and the parsers; made once per task."""

    def __init__(self):
        anchors = {"@": "email", "://": "url"}
        for d in "0123456789":
            anchors["+" + d] = "phone"
            anchors["." + d] = "ip"
            for e in "0123456789":
                anchors |= {d + e: "card", f"{d} {e}": "card", f"{d}-{e}": "card"}
        for cue in CUES:
            anchors |= {c: "account" for c in (cue, cue.lower(), cue.upper())}
        self.automaton = ahocorasick.Automaton()
        for anchor, kind in anchors.items():
            self.automaton.add_word(anchor, (len(anchor), kind))
        self.automaton.make_automaton()
        self.overlap = max(map(len, anchors)) - 1
        self.parsers = {"email": self._email, "ip": self._ip, "card": self._card, "phone": self._phone, "url": self._url, "account": self._account}
        self.domain, self.numbers, self.card = re.compile(DOMAIN), re.compile(NUMBERS), re.compile(CARD)
        self.phone, self.address, self.account = re.compile(PHONE), re.compile(ADDRESS), re.compile(ACCOUNT)

    def _anchors(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(start, stop, kind) of every anchor, by stop; a long text is read slice by slice."""
        for at in range(0, len(text), _SLICE):
            since = max(0, at - self.overlap)
            part = text if len(text) <= _SLICE else text[since : at + _SLICE]
            for last, (size, kind) in self.automaton.iter(part):
                stop = since + last + 1
                if stop > at:
                    yield stop - size, stop, kind

    # A parser gives (start, end, valid) or None. No match starts before ``floor``, the end of the one before.

    def _email(self, text: str, at: int, stop: int, floor: int) -> tuple[int, int, bool] | None:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = self.domain.match(text, stop) if start < at else None
        return (start, found.end(), True) if found else None

    def _ip(self, text: str, at: int, stop: int, floor: int) -> tuple[int, int, bool] | None:
        start = at
        while start > floor and text[start - 1] in _DIGITS:
            start -= 1
        found = self.numbers.match(text, start) if start < at else None
        return (start, found.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found[0].split("."))) if found else None

    def _card(self, text: str, at: int, stop: int, floor: int) -> tuple[int, int, bool] | None:
        found = self.card.match(text, at) if at >= floor else None
        if not found:
            return None
        digits = found[0].replace(" ", "").replace("-", "")
        return at, found.end(), 16 <= len(digits) <= 19 and luhn(digits)

    def _phone(self, text: str, at: int, stop: int, floor: int) -> tuple[int, int, bool] | None:
        found = self.phone.match(text, at) if at >= floor else None
        return (at, found.end(), 8 <= sum(c in _DIGITS for c in found[0]) <= 15) if found else None

    def _url(self, text: str, at: int, stop: int, floor: int) -> tuple[int, int, bool] | None:
        scheme = next((s for s in ("https", "http", "ftp") if text[max(0, at - len(s)) : at].lower() == s), None)
        start = at - len(scheme or "")
        if not scheme or start < floor or start and text[start - 1] in _WORD:
            return None
        found = self.address.match(text, at)
        return (start, found.end(), True) if found else None

    def _account(self, text: str, at: int, stop: int, floor: int) -> tuple[int, int, bool] | None:
        if at < floor or at and text[at - 1] in _WORD:
            return None
        found = self.account.match(text, stop)
        if not found:
            return None
        whole = found.end() == len(text) or text[found.end()] not in _WORD
        return found.start(1), found.end(), whole and (found[1][0] in _DIGITS or _iban(found[1]))

    def spans(self, text: str | None) -> dict[str, list[tuple[int, int]]]:
        """Spans of each kind, in code points, the end exclusive."""
        text, floors = text or "", dict.fromkeys(KINDS, 0)
        found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        for at, stop, kind in self._anchors(text):
            match = self.parsers[kind](text, at, stop, floors[kind])
            if match:
                floors[kind] = match[1]
                if match[2]:
                    found[kind].append(match[:2])
        return found


def listed(found: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind in kinds for start, end in found[kind])


def find(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` (array of kind, start, end) and ``digest`` of the base kinds' spans of every row.

    Whole texts are searched where they are; nothing is shuffled. A NULL or
    empty text has no span. Repeated rows are answered each. Other columns are
    ignored. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder()
        shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans, digests = [], []
            for value in batch.column(1):
                found = finder.spans(value.as_py())
                spans.append([{"kind": k, "start": a, "end": b} for k in KINDS for a, b in found[k]])
                digests.append(hashlib.sha256(listed(found, BASE).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, shape), pa.array(digests)], ["doc_id", "spans", "digest"])
        give_back()

    rows = docs.select(F.col(id).cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(each, "doc_id long, spans array<struct<kind:string,start:long,end:long>>, digest string")
