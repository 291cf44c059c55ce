"""Personal data: anchor expansion.

Method.  One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, digits, ``://`` and identifier
cues (``iban``, ``account`` ...).  A small deterministic parser per kind expands from the anchor to the span's
boundaries and validates it.  A kind's spans do not overlap: an anchor inside the span parsed last (valid or not) is
skipped, which is what leftmost non-overlapping matching does, because every parser starts at the leftmost character
its pattern could start with.

Kinds.  Base: email, ip (parts at most 255), card (16 to 19 digits passing Luhn), phone (8 to 15 digits).  Added:
account (an identifier cue followed by an account number, or an IBAN passing mod 97) and url (scheme and rest).

Defined results.  A null or empty text has no spans.  Offsets are code points, end exclusive.  Repeated rows get
equal results.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from scorewright.llm.common import by_value, map_texts

by_value(__name__)

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "url")
CUES = ("iban", "account", "acct", "ssn", "passport")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = re.compile(r"(?:https?|ftp)\Z", re.I)
_URL_REST = re.compile(r"://[^\s<>\"'()\[\]{}|\\^`]*[^\s<>\"'()\[\]{}|\\^`.,;:!?]")
_CUE_REST = re.compile(r"(?:[\x20_-]?(?:number|no|nr|id))?\.?[\x20]?[:#=]?[\x20]?")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}")
_ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,16}(?![0-9A-Za-z])")
_LOCAL_MAX = 64     # characters looked back at first for the start of an email; doubled until it is found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            a.add_word(form, ("cue", len(form)))
    a.make_automaton()
    return a


def left_of(text: str, at: int, floor: int, pattern) -> int:
    """Start of the longest run of ``pattern`` that ends before ``at`` and starts at ``floor`` or later.

    Matches the reversed text, a piece at a time and each only once, so the time is linear in the run.
    """
    end, back = at, _LOCAL_MAX
    while end > floor:
        low = max(floor, end - back)
        run = pattern.match(text[low:end][::-1]).end()
        if run < end - low:
            return end - run
        end, back = low, back * 2
    return end


def ip_part(digits: str) -> bool:
    """Whether a part of an address, with leading zeros or not, is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) < 3 or len(digits) == 3 and digits <= "255"


def spans(text: str, ac) -> dict[str, list[tuple[int, int]]]:
    """All spans of one text by kind, each list in order of start."""
    out = {k: [] for k in BASE_KINDS + ADDED_KINDS}
    end = dict.fromkeys(out, 0)
    for last, (what, size) in ac.iter(text):
        at = last - size + 1
        if what == "digit":
            if at and "0" <= text[at - 1] <= "9":
                continue
            if at >= end["ip"] and (m := _IP.match(text, at)):
                end["ip"] = m.end()
                if all(map(ip_part, m[0].split("."))):
                    out["ip"].append(m.span())
            if at >= end["card"] and (m := _CARD.match(text, at)):
                end["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        elif what == "at":
            m = _DOMAIN.match(text, at + 1)
            if m and (start := left_of(text, at, end["email"], _LOCAL)) < at:
                out["email"].append((start, m.end()))
                end["email"] = m.end()
        elif what == "plus":
            if at >= end["phone"] and (m := _PHONE.match(text, at)):
                end["phone"] = m.end()
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out["phone"].append(m.span())
        elif what == "scheme":
            m = _SCHEME.search(text, max(end["url"], at - 5), at)
            rest = m and _URL_REST.match(text, at)
            if rest:
                out["url"].append((m.start(), rest.end()))
                end["url"] = rest.end()
        elif at >= end["account"]:
            if at and (text[at - 1].isalnum() or text[at - 1] == "_"):
                continue
            start = _CUE_REST.match(text, last + 1).end()
            m = _IBAN.match(text, start)
            while m and not iban_ok(m[0]):
                m = _IBAN.match(text, start, m.end() - 1)
            m = m or _ACCOUNT.match(text, start)
            if m:
                out["account"].append(m.span())
                end["account"] = m.end()
    return out


def listed(found: dict, kinds) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in found[k])


def find(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_<kind> of every kind, base_sha256, spans (kind:start:end lists)."""
    kinds = BASE_KINDS + ADDED_KINDS

    def run(texts):
        ac = automaton()
        cols = {f"n_{k}": [] for k in kinds} | {"base_sha256": [], "spans": []}
        for t in texts:
            found = spans(t, ac)
            for k in kinds:
                cols[f"n_{k}"].append(len(found[k]))
            cols["base_sha256"].append(hashlib.sha256(listed(found, BASE_KINDS).encode()).hexdigest())
            cols["spans"].append(listed(found, kinds))
        return cols

    ddl = ", ".join(f"n_{k} long" for k in kinds)
    return map_texts(docs, run, f"{ddl}, base_sha256 string, spans string")
