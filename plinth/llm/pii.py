"""Personal data by anchor expansion: an Aho-Corasick pass finds anchors, local parsers expand and validate them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import product

import ahocorasick
from pyspark.sql import DataFrame

from plinth.llm.arrow import map_rows

#: Kinds with a contract first, in its order; the others are the method's own.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "secret", "account")
#: Words that announce a secret or an account number.
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key")
ACCOUNT_CUES = ("iban", "account")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_REST = re.compile(r"[^\s\"'<>\\^`{|}]+")
_VALUE = re.compile(r"[\"']?\s{0,4}[=:]\s{0,4}[\"']?([A-Za-z0-9_./+=-]{8,})")
_IBAN = re.compile(r"\W{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def anchors() -> ahocorasick.Automaton:
    """Every text that can stand in a match's middle or at its start, with the kinds that it opens and its length."""
    found: dict[str, list[str]] = {"@": ["email"], "://": ["url"]}
    for a in "0123456789":
        found[f"+{a}"] = ["phone"]
    for a, b in product("0123456789", repeat=2):
        found[f"{a}.{b}"] = ["ip"]
        for between in ("", " ", "-"):
            found[f"{a}{between}{b}"] = ["card"]
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found[form] = [kind]
    automaton = ahocorasick.Automaton()
    for text, kinds in found.items():
        automaton.add_word(text, (kinds[0], len(text)))
    automaton.make_automaton()
    return automaton


# Each parser gets the text, the anchor's span and the end of the kind's last match; it gives the end of what it has
# consumed, or None, and the span found, or None.


def _email(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    left = start
    while left > last and text[left - 1] in _LOCAL:
        left -= 1
    found = _DOMAIN.match(text, end) if left < start else None
    return (found.end(), (left, found.end())) if found else (None, None)


def _ip(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    left = start
    while left > last and text[left - 1] in _DIGITS:
        left -= 1
    found = _IP.match(text, left)
    if not found:
        return None, None
    return found.end(), found.span() if all(map(_octet, found[0].split("."))) else None


def _card(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    found = _CARD.match(text, start)
    digits = found[0].replace(" ", "").replace("-", "")
    return found.end(), found.span() if 16 <= len(digits) <= 19 and luhn(digits) else None


def _phone(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    found = _PHONE.match(text, start)
    if not found:
        return None, None
    return found.end(), found.span() if 8 <= sum(c in _DIGITS for c in found[0]) <= 15 else None


def _url(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    left = start
    while left > last and text[left - 1] in _SCHEME:
        left -= 1
    while left < start and not text[left].isalpha():
        left += 1
    found = _REST.match(text, end) if left < start else None
    right = end + len(found[0].rstrip(".,;:!?)*")) if found else end
    return (right, (left, right)) if right > end and text[end].isalnum() else (None, None)


def _secret(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    found = _VALUE.match(text, end)
    return (found.end(1), found.span(1)) if found and any(c in _DIGITS for c in found[1]) else (None, None)


def _account(text: str, start: int, end: int, last: int) -> tuple[int | None, tuple[int, int] | None]:
    found = _IBAN.match(text, end)
    for right in range(found.end(1), found.start(1) + 14, -1) if found else ():
        number = text[found.start(1) : right].replace(" ", "")
        if text[right - 1] != " " and len(number) >= 15 and int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1:
            return right, (found.start(1), right)
    return None, None


_PARSERS: dict[str, Callable] = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "url": _url, "secret": _secret, "account": _account}


def spans(text: str, automaton: ahocorasick.Automaton) -> Iterator[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, each kind's from left to right without overlaps."""
    last = dict.fromkeys(KINDS, 0)
    for at, (kind, length) in automaton.iter(text):
        start = at - length + 1
        if start < last[kind]:
            continue
        consumed, span = _PARSERS[kind](text, start, at + 1, last[kind])
        if consumed is not None:
            last[kind] = consumed
        if span:
            yield kind, *span


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: `doc_id`, `n_email`, `n_ip`, `n_card`, `n_phone`, `base_sha256`, `spans`.

    `spans` holds kind:start:end of all spans, `base_sha256` the hash of those of the first four kinds, ordered by kind and start and joined by
    commas; no span gives an empty string. Offsets count code points. A kind's matches are the leftmost non-overlapping ones of
    its pattern; one that fails validation is consumed all the same. A null text counts as empty; ids and repeated rows
    pass through. Work is linear in the text and keeps one text at a time; nothing is shuffled.
    """

    def make() -> Callable[[list], list]:
        automaton, order = anchors(), {k: i for i, k in enumerate(KINDS)}

        def work(columns: list) -> list:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(*columns, strict=True):
                found = sorted(spans(text or "", automaton), key=lambda s: (order[s[0]], s[1]))
                names = [f"{k}:{a}:{b}" for k, a, b in found]
                n_base = sum(k in BASE_KINDS for k, _, _ in found)
                counts = [sum(k == kind for k, _, _ in found) for kind in BASE_KINDS]
                for column, value in zip(out, [doc_id, *counts, sha256(",".join(names[:n_base]).encode()).hexdigest(), ",".join(names)], strict=True):
                    column.append(value)
            return out

        return work

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
