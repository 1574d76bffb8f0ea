"""Personal data by anchor expansion.

One Aho-Corasick automaton finds at-signs, URL schemes, plus signs, digits and
identifier cues (in English, German, Spanish and French) in one pass over a text.
At each anchor a deterministic local parser grows the span to both sides and
validates its boundaries. Anchors inside what a parser of their kind has taken are
skipped, and a scheme waits for the next at-sign instead of looking for it, so the
work is linear in the text, also on very long runs.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of
their patterns, kept if valid. The method adds:

* ``url``: a URL with a user part, or a ``mailto:`` address, from the scheme
  nearest to the at-sign on; they do not overlap;
* ``account``: the value after a cue such as ``account:`` or ``iban:``; an IBAN
  must pass its check sum, other values need a digit;
* ``secret``: the value after a cue such as ``password=`` or ``token =``, and
  access key ids of fixed shape.

Offsets are code points, ends are exclusive. Defined cases: null text counts as
empty (no spans, empty strings); repeated rows give repeated results; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, read_table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")

ACCOUNT_CUES = (
    "account", "acct", "iban", "passport", "ssn", "userid", "user_id", "username", "login",
    "konto", "kontonummer", "kontonr", "reisepass", "ausweisnummer", "sozialversicherungsnummer", "steuernummer", "benutzername", "kundennummer",
    "cuenta", "pasaporte", "usuario", "dni", "compte", "passeport", "utilisateur", "identifiant",
)
SECRET_CUES = (
    "password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access_key",
    "passwort", "kennwort", "geheimnis", "schlüssel", "contraseña", "clave", "secreto", "mot de passe", "clé",
)
KEY_ID = "AKIA"
ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
DIGITS = frozenset("0123456789")
LOCAL = ALNUM | frozenset("._%+-")

_domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_address = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_digits = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_user = re.compile(r"[^\s/@\"'<>()]+")
_host = re.compile(r"[A-Za-z0-9.-]+[^\s\"'<>()]*")
_value = re.compile(r"[ \t]*[:=#][ \t]*[\"']?([A-Za-z0-9+/_.@-]{6,})")
_iban = re.compile(r"[ \t]*[:=#]?[ \t]*([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)(?![A-Za-z0-9])")
_key_id = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def anchors():
    """The automaton; each anchor with its kind and length."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    words = {"@": "at", "://": "scheme", "mailto:": "mailto", "+": "plus", KEY_ID: "key"} | {str(d): "digit" for d in range(10)}
    for cues, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
        for cue in cues:
            words |= {cue: kind, cue.capitalize(): kind, cue.upper(): kind}
    for word, kind in words.items():
        auto.add_word(word, (kind, len(word)))
    auto.make_automaton()
    return auto


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    value = value.replace(" ", "")
    if not 15 <= len(value) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The e-mail address around the at-sign at ``at``; it starts at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    domain = _domain.match(text, at + 1)
    return (start, domain.end()) if domain else None


def ip_valid(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in value.split("."))


def card_valid(value: str) -> bool:
    digits = value.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits)


def phone_valid(value: str) -> bool:
    return 9 <= sum(c.isdigit() for c in value) <= 15


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind as in KINDS, then by start."""
    spans: list[Span] = []
    # Up to where each kind has taken the text; a match that is not valid has taken it too.
    taken = dict.fromkeys(KINDS, 0)
    scheme: tuple[int, int] | None = None
    run_end = 0
    for last, (kind, length) in anchors().iter(text):
        start, end = last - length + 1, last + 1
        if kind == "digit":
            if start < run_end:
                continue
            # The first digit of a run.
            run_end = end
            while run_end < len(text) and text[run_end] in DIGITS:
                run_end += 1
            if start >= taken["ip"] and run_end < len(text) and text[run_end] == "." and (m := _address.match(text, start)):
                taken["ip"] = m.end()
                if ip_valid(m.group()):
                    spans.append(("ip", *m.span()))
            if start >= taken["card"] and (m := _digits.match(text, start)):
                taken["card"] = m.end()
                if m.end() - start >= 13 and card_valid(m.group()):
                    spans.append(("card", *m.span()))
        elif kind == "plus":
            if start >= taken["phone"] and (m := _phone.match(text, start)):
                taken["phone"] = m.end()
                if phone_valid(m.group()):
                    spans.append(("phone", *m.span()))
        elif kind == "at":
            if start >= taken["email"] and (found := email_at(text, start, taken["email"])):
                spans.append(("email", *found))
                taken["email"] = found[1]
            if scheme is not None:
                (left, user), scheme = scheme, None
                if left >= taken["url"] and _user.fullmatch(text, user, start) and (m := _host.match(text, end)):
                    spans.append(("url", left, m.end()))
                    taken["url"] = m.end()
        elif kind == "scheme":
            left = start
            while left and text[left - 1] in ALNUM and start - left < 12:
                left -= 1
            scheme = (left, end) if left < start else None
        elif kind == "mailto":
            scheme = (start, end)
        elif kind == "key":
            if (not start or text[start - 1] not in ALNUM) and (m := _key_id.match(text, start)):
                spans.append(("secret", *m.span()))
        elif not start or text[start - 1] not in ALNUM:
            if text[start:end].lower() == "iban":
                if (m := _iban.match(text, end)) and iban_valid(m.group(1)):
                    spans.append(("account", *m.span(1)))
            elif (m := _value.match(text, end)) and any(c in DIGITS for c in m.group(1)):
                spans.append((kind, *m.span(1)))
    return sorted(set(spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def mask_text(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``[KIND]``."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of base kinds, the digest of base spans, and all spans."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = find_spans(text)
                base = [s for s in spans if s[0] in BASE_KINDS]
                kinds = [s[0] for s in base]
                rows.append((*(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object))
            yield out

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(F.col(text_col)).alias("text"))
    return source.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with the spans of ``text_col`` masked; null stays null."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else mask_text(t, find_spans(t)))

    return docs.withColumn(text_col, masked(F.col(text_col)))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(read_table(spark, sf_dir, "documents"))
