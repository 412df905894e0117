"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and
identifier cues ("iban", "ssn", ...). At each anchor a local parser expands to the borders of
the e-mail address, network address, card, phone or account number there and validates it.
No parser looks at a text twice, so the work is linear in the text.

Cases: a null or empty text has no spans. Null ids and repeated rows stay, one result per
input row; an empty table gives an empty result; other columns of the input are ignored.
"""

import hashlib
import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from pagespine.llm.texts import over_texts

#: Kinds in the order of their spans; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "account", "iban", "login", "ssn")
BASE = 4

#: Cues that announce an identifier, and its kind.
CUES = {
    "account": "account", "acct": "account", "konto": "account", "compte": "account", "cuenta": "account",
    "iban": "iban", "ssn": "ssn", "social security": "ssn",
}

SPANS = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._%+-]+:[^\s/@:]+(?=@[A-Za-z0-9])")
_AFTER_CUE = r"(?:\s?(?i:number|no|nr|num)\b\.?)?\s{0,2}[:#=]?\s{0,2}"
_ACCOUNT = re.compile(_AFTER_CUE + r"([0-9]{6,17})(?![A-Za-z0-9-])")
_IBAN = re.compile(_AFTER_CUE + r"([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_SSN = re.compile(_AFTER_CUE + r"((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])")


@lru_cache(maxsize=1)
def _anchors():
    machine = ahocorasick.Automaton()
    for sign in ("@", "+", "://", *"0123456789"):
        machine.add_word(sign, (("digit" if sign.isdigit() else sign), len(sign)))
    for cue, kind in CUES.items():
        machine.add_word(cue, (kind, len(cue)))
    machine.make_automaton()
    return machine


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _after_cue(kind: str, text: str, end: int):
    found = {"account": _ACCOUNT, "iban": _IBAN, "ssn": _SSN}[kind].match(text, end)
    if found and (kind != "iban" or _mod97(found[1].replace(" ", ""))):
        return found.span(1)
    return None


def spans_of(text: str) -> dict:
    """Spans (start, end) by kind, in code points with the end excluded."""
    found = {kind: [] for kind in KINDS}
    done = dict.fromkeys(KINDS, 0)
    # Cues are found in any spelling; letters of ASCII only are lowered, so that offsets stay.
    for last, (anchor, length) in _anchors().iter(text.encode().lower().decode()):
        start = last + 1 - length
        if anchor == "digit":
            if start >= done["ip"] and (start == done["ip"] or not "0" <= text[start - 1] <= "9"):
                if match := _IP.match(text, start):
                    done["ip"] = match.end()
                    parts = [p.lstrip("0") or "0" for p in match[0].split(".")]
                    if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                        found["ip"].append(match.span())
            if start >= done["card"] and (match := _NUMBER.match(text, start)):
                done["card"] = match.end()
                digits = match[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    found["card"].append(match.span())
        elif anchor == "@":
            left = start
            while left > done["email"] and text[left - 1] in _LOCAL:
                left -= 1
            if left < start and (match := _DOMAIN.match(text, last + 1)):
                done["email"] = match.end()
                found["email"].append((left, match.end()))
        elif anchor == "+":
            if match := _PHONE.match(text, start):
                if 8 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
                    found["phone"].append(match.span())
        elif anchor == "://":
            if match := _LOGIN.match(text, last + 1):
                found["login"].append(match.span())
        elif start >= done[anchor] and not (start and text[start - 1].isalnum()):
            if span := _after_cue(anchor, text, last + 1):
                done[anchor] = span[1]
                found[anchor].append(span)
    return found


def _scan(texts: list) -> list:
    rows = []
    for text in texts:
        found = spans_of(text or "")
        shown = [[f"{kind}:{a}:{b}" for a, b in found[kind]] for kind in KINDS]
        base = ",".join(s for kind in shown[:BASE] for s in kind)
        rows.append((
            *map(len, shown[:BASE]), hashlib.sha256(base.encode()).hexdigest(), ",".join(s for kind in shown for s in kind),
        ))
    return rows


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, their digest, and all spans as ``kind:start:end``."""
    return docs.select("doc_id", over_texts(_scan, SPANS)("text").alias("r")).select("doc_id", "r.*")
