"""Personal data: patterns propose spans, checksums confirm them, words nearby change their score."""

import re
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import functions as F

from pergamon.llm.text import text_bytes

#: Kinds in the order in which spans that begin together are listed; the first four are the base.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "ssn")

#: Score of a confirmed span, what a word of context adds, and the score from which a span counts.
#: Base kinds always count; the context only raises their score.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.9, "secret": 0.4, "ssn": 0.4}
CONTEXT_BONUS = 0.3
MIN_SCORE = 0.6

#: Characters before and after a span in which words of context are looked for.
REACH = 40

#: Words of context of each kind.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "mastercard", "credit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "secret": ("token", "secret", "password", "passwd", "api_key", "apikey", "key", "bearer"),
    "ssn": ("ssn", "social", "security"),
}

# Characters of an account number by country, from the public register of ISO 13616.
IBAN_LENGTHS = dict(pair.split(":") for pair in """
    AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20
    EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30
    KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24
    PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:22 SC:31 SD:18 SE:24 SI:19 SK:24 SM:27 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29
    VA:22 VG:24 XK:20""".split())

_AT_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits can only match from its start, so a part is never tried twice
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?: ?[A-Z0-9]){11})")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}")
_WORD = re.compile(r"[A-Za-z0-9]")
_IBAN_END = re.compile(r"(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{32,128}|AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_CONTEXT = {k: re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, words)) + r")(?![^\W_])", re.I)
            for k, words in CONTEXT.items()}


def luhn(digits):
    """Whether the check digit of a card number holds."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban):
    """Whether the check digits of an account number hold."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text):
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text):
    """Leftmost non-overlapping addresses, found from each @ in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _AT_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _accounts(text):
    """Leftmost non-overlapping account numbers; capitals that go on after a number are not part of it.

    A number has the length of its country; of other countries, and where that length fails, it is the whole
    run of capitals and digits (34 at most).
    """
    start = _IBAN.search(text)
    while start:
        at = start.start()
        ends, length = [], int(IBAN_LENGTHS.get(text[at : at + 2], 0))
        if length:
            taken = 4
            for i in range(start.end(), _IBAN_REST.match(text, start.end()).end()):
                taken += text[i] != " "
                if taken == length and text[i] != " ":
                    ends.append(i + 1)
                    break
        whole = _IBAN_END.match(text, start.end())
        if whole:
            ends.append(whole.end())
        end = next((e for e in ends if not _WORD.match(text, e) and mod97(text[at:e].replace(" ", ""))), None)
        if end:
            yield at, end
        start = _IBAN.search(text, end or at + 1)


def _proposed(text):
    """(kind, start, end) of every span whose validator holds."""
    for start, end in _emails(text):
        yield "email", start, end
    if not any(d in text for d in "0123456789"):
        return
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in _accounts(text):
        yield "iban", start, end
    for m in _SECRET.finditer(text):
        yield "secret", m.start(), m.end()
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()


def find_spans(text):
    """[(start, kind, end, score)] of the personal data in a text, by start, then kind as listed."""
    found = []
    for kind, start, end in _proposed(text):
        near = text[max(0, start - REACH) : start] + " \n " + text[end : end + REACH]
        score = min(1.0, SCORES[kind] + (CONTEXT_BONUS if _CONTEXT[kind].search(near) else 0))
        if kind in BASE_KINDS or score >= MIN_SCORE:
            found.append((start, kind, end, round(score, 2)))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def redact(text, spans):
    """The text with each span replaced by its kind; spans that overlap become one."""
    out, done, i = [], 0, 0
    while i < len(spans):
        start, kind, end, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join(out) + text[done:] if out else text


def _digest(batches):
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            spans = find_spans(batch.column(1)[i].as_py().decode("utf-8", "replace"))
            named = [f"{kind}:{start}:{end}" for start, kind, end, _ in spans]
            base = ",".join(n for n, s in zip(named, spans) if s[1] in BASE_KINDS)
            counts = [sum(s[1] == kind for s in spans) for kind in BASE_KINDS]
            rows.append((*counts, sha256(base.encode()).hexdigest(), ",".join(named),
                         ",".join(str(s[3]) for s in spans)))
        columns = list(zip(*rows)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]],
             *[pa.array(c, pa.string()) for c in columns[4:]]],
            ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "scores"])


def personal_data(docs, doc_id="doc_id", text="text"):
    """Per row: counts and hash of the base spans, all spans as kind:start:end, and their scores.

    Offsets are code points, end exclusive. Null and empty texts have no spans and an empty string's
    hash. Overlapping spans of different kinds are all listed. Rows are independent: nothing is
    shuffled, repeated rows are repeated, and the time is linear in the text.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    return rows.mapInArrow(
        _digest, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, scores string")


def without_personal_data(docs, text="text", length="n_chars"):
    """The documents with every span replaced by its kind, and `length`, if there, counted anew.

    Rows without a span, null texts included, stay as they are.
    """
    place = docs.columns.index(text)
    size = docs.columns.index(length) if length in docs.columns else None

    def clean(batches):
        for batch in batches:
            texts, columns = [], list(batch.columns)
            for value in batch.column(place).cast(pa.binary()):
                value = value.as_py()
                value = None if value is None else value.decode("utf-8", "replace")
                texts.append(value and redact(value, find_spans(value)))
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            if size is not None:
                old = columns[size].to_pylist()
                was = batch.column(place).to_pylist()
                columns[size] = pa.array([o if new == t or new is None else len(new) for o, new, t in zip(old, texts, was)],
                                         batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
