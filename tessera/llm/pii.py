"""Personal data by weak supervision: regex, gazetteer and context labelers vote on candidate spans.

Base spans follow fixed patterns and always stay. Beside them, looser patterns propose candidates: card
numbers that fail the check sum, phone numbers without a plus, spelled-out addresses, and secrets
beside their names. Every span, base or not, gets a vote (-1, 0 or 1) of each labeler.

1. Spark counts the spans per kind, vote pattern and whether they are base. The number of patterns is
   bounded (3 ** labelers per kind), whatever the number of documents.
2. Expectation-maximisation over the pattern counts estimates how each labeler votes on true and on
   false spans, and a prior per kind. Base spans are taken as true throughout.
3. A logistic classifier of votes and kind is trained on the posteriors, weighted by the counts.
4. Candidates that it puts at ``KEEP_AT`` or more become spans.

Places are code points, the end is exclusive. Defined cases: a null text is empty and has no spans; null
ids pass through; repeated rows get equal results, and count as often as they occur; without any
candidate nothing is added; extra columns are ignored (``masked`` keeps them).
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.texts import as_bytes, per_row, slices

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret"]
KEEP_AT = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9][0-9.\x20-]*")
# From the begin of a run of digits only: from within it, the same would follow.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates beyond the base patterns.
_LONG_NUMBER = re.compile(r"(?<![0-9A-Za-z.])[0-9](?:[\x20-]?[0-9]){11,18}(?![0-9A-Za-z])")
_PLUS_PHONE = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,5}){1,4}(?![0-9.])")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z.+])\(?[0-9]{2,4}\)?[\x20.-][0-9]{2,4}[\x20.-][0-9]{3,5}(?![0-9A-Za-z.])")
_SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]{1,63})+",
    re.IGNORECASE,
)
_SECRET = re.compile(
    r"\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer)\b"
    r"\x20{0,2}[=:]\x20{0,2}[\"']?([A-Za-z0-9+/_=-]{8,})",
    re.IGNORECASE,
)
_SECRET_NAME = re.compile(r"token|secret|passw|pwd|key|auth|bearer", re.IGNORECASE)
_AT_WORD = re.compile(r"[(\[{]at[)\]}]", re.IGNORECASE)

# Fixed values of the gazetteers and context lists.
TOP_DOMAINS = frozenset("com org net edu gov info io de fr es it uk us eu ch at nl be pt".split())
DIAL_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 81 82 86 90 91 351 352 353 358 420".split())
CONTEXT = {
    "email": ["mail", "contact", "write", "correo", "courriel"],
    "ip": ["ip", "host", "server", "address", "adresse"],
    "card": ["card", "visa", "master", "karte", "carte", "tarjeta", "credit"],
    "phone": ["phone", "tel", "call", "fax", "mobil", "móvil", "anruf"],
    "secret": ["token", "secret", "passw", "key", "auth"],
}
AGAINST = ["version", "page", "isbn", "issn", "figure", "section", "$", "€", "§", "#"]

LABELERS = ["format", "check", "gazetteer", "context", "isolated", "against", "shape"]


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _bare(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind."""
    found: list[Span] = []
    pos = free = 0
    while (at := text.find("@", pos)) >= 0:
        pos, left = at + 1, at
        while left > free and text[left - 1] in _LOCAL:
            left -= 1
        if left < at and (m := _DOMAIN.match(text, at + 1)):
            found.append(Span(left, 0, m.end()))
            pos = m.end()
        free = pos
    # Addresses and card numbers lie within runs of digits, points, blanks and hyphens.
    for run in _DIGITS.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        if text.count(".", a, b) > 2:
            for m in _IP.finditer(text, a, b):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    found.append(Span(m.start(), 1, m.end()))
        if b - a >= 12:
            for m in _CARD.finditer(text, a, b):
                digits = _bare(m[0]) if m.end() - m.start() <= 37 else ""
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(Span(m.start(), 2, m.end()))
    pos = 0
    while (at := text.find("+", pos)) >= 0:
        m = _PHONE.match(text, at)
        pos = m.end() if m else at + 1
        if m and 9 <= len(_bare(m[0])) <= 15:
            found.append(Span(at, 3, m.end()))
    return sorted(found)


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Further spans to vote on; they overlap no earlier candidate and, but for secrets, no base span."""
    found: list[Span] = []
    taken = bytearray()

    def propose(start: int, kind: int, end: int) -> None:
        nonlocal taken
        if not taken:
            taken = bytearray(len(text))
            for s in base:
                taken[s.start : s.end] = b"\1" * (s.end - s.start)
        if KINDS[kind] == "secret" and taken.find(0, start, end) >= 0 or taken.find(1, start, end) < 0:
            taken[start:end] = b"\1" * (end - start)
            found.append(Span(start, kind, end))

    if "=" in text or ":" in text:
        lowered = text.lower()
        if any(w in lowered for w in ("token", "secret", "pass", "pwd", "key", "auth", "bearer")):
            for m in _SECRET.finditer(text):
                propose(m.start(1), 4, m.end(1))
    for run in _DIGITS.finditer(text):
        a, b = run.span()
        if b - a < 9:
            continue
        for m in _LONG_NUMBER.finditer(text, a, b):
            propose(m.start(), 2, m.end())
        for m in _LOCAL_PHONE.finditer(text, max(0, a - 1), min(len(text), b + 1)):
            propose(m.start(), 3, m.end())
    at = text.find("+")
    while at >= 0:
        m = _PLUS_PHONE.match(text, at)
        if m and 9 <= len(_bare(m[0])) <= 15:
            propose(at, 3, m.end())
        at = text.find("+", at + 1)
    if any(c in text for c in "([{") and _AT_WORD.search(text):
        for m in _SPELLED.finditer(text):
            propose(m.start(), 0, m.end())
    return sorted(found)


def votes(text: str, span: Span) -> int:
    """The votes of all labelers as one number in base three; -1 is digit 0."""
    start, kind, end = span
    body = text[start:end]
    digits = _bare(body)
    before = text[max(0, start - 32) : start].lower()
    after = text[end : end + 1]
    name = KINDS[kind]
    ballot = dict.fromkeys(LABELERS, 0)
    if name == "email":
        top = re.split(r"[.)\]} ]+", body)[-1].lower()
        ballot["format"] = 1 if len(top) >= 2 and top.isalpha() else -1
        ballot["gazetteer"] = 1 if top in TOP_DOMAINS else -1
        ballot["check"] = 1 if body[0].isalnum() else -1
    elif name == "ip":
        parts = body.split(".")
        ballot["format"] = 1 if all(p == "0" or p[0] != "0" for p in parts) else -1
        ballot["check"] = 1 if parts[0].lstrip("0") not in ("", "255") else -1
    elif name == "card":
        ballot["format"] = 1 if len(digits) in (15, 16) else -1
        ballot["check"] = 1 if luhn(digits) else -1
        ballot["gazetteer"] = 1 if digits[0] in "3456" else -1
    elif name == "phone":
        ballot["format"] = 1 if body[0] == "+" or "(" in body else 0
        ballot["check"] = 1 if 10 <= len(digits) <= 13 else -1
        lead = re.match(r"\+?([0-9]{1,3})", body)
        ballot["gazetteer"] = 1 if body[0] == "+" and lead and lead[1] in DIAL_CODES else 0
    else:
        ballot["format"] = 1 if len(body) >= 20 else -1
        ballot["check"] = 1 if digits and any(c.isalpha() for c in body) else -1
        ballot["gazetteer"] = 1 if _SECRET_NAME.search(before) else -1
    ballot["context"] = 1 if any(w in before for w in CONTEXT[name]) else 0
    edge = (not before or not before[-1].isalnum()) and (not after or not after.isalnum())
    ballot["isolated"] = 1 if edge else -1
    ballot["against"] = -1 if any(w in before[-12:] for w in AGAINST) or after == "%" else 0
    ballot["shape"] = -1 if len(body) > 3 and len(set(body)) <= 2 else 0
    code = 0
    for labeler in LABELERS:
        code = code * 3 + ballot[labeler] + 1
    return code


def unpacked(code: int) -> list[int]:
    found = []
    for _ in LABELERS:
        code, digit = divmod(code, 3)
        found.append(digit - 1)
    return found[::-1]


class Pattern(NamedTuple):
    kind: int
    code: int
    base: bool
    count: int


def reliabilities(patterns: list[Pattern], rounds: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors per pattern, ``P(vote | truth)`` as ``[truth, labeler, vote + 1]`` and priors per kind."""
    n = np.array([p.count for p in patterns], float)
    base = np.array([p.base for p in patterns])
    kind = np.array([p.kind for p in patterns])
    vote = np.array([unpacked(p.code) for p in patterns]) + 1
    # A start from the votes themselves; the check sum alone is one vote among others.
    posterior = np.where(base, 1.0, 1 / (1 + np.exp(-(vote - 1).sum(axis=1))))
    table = np.zeros((2, len(LABELERS), 3))
    prior = np.zeros(len(KINDS))
    for _ in range(rounds):
        for truth in (0, 1):
            weight = n * (posterior if truth else 1 - posterior)
            for k in range(len(LABELERS)):
                table[truth, k] = np.bincount(vote[:, k], weight, 3) + 1
            table[truth] /= table[truth].sum(axis=1, keepdims=True)
        # Priors come from candidates alone, as base spans are not in question.
        open_ = n * ~base
        prior = (np.bincount(kind, open_ * posterior, len(KINDS)) + 1) / (np.bincount(kind, open_, len(KINDS)) + 2)
        each = np.log(table)[:, np.arange(len(LABELERS)), vote].sum(axis=2)
        odds = each[1] - each[0] + np.log(prior / (1 - prior))[kind]
        following = np.where(base, 1.0, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        if np.abs(following - posterior).max() < 1e-9:
            break
        posterior = following
    return posterior, table, prior


def _features(kind: np.ndarray, code: np.ndarray) -> np.ndarray:
    vote = np.array([unpacked(int(c)) for c in code]).reshape(-1, len(LABELERS))
    own = np.eye(len(KINDS))[kind]
    return np.concatenate([vote == 1, vote == -1, own], axis=1).astype(float)


class Model(NamedTuple):
    weights: np.ndarray
    keep: frozenset[tuple[int, int]]


def trained(patterns: list[Pattern], rounds: int = 60) -> Model:
    """The classifier of spans, by Newton steps on the posteriors; ``keep`` has the patterns it accepts."""
    if not patterns:
        return Model(np.zeros(2 * len(LABELERS) + len(KINDS)), frozenset())
    patterns = sorted(patterns)
    posterior, _, _ = reliabilities(patterns)
    kind = np.array([p.kind for p in patterns])
    code = np.array([p.code for p in patterns])
    n = np.array([p.count for p in patterns], float)
    x = _features(kind, code)
    n = n / n.sum() * len(n)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (posterior - p)) - 0.01 * weights
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights += step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    every_code = np.tile(np.arange(3 ** len(LABELERS)), len(KINDS))
    every_kind = np.repeat(np.arange(len(KINDS)), 3 ** len(LABELERS))
    kept = _features(every_kind, every_code) @ weights >= np.log(KEEP_AT / (1 - KEEP_AT))
    return Model(weights, frozenset(zip(every_kind[kept].tolist(), every_code[kept].tolist(), strict=True)))


def fitted(docs: DataFrame, text: str = "text") -> Model:
    """A model from all spans of all documents; only counts per pattern reach the driver."""

    def count(batches):
        for batch in slices(batches, text):
            seen: dict[tuple[int, int, bool], int] = {}
            for raw in as_bytes(batch.column(text)):
                body = raw.decode()
                base = base_spans(body)
                for span, is_base in [(s, True) for s in base] + [(s, False) for s in candidates(body, base)]:
                    key = (span.kind, votes(body, span), is_base)
                    seen[key] = seen.get(key, 0) + 1
            kinds, codes, bases = zip(*seen, strict=True) if seen else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array(codes, pa.int32()), pa.array(bases, pa.bool_()),
                 pa.array(seen.values(), pa.int64())],
                names=["kind", "code", "base", "n"],
            )

    counted = docs.select(text).mapInArrow(count, "kind int, code int, base boolean, n long")
    rows = counted.groupBy("kind", "code", "base").agg(F.sum("n").alias("n")).collect()
    return trained([Pattern(r["kind"], r["code"], r["base"], r["n"]) for r in rows])


def spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans in order."""
    base = base_spans(text)
    added = [s for s in candidates(text, base) if (s.kind, votes(text, s)) in model.keep]
    return base, sorted(base + added)


def listed(found: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in found)


def detected(docs: DataFrame, text: str = "text", doc: str = "doc_id", model: Model | None = None) -> DataFrame:
    """``(doc, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of each row; counts are of base spans."""
    model = model or fitted(docs, text)

    def make(raw: bytes) -> tuple:
        base, every = spans(raw.decode(), model)
        counts = [sum(s.kind == k for s in base) for k in range(len(BASE_KINDS))]
        return (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(every))

    schema = ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
    return per_row(docs, [doc], text, make, schema)


def mask(text: str, found: list[Span]) -> str:
    """``text`` with each run of overlapping spans replaced by the kind of its first."""
    parts, at = [], 0
    for start, kind, end in found:
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with personal data masked; null texts stay null, other columns as they are."""
    model = model or fitted(docs, text)
    place = docs.columns.index(text)

    def run(batches):
        for batch in slices(batches, text):
            column = batch.column(place)
            new = [
                None if raw is None else mask(raw, spans(raw, model)[1]) for raw in column.to_pylist()
            ]
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, column.type))

    return docs.mapInArrow(run, docs.schema)
