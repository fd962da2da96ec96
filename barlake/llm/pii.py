"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Candidates are the matches of four base patterns (email, ip, card, phone), their near misses, and
looser forms (spelt-out emails, local phone numbers). Six labelers vote yes, no or abstain on each:
the pattern, a checksum or range check, a gazetteer, words in front, the surrounding characters, and
the grouping. Spark counts how often each pattern of votes occurs, over all documents;
expectation-maximisation on these few counts estimates how reliable each labeler is, and a logistic
span classifier is trained on the resulting probabilities. Base matches always stay; the classifier
says which other candidates join them.

Null text counts as empty and has no spans. Repeated rows get equal results, an empty table an empty
one. Overlapping spans of different kinds are all reported; redaction treats them as one. Matching
takes time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import find_package, over_texts

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.5
# Gazetteers.
DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu ru cn jp br in au ca us ch at".split())
CALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 61 62 63 64 65 66 81 82 84 86 90 91 92 98".split())
CUES = {
    "email": frozenset("mail email e-mail contact write reach correo kontakt address".split()),
    "ip": frozenset("ip host server address from client login connected".split()),
    "card": frozenset("card visa mastercard amex credit debit karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon fon teléfono téléphone".split()),
}

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digits are taken whole: a match can't begin inside a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63})+"
)
_AT = re.compile(r"[\[(]at[\])]")
_NATIONAL = re.compile(r"(?<![\w+.)-])(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\w-])")
_WORD = re.compile(r"[^\W\d_][\w-]*")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping email matches, found from their @ signs."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def small_number(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def base_match(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(map(small_number, found.split(".")))
    digits = "".join(_DIGIT.findall(found)) if kind in ("card", "phone") else ""
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def candidates(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, base) of all candidates, by start and then kind."""
    found = [(a, b, "email", True) for a, b in emails(text)] if "@" in text else []
    looser: list[tuple[int, int, str, bool]] = []
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            for m in pattern.finditer(text):
                base = base_match(kind, m[0])
                # Short numbers are no near misses of cards.
                if base or kind != "card" or m.end() - m.start() >= 12:
                    found.append((m.start(), m.end(), kind, base))
        looser += [(m.start(), m.end(), "phone", False) for m in _NATIONAL.finditer(text)]
    if _AT.search(text):
        looser += [(m.start(), m.end(), "email", False) for m in _SPELT.finditer(text)]
    if looser:  # a part of a stricter match is no candidate of its own
        taken = sorted(found)
        starts = [s[0] for s in taken]
        reach = list(accumulate((s[1] for s in taken), max))
        found += [s for s in looser if not (i := bisect_left(starts, s[1])) or reach[i - 1] <= s[0]]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def votes(text: str, start: int, end: int, kind: str, base: bool) -> tuple[int, ...]:
    """Of each labeler: 1 yes, 0 no, -1 abstains."""
    found = text[start:end]
    digits = "".join(_DIGIT.findall(found))[:40]
    words = {w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])}
    if kind == "email":
        domain = re.split(r"[.)\]]", found.lower().replace(" ", ""))[-1]
        valid, listed = int(len(domain) >= 2 and not domain.isdigit()), int(domain in DOMAINS)
        grouped = int("@" in found and ".." not in found)
    elif kind == "ip":
        valid, listed = int(base), int(found.split(".")[0] not in ("0", "127", "255")) if base else 0
        grouped = int(not any(len(p) > 1 and p[0] == "0" for p in found.split(".")))
    elif kind == "card":
        valid, listed = int(base), int(digits[:1] in "3456")
        grouped = int(bool(re.fullmatch(r"[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}", found)))
    else:
        valid = int(10 <= len(digits) <= 15)
        listed = int(any(digits.startswith(c) for c in CALLING)) if found[0] == "+" else -1
        grouped = int(found.count("(") == found.count(")") <= 1 and "  " not in found)
    around = (text[start - 1 : start] or " ") + (text[end : end + 1] or " ")
    alone = int(not any(c.isalnum() or c in "_@/=" for c in around))
    # The pattern says no to its near misses, and nothing on looser forms.
    strict = 1 if base else 0 if kind in ("ip", "card") or found[0] == "+" else -1
    return (strict, valid, listed, 1 if words & CUES[kind] else -1, alone, grouped)


def signature(text: str, span: tuple[int, int, str, bool]) -> str:
    """Kind, votes and length class: all that the classifier sees of a span."""
    start, end, kind, base = span
    length = min(3, (end - start) // 12)
    return f"{kind} {' '.join(map(str, votes(text, start, end, kind, base)))} {length}"


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities by kind and labeler, and the probability of each signature seen in the corpus."""

    reliability: dict[str, list[tuple[float, float]]]
    weights: np.ndarray

    def probability(self, name: str) -> float:
        return float(1 / (1 + np.exp(-features(name) @ self.weights)))


def features(name: str) -> np.ndarray:
    kind, *marks = name.split()
    out = [float(kind == k) for k in KINDS]
    for mark in marks[:-1]:
        out += [float(mark == "1"), float(mark == "0")]
    return np.array(out + [float(marks[-1] == str(k)) for k in range(4)])


def reliabilities(names: list[str], counts: np.ndarray, rounds: int = 50) -> tuple[dict, np.ndarray]:
    """EM per kind: (P(yes | true), P(yes | false)) of each labeler, and P(true) of each signature."""
    posterior, found = np.zeros(len(names)), {}
    for kind in KINDS:
        mine = [i for i, n in enumerate(names) if n.split()[0] == kind]
        if not mine:
            continue
        marks = np.array([[int(v) for v in names[i].split()[1:-1]] for i in mine])
        yes, no, n = marks == 1, marks == 0, counts[mine].astype(float)
        p = (yes.sum(1) + 0.5) / (yes.sum(1) + 2 * no.sum(1) + 1)  # a veto counts twice at the start
        for _ in range(rounds):
            # Add-one smoothing towards labelers that are mostly right.
            t = ((n * p) @ yes + 4) / ((n * p) @ (yes | no) + 5)
            f = ((n * (1 - p)) @ yes + 1) / ((n * (1 - p)) @ (yes | no) + 5)
            t = np.maximum(t, f)  # no labeler may turn against its meaning
            prior = ((n * p).sum() + 1) / (n.sum() + 2)
            like = lambda q: yes @ np.log(q) + no @ np.log(1 - q)  # noqa: B023, E731
            odds = np.log(prior) - np.log(1 - prior) + like(t) - like(f)
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        posterior[mine] = p
        found[kind] = list(zip(t.tolist(), f.tolist(), strict=True))
    return found, posterior


def train(names: list[str], counts: np.ndarray) -> SpanModel:
    reliability, soft = reliabilities(names, counts)
    x = np.array([features(n) for n in names]) if names else np.zeros((0, len(features("email 1 1 1 1 1 1 0"))))
    w = np.zeros(x.shape[1])
    n = np.log1p(counts.astype(float))  # frequent signatures count more, but don't drown the others
    for _ in range(25):  # Newton steps, with a ridge
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (n * (soft - p)) - 0.05 * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return SpanModel(reliability, w)


def fit(docs: DataFrame) -> SpanModel:
    """Count the signatures of all candidates in all documents; there are a few thousand at most."""

    def work(ids: list, texts: list[str]) -> dict:
        seen = Counter(signature(t, s) for t in texts for s in candidates(t))
        return {"name": list(seen), "n": list(seen.values())}

    counted = over_texts(docs, work, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    rows = sorted(tuple(r) for r in counted.collect())
    return train([r[0] for r in rows], np.array([r[1] for r in rows]))


def spans(text: str, model: SpanModel, known: dict[str, bool]) -> list[tuple[int, int, str, bool]]:
    """Base spans, and the other candidates that the classifier accepts."""
    out = []
    for span in candidates(text):
        if not span[3]:
            name = signature(text, span)
            if name not in known:
                known[name] = model.probability(name) >= ACCEPT
            if not known[name]:
                continue
        out.append(span)
    return out


def written(found: list[tuple[int, int, str, bool]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in found)


def find_pii(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans); the numbers are of base spans."""
    model = model or fit(docs)
    names = [f"n_{k}" for k in KINDS]
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string"

    def work(ids: list, texts: list[str]) -> dict:
        known: dict[str, bool] = {}
        each = [spans(t, model, known) for t in texts]
        base = [[s for s in found if s[3]] for found in each]
        out = {n: [sum(s[2] == k for s in b) for b in base] for n, k in zip(names, KINDS, strict=True)}
        digests = [hashlib.sha256(written(b).encode()).hexdigest() for b in base]
        return {"doc_id": ids, "base_sha256": digests, "spans": [written(s) for s in each]} | out

    return over_texts(docs, work, schema)


def redacted(text: str, found: list[tuple[int, int, str, bool]]) -> str:
    out, at = [], 0
    for start, end, kind, _ in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """The documents with each span replaced by its kind; other columns stay, n_chars is set anew."""
    find_package(docs.sparkSession)
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            new = [t if t is None or not (s := spans(t, model, known)) else redacted(t, s) for t in texts]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            at = batch.schema.get_field_index("n_chars")
            if at >= 0:
                field = batch.schema.field(at)
                old = batch.column(at).to_pylist()
                sizes = [n if a is b else len(b) for a, b, n in zip(texts, new, old, strict=True)]
                batch = batch.set_column(at, field, pa.array(sizes, field.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
