"""Personal data by weak supervision.

Fixed patterns give the base spans. Beside them, wider patterns propose
candidates (card and phone numbers in other forms, spelled-out addresses,
identity numbers, credentials); labelers of three sorts - regular
expressions, gazetteers, context - vote for, against or not at all on each.
Expectation-maximisation over the vote patterns of the whole corpus estimates
how reliable each labeler is, and its posteriors train the final span
classifier, a logistic regression over votes, kind and shape. Accepted
candidates are added; base spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column_of, staged, text_list

BASE = ("email", "ip", "card", "phone")
ADDED = ("card_part", "phone_local", "email_spelled", "id_number", "secret")
KINDS = BASE + ADDED

# The base patterns. A number is only begun where its run of
# digits begins, which finds the same leftmost matches in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Candidate patterns and gazetteers.
_CANDIDATES = (
    ("card_part", re.compile(r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])")),
    ("phone_local", re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9])00[1-9][0-9]{0,2}[ -][0-9]{2,4}[ -][0-9]{3,4}[ -]?[0-9]{2,4}(?![0-9])")),
    ("email_spelled", re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[A-Za-z0-9-]{1,63}){1,4}")),
    ("id_number", re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![0-9A-Za-z])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}+|sk_(?:live|test)_[A-Za-z0-9]{10,}+|[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])"
                          r"|(?<=[=:\"'])[^\s\"']{6,}+(?=[\"'\s]|$)|(?<=[=:] )[^\s\"']{6,}+(?=[\"'\s]|$)")),
)
_CONTEXT = {
    "card_part": "card visa credit debit karte tarjeta carte pay".split(),
    "phone_local": "phone tel call mobile fax contact telefon anruf".split(),
    "email_spelled": "mail email write contact address reach".split(),
    "id_number": "ssn social security id iban account passport konto cuenta compte".split(),
    "secret": "password passwd pwd token secret key apikey api_key auth credential".split(),
}
_STRICT = {
    "card_part": re.compile(r"[3-6][0-9]{12,18}"), "phone_local": re.compile(r"\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}|00.*"), "email_spelled": re.compile(r".*dot.*|.*\.[a-z]{2,6}"),
    "id_number": re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]+"), "secret": re.compile(r"(?=.*[0-9])[A-Za-z0-9_+/=-]{8,}"),
}
_GAZETTEER = {
    "card_part": ("34", "37", "35", "4", "51", "52", "53", "54", "55", "60", "65"),
    "phone_local": ("800", "888", "877", "555", "212", "415", "0049", "0033", "0034", "0044", "001", "(5", "(8"),
    "email_spelled": ("com", "org", "net", "edu", "de", "fr", "es", "io", "uk"),
    "id_number": ("DE", "FR", "ES", "GB", "IT", "NL", "AT", "CH"),
    "secret": ("AKIA", "ghp_", "gho_", "sk_live", "sk_test"),
}
LABELERS = ("format", "checksum", "gazetteer", "context", "boundary", "variety")
#: Characters before a span in which context words count.
WINDOW = 32


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if len(m[0]) <= 40 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def _votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """-1, 0 or 1 from each of LABELERS."""
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    before = text[max(0, start - WINDOW) : start].lower()
    form = 1 if _STRICT[kind].fullmatch(digits if kind == "card_part" else span) else -1
    check = (1 if luhn(digits) else -1) if kind == "card_part" else 0
    listed = _GAZETTEER[kind]
    known = 1 if (span.endswith(listed) if kind == "email_spelled" else span.startswith(listed)) else (0 if kind != "card_part" else -1)
    near = 1 if any(w in before for w in _CONTEXT[kind]) else (-1 if kind == "secret" and not known else 0)
    edge = text[start - 1 : start] + text[end : end + 1]
    joined = -1 if any(c.isalnum() for c in edge) else 0
    share = len(set(span)) / len(span)
    varied = -1 if len(set(digits or span)) <= 2 else (1 if kind == "secret" and (share > 0.5 or len(set(span)) >= 12) and any(c.isdigit() for c in span) else 0)
    return form, check, known, near, joined, varied


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, str]]:
    """(kind number, start, end, votes, shape) of spans beside ``taken``."""
    out: list[tuple[int, int, int, str, str]] = []
    digit = _DIGIT.search(text) is not None
    starts, ends = [], []  # what is taken, as disjoint intervals in order
    for _, s, e in sorted(taken, key=lambda x: x[1:]):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for kind, pattern in _CANDIDATES:
        if not digit and kind not in ("email_spelled", "secret") or kind == "email_spelled" and not ("at]" in text or "at)" in text or "at }" in text or "at ]" in text or "at )" in text or "at}" in text):
            continue
        if kind == "secret" and not digit and "=" not in text and ":" not in text:
            continue
        for m in pattern.finditer(text):
            s, e = m.span()
            at = bisect_left(starts, e)
            if at and ends[at - 1] > s:
                continue
            span = m[0]
            votes = "".join("-0+"[v + 1] for v in _votes(kind, text, s, e))
            shape = f"{min(4, len(span) // 8)}{int(4 * sum(c.isdigit() for c in span) / len(span))}{int(span.isalnum())}"
            out.append((KINDS.index(kind), s, e, votes, shape))
            if kind == "card_part" and not luhn("".join(_DIGIT.findall(span))):
                continue  # other kinds may still be proposed here
            starts.insert(at, s)
            ends.insert(at, e)
    return out


_FOUND = "base array<struct<kind:int,start:int,stop:int>>, candidate array<struct<kind:int,start:int,stop:int,votes:string,shape:string>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, candidate) of every row; null text is empty."""
    spans = [("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]
    base_type, candidate_type = pa.list_(pa.struct(spans)), pa.list_(pa.struct([*spans, ("votes", pa.string()), ("shape", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bases, more = [], []
            for text in text_list(b):
                base = base_spans(text)
                bases.append([dict(zip(("kind", "start", "stop"), x)) for x in base])
                more.append([dict(zip(("kind", "start", "stop", "votes", "shape"), x)) for x in candidates(text, base)])
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), pa.array(bases, base_type), pa.array(more, candidate_type)], ["doc_id", "base", "candidate"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id long, {_FOUND}")


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern (-1, 0, 1 by labeler) and the labelers'
    tables P(vote | class), from pattern counts.

    Labelers are taken to be independent given the class; the start and a
    small prior take each to be right more often than wrong."""
    prior = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])  # pseudo-counts by class and vote
    post = 1 / (1 + np.exp(-votes.sum(axis=1)))
    onehot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)  # pattern, labeler, vote
    table = np.empty((2, votes.shape[1], 3))
    for _ in range(rounds):
        for c, weight in enumerate((n * (1 - post), n * post)):
            t = np.einsum("p,plv->lv", weight, onehot) + prior[c]
            table[c] = t / t.sum(axis=1, keepdims=True)
        share = ((n * post).sum() + 1) / (n.sum() + 2)
        like = np.einsum("plv,clv->pc", onehot, np.log(table)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -50, 50)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return post, table


def _features(kind: int, votes: str, shape: str) -> np.ndarray:
    v = np.array(["-0+".index(c) - 1 for c in votes], dtype=float)
    hot = np.zeros(len(ADDED) + 15)
    hot[kind - len(BASE)] = 1
    for k, c in enumerate(shape[:2]):
        hot[len(ADDED) + 5 * k + int(c)] = 1
    hot[len(ADDED) + 10 + int(shape[2])] = 1
    return np.concatenate([[1.0], v, np.abs(v), hot])


class SpanClassifier:
    """Logistic regression on the posteriors; one probability per (kind, votes, shape)."""

    def __init__(self, groups: list[tuple[int, str, str, int]]):
        self.table: dict = {}
        self.reliability: dict[int, np.ndarray] = {}
        if not groups:
            return
        n = np.array([g[3] for g in groups], dtype=float)
        target = np.zeros(len(groups))
        for kind in sorted({g[0] for g in groups}):  # each kind has labelers of its own
            rows = [k for k, g in enumerate(groups) if g[0] == kind]
            votes = np.array([["-0+".index(c) - 1 for c in groups[k][1]] for k in rows], dtype=float)
            target[rows], self.reliability[kind] = expectation_maximisation(votes, n[rows])
        x = np.stack([_features(*g[:3]) for g in groups])
        w, weight = np.zeros(x.shape[1]), n / n.sum()
        ridge = 1e-4 * np.eye(len(w))
        for _ in range(60):  # Newton steps
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (weight * (p - target)) + ridge @ w
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
            step = np.linalg.solve(hess, grad)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-9:
                break
        self.weights = w

    def accepts(self, kind: int, votes: str, shape: str) -> bool:
        key = (kind, votes, shape)
        if key not in self.table:
            self.table[key] = bool(self.reliability) and float(_features(*key) @ self.weights) >= 0
        return self.table[key]


def train(found: DataFrame) -> SpanClassifier:
    """The classifier from all candidates: the driver gets a count for each
    (kind, votes, shape) that occurs, of which there are a fixed number."""
    each = found.select(F.explode("candidate").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count("*").alias("n"))
    return SpanClassifier(sorted((r["kind"], r["votes"], r["shape"], r["n"]) for r in each.collect()))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256 and spans (base and added; kind:start:end in code points).

    Null and empty texts have no spans (base_sha256 is that of ''); repeated
    rows stay; null ids are kept; an empty table gives no rows and trains
    nothing; other columns are ignored."""
    found = staged(find(docs, id_col, text_col), "personal-data")
    model = found.sparkSession.sparkContext.broadcast(train(found))
    names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for base, more in zip(column_of(b, "base").to_pylist(), column_of(b, "candidate").to_pylist()):
                own = [(x["kind"], x["start"], x["stop"]) for x in base]
                added = [(x["kind"], x["start"], x["stop"]) for x in more if model.value.accepts(x["kind"], x["votes"], x["shape"])]
                kinds = [k for k, _, _ in own]
                rows.append((*map(kinds.count, range(len(BASE))), hashlib.sha256(_joined(own).encode()).hexdigest(), _joined(own + added)))
            cols = list(zip(*rows)) or [()] * (len(BASE) + 2)
            kinds = [pa.int64()] * len(BASE) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([column_of(b, "doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds))], names)

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that
    overlap the union is replaced, under the kind that begins first."""
    out, end = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if s >= end:
            out += [text[end:s], f"[{KINDS[k].upper()}]"]
        end = max(end, e)
    return "".join(out) + text[end:]


def redacted(docs: DataFrame, text_col: str = "text") -> Column:
    """A column for ``docs``: its text with personal data masked. The
    classifier is trained on all rows of ``docs`` first.

    Null and empty texts stay as they are, very long ones are searched whole;
    repeated rows are masked alike; an empty table trains nothing; other
    columns and ids play no part, whatever their names."""
    found = staged(find(docs.withColumn("__id", F.lit(0)), "__id", text_col), "personal-data")
    model = found.sparkSession.sparkContext.broadcast(train(found))

    @F.pandas_udf("string")
    def mask(texts):
        def one(text):
            if text is None:
                return None
            base = base_spans(text)
            added = [(k, s, e) for k, s, e, votes, shape in candidates(text, base) if model.value.accepts(k, votes, shape)]
            return masked(text, base + added)

        return texts.map(one)

    return mask(F.col(text_col).cast("string"))
