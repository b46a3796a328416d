"""Personal data by a skip-chain conditional random field.

Base spans are found by expressions (email, ip, card, phone). Around them a field labels the
tokens that hold a digit or an at sign; all others are outside of any entity. Tokens are
maximal runs of non-space characters. Three kinds of potentials score a labelling:

* token features (length, digits, dots, signs, neighbours) weigh each label,
* chain potentials link candidate tokens next to each other in the text,
* skip potentials link distant tokens that repeat or resemble each other: the same token, or
  the same last ``SUFFIX`` digits, or the same local part of an address.

Loopy sum-product message passing runs over each document's graph, so the evidence at one
mention reaches the others. Tokens whose label is likelier than ``SURE`` become spans unless a
base span covers them. The potentials are fitted piecewise (each kind for itself) on base spans
of a sample of ``MAX_FIT`` texts at most, chosen alike at every size of the table.

Defined results: null and empty texts have no spans. Spans count code points, end exclusive.
Rows are labelled each by itself; repeated rows get equal spans. A group of tokens that
resemble each other is linked as a chain in text order, so links grow with the tokens.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import add_columns, discard, fresh, kth_largest, materialise, text_portions, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
MAX_FIT = 5_000
#: Candidate tokens, and characters in them, that a text of the fitting sample holds at most: the
#: driver fits on 640,000 tokens of 20 figures, about 100 MB.
MAX_FIT_TOKENS, MAX_FIT_CHARS = 128, 4_096
SUFFIX = 7
SURE = 0.9
ROUNDS = 12

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_REST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits does; possessive runs keep long ones linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile("(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    beyond = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > beyond and text[start - 1] in _LOCAL:
            start -= 1
        m = _MAIL_REST.match(text, at) if start < at else None
        if m:
            yield start, m.end(), "email"
            beyond = m.end()
        at = text.find("@", max(at + 1, beyond))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; failing matches dropped."""
    spans = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                spans.append((m.start(), m.end(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens that hold a digit or an at sign."""
    return [m.span() for m in _TOKEN.finditer(text)] if re.search("[0-9@]", text) else []


def _features(text: str, tokens: list[tuple[int, int]]) -> np.ndarray:
    rows = []
    for k, (start, end) in enumerate(tokens):
        token = text[start:end].strip("#*$%&|<>\"'=,;:!?.[]{}")
        digits = sum(map(token.count, "0123456789"))
        near = [text[a:b] for i in (k - 1, k + 1) if 0 <= i < len(tokens) for a, b in [tokens[i]]
                if max(a, start) - min(b, end) <= 1]
        row = [1.0, "@" in token, token.count(".") == 3, "." in token, token.startswith("+"), "(" in token, "-" in token,
               digits == len(token) and digits > 0, any(c.isalpha() for c in token)]
        row += [digits == 0, digits <= 2, 3 <= digits <= 4, 5 <= digits <= 8, 9 <= digits <= 11, 12 <= digits <= 19,
                digits > 19, digits == len(token) and 12 <= digits <= 19 and luhn("".join(filter(str.isascii, token))
                                                                               if token.isascii() else "1")]
        row += [any(x.startswith("+") for x in near), any(x.startswith("(") for x in near), len(near) == 2]
        rows.append([float(x) for x in row])
    return np.array(rows)


def _links(text: str, tokens: list[tuple[int, int]]) -> tuple[list, list]:
    """(chain, skip) pairs of token positions."""
    chain = [(i, i + 1) for i in range(len(tokens) - 1) if tokens[i + 1][0] - tokens[i][1] <= 1]
    last: dict[str, int] = {}
    skip = set()
    for i, (start, end) in enumerate(tokens):
        token = text[start:end].strip("#*$%&|<>\"'=,;:!?.[]{}")
        digits = "".join(c for c in token if "0" <= c <= "9")
        keys = ["=" + token.lower()] if len(token) > 3 else []
        keys += ["#" + digits[-SUFFIX:]] if len(digits) >= SUFFIX else []
        keys += ["@" + token.lower().split("@")[0]] if len(token) > 5 else []
        for key in keys:
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    return chain, sorted(skip - set(chain))


def _first_overlap(spans: list[tuple[int, int, str]]):
    """For ``spans`` in order of start: a function of (start, end) that finds the first span that
    overlaps them, or None."""
    reach = list(accumulate((end for _, end, _ in spans), max))

    def first(start: int, end: int):
        at = bisect_right(reach, start)
        return spans[at] if at < len(spans) and spans[at][0] < end else None

    return first


def _labels(tokens: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> np.ndarray:
    out, first = np.zeros(len(tokens), dtype=int), _first_overlap(spans)
    for i, token in enumerate(tokens):
        if found := first(*token):
            out[i] = LABELS.index(found[2])
    return out


class Field:
    """Potentials: ``node`` (features x labels), ``chain`` and ``skip`` (labels x labels), in logs."""

    def __init__(self, node: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.node, self.chain, self.skip = node, chain, skip

    def marginals(self, features: np.ndarray, chain: list, skip: list) -> np.ndarray:
        """Loopy sum-product over the tokens of a document."""
        score = features @ self.node
        score -= score.max(axis=1, keepdims=True)
        edges = [*chain, *skip]
        if not edges:
            belief = np.exp(score)
            return belief / belief.sum(axis=1, keepdims=True)
        a = np.array([e[0] for e in edges] + [e[1] for e in edges])
        b = np.array([e[1] for e in edges] + [e[0] for e in edges])
        # messages along chain and skip links, then against them: runs with one table each
        tables = [np.exp(t) for t in (self.chain, self.skip, self.chain.T, self.skip.T)]
        cuts = np.cumsum([len(chain), len(skip), len(chain)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        message = np.zeros((2 * len(edges), len(LABELS)))
        for _ in range(ROUNDS):
            total = score.copy()
            np.add.at(total, b, message)
            out = total[a] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.concatenate([part @ t for part, t in zip(np.split(out, cuts), tables)]))
            new -= new.max(axis=1, keepdims=True)
            message = 0.5 * message + 0.5 * new
        total = score.copy()
        np.add.at(total, b, message)
        belief = np.exp(total - total.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def _agreement(pairs: list[tuple[int, int]], prior: float) -> np.ndarray:
    """Log potentials of label pairs: how much oftener they meet than by chance."""
    counts = np.full((len(LABELS), len(LABELS)), prior)
    counts += prior * 20 * np.eye(len(LABELS))
    for a, b in pairs:
        counts[a, b] += 1
    p = counts / counts.sum()
    return np.clip(np.log(p / np.outer(p.sum(axis=1), p.sum(axis=0))), -4, 4)


def fit(texts: list[str], steps: int = 300) -> Field:
    """Piecewise fit on the base spans of ``texts``."""
    xs, ys, chain_pairs, skip_pairs = [], [], [], []
    for text in texts:
        tokens = candidates(text)
        if not tokens:
            continue
        y = _labels(tokens, base_spans(text))
        chain, skip = _links(text, tokens)
        xs.append(_features(text, tokens))
        ys.append(y)
        chain_pairs += [(y[i], y[j]) for i, j in chain]
        skip_pairs += [(y[i], y[j]) for i, j in skip]
    n_features = len(_features("1", [(0, 1)])[0])
    if not xs:
        return Field(np.zeros((n_features, len(LABELS))), np.zeros((5, 5)), np.zeros((5, 5)))
    x, y = np.concatenate(xs), np.concatenate(ys)
    node, target = np.zeros((n_features, len(LABELS))), np.eye(len(LABELS))[y]
    speed = np.zeros_like(node)
    for _ in range(steps):
        z = x @ node
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed + x.T @ (target - p) / len(x) - 1e-4 * node
        node = node + 0.3 * speed
    return Field(node, _agreement(chain_pairs, 1.0), _agreement(skip_pairs, 1.0))


def label(text: str, field: Field) -> tuple[list, list]:
    """(base spans, all spans), each by start, then kind."""
    base = base_spans(text)
    tokens = candidates(text)
    if not tokens:
        return base, base
    belief = field.marginals(_features(text, tokens), *_links(text, tokens))
    best = belief.argmax(axis=1)
    added, last, in_base = [], -1, _first_overlap(base)
    for i, (start, end) in enumerate(tokens):
        piece = text[start:end]
        start += len(piece) - len(piece.lstrip("#*$%&|<>\"'=,;:!?.[]{}"))
        end -= len(piece) - len(piece.rstrip("#*$%&|<>\"'=,;:!?.[]{}"))
        sure = best[i] and belief[i, best[i]] >= SURE and start < end
        if not sure or in_base(start, end):
            continue
        kind = LABELS[best[i]]
        if added and last == i - 1 and added[-1][2] == kind and tokens[i][0] - tokens[i - 1][1] <= 1:
            added[-1] = (added[-1][0], end, kind)
        else:
            added.append((start, end, kind))
        last = i
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def compact(text: str) -> str:
    """What the fit reads of a text: its candidate tokens, side by side where they are so."""
    out, end = [], None
    for start, stop in candidates(text):
        out += [" " if end is not None and start - end <= 1 else "\n\n", text[start:stop]]
        end = stop
    return "".join(out)


def fit_sample(docs: DataFrame, text_col: str = "text", max_fit: int = MAX_FIT) -> Field:
    """Field fitted on ``max_fit`` texts at most: of the texts that have candidates, and no more than
    ``MAX_FIT_TOKENS`` of them with ``MAX_FIT_CHARS`` characters, those of the smallest hashes, equal
    ones once. Texts without candidates make no difference, however many there are."""
    def compacted(batches):
        for batch in batches:
            for part in text_portions(batch.column(0)):
                held = [compact(t) for t in part if 0 < len(candidates(t)) <= MAX_FIT_TOKENS]
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["t"])

    texts = docs.select(text_col).mapInArrow(compacted, "t string").where(F.length("t") <= MAX_FIT_CHARS).distinct()
    texts = materialise(texts.withColumn("order", F.bitwise_not(F.xxhash64(F.lit(9), "t"))), "fit-texts")
    cut = kth_largest(texts, "order", max_fit)
    chosen = texts if cut is None else texts.where(F.col("order") >= F.lit(cut))
    # rows whose hashes tie with the last are few; the limit makes the bound certain
    found = [r.t for r in chosen.orderBy(F.desc("order"), "t").limit(max_fit).toLocalIterator()]
    discard(texts)
    return fit(sorted(found))


def find_personal_data(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_spans`` and ``spans``
    (kind:start:end by start, joined by commas)."""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(field or fit_sample(docs, text_col))

    def found(batch):
        both = [label(t, shared.value) for t in texts_of(batch.column(at))]
        counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in both], pa.int64()) for kind in KINDS]
        return counts + [pa.array([joined(base) for base, _ in both], pa.string()),
                         pa.array([joined(spans) for _, spans in both], pa.string())]

    fields = [T.StructField(fresh(docs, f"n_{kind}"), T.LongType()) for kind in KINDS]
    return add_columns(docs, found, fields + [T.StructField(fresh(docs, "base_spans"), T.StringType()),
                                              T.StructField(fresh(docs, "spans"), T.StringType())])
