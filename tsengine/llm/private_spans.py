"""Personal data: fixed patterns, and spans added by a semi-Markov CRF.

The base patterns find e-mail addresses, IP numbers, card numbers and phone
numbers in the whole text; each search is linear in the text.

The semi-Markov conditional random field works on the stretches of words that
hold a digit or an ``@`` (nothing else can be an entity).  A stretch is cut
into atoms; every run of up to ``MAX_ATOMS`` atoms is a candidate entity of
every kind, scored by features of the whole span (shape, digits, separators,
checks, neighbours).  Bounded-length dynamic programming (forward-backward for
training and for a span's probability, Viterbi for the boundaries and kinds)
covers a stretch by entities and single outside atoms.  It runs over a stretch
of any length in blocks of ``BLOCK_ATOMS``: per atom only a cut, the forward,
backward and Viterbi values stay, and the scores of one block at a time (a
stretch of several blocks scores them again on the way back).  It is trained
here, by gradient ascent on the likelihood of base spans, on stretches from at most
``SAMPLE_DOCS`` documents and at most ``SAMPLE_STRETCHES`` of them, taken in
the order of a hash of the key.  A decoded span of probability ``least`` or
more that overlaps no base span is added.

Edge cases: a null or empty text has no spans; null or repeated keys are kept
row by row; a sample without entities adds nothing; other columns are ignored
(``redact`` keeps them).
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import defaultdict
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import keyed_text, text_slices

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 16
BLOCK_ATOMS = 1_024
SAMPLE_DOCS = 20_000
SAMPLE_STRETCHES = 1_500
EPOCHS = 12
LEAST = 0.9
SCHEMA = "key long, spans array<struct<kind:string,start:int,end:int,base:boolean,p:double>>"

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile("[0-9@]")
_STRETCH = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]{0,3}+[0-9@]\S*+)*+")
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that pass its check."""
    if not _ANY.search(text):
        return []
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# ------------------------------------------------------------- the model

def stretches(text: str):
    """(start, text) of the runs of words that hold a digit or an ``@``."""
    for m in _STRETCH.finditer(text):
        yield m.start(), m[0]


def _side(c: str) -> str:
    return "^" if not c else "s" if c.isspace() else "d" if c.isdigit() else "a" if c.isalpha() else c


def span_features(text: str, left: str, right: str) -> list[str]:
    """Features of a whole candidate span, the same for every kind."""
    digits = "".join(c for c in text if "0" <= c <= "9")
    shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", lambda m: f"9{min(len(m[0]), 5)}", text))
    rough = re.sub("(?:a|9[1-5])(?:(?:a|9[1-5])|[._%+-](?=[a9]))*", "w", shape)
    parts = text.split(".")
    octets = len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)
    checked = 16 <= len(digits) <= 19 and digits.isascii() and luhn(digits) and not set(text) - set("0123456789 -")
    return [f"shape={shape[:40]}", f"rough={rough[:24]}", f"digits={min(len(digits), 20)}",
            f"marks={''.join(sorted(set(text) - set(digits)))[:8] if not any(c.isalpha() for c in text) else 'a'}",
            f"at={text.count('@')}.{'.' in text.rpartition('@')[2]}", f"octets={octets}", f"luhn={checked}",
            f"plus={text[:1] == '+'}", f"left={_side(left)}", f"right={_side(right)}", "bias"]


def candidates(text: str, cuts, i: int, before: str, after: str):
    """(end, features) of the entities that may start at atom ``i``."""
    n = len(cuts) - 1
    first = text[cuts[i]]
    if not (first.isalnum() or first in "+(_"):
        return
    for j in range(i + 1, min(n, i + MAX_ATOMS) + 1):
        span = text[cuts[i]:cuts[j]]
        if not (span[-1].isalnum() or span[-1] == ")") or not ("@" in span or sum(c.isdigit() for c in span) >= 4):
            continue
        yield j, span_features(span, text[cuts[i] - 1] if i else before, text[cuts[j]] if j < n else after)


class Lattice:
    """A whole (short) stretch with its candidate spans: edges (i, j, kind, features)."""

    def __init__(self, text: str, before: str = "", after: str = ""):
        cut = [m.end() for m in _ATOM.finditer(text)]
        self.cuts = [0, *cut]
        self.edges: list[tuple[int, int, str, list[str]]] = []
        n = len(cut)
        for i in range(n):
            self.edges.append((i, i + 1, "", [f"out={_side(text[self.cuts[i]])}"]))
            for j, feats in candidates(text, self.cuts, i, before, after):
                self.edges.extend((i, j, k, [f"{k}:{f}" for f in feats]) for k in KINDS)
        self.size = n

    def scores(self, w: dict) -> list[float]:
        return [sum(w.get(f, 0.0) for f in feats) for _, _, _, feats in self.edges]

    def marginals(self, w: dict) -> tuple[list[float], list[float]]:
        """(probability of each edge, its score): forward-backward."""
        s = self.scores(w)
        fwd, bwd = [float("-inf")] * (self.size + 1), [float("-inf")] * (self.size + 1)
        fwd[0] = bwd[self.size] = 0.0
        for (i, j, _, _), x in zip(self.edges, s):        # edges are in order of their start
            fwd[j] = _add(fwd[j], fwd[i] + x)
        for (i, j, _, _), x in zip(reversed(self.edges), reversed(s)):
            bwd[i] = _add(bwd[i], x + bwd[j])
        z = fwd[self.size]
        return [exp(min(0.0, fwd[i] + x + bwd[j] - z)) for (i, j, _, _), x in zip(self.edges, s)], s

    def decode(self, w: dict) -> list[tuple[str, int, int, float]]:
        """The best cover's entities: (kind, start, end, probability)."""
        p, s = self.marginals(w)
        best, back = [0.0] + [float("-inf")] * self.size, [None] * (self.size + 1)
        for e, ((i, j, _, _), x) in enumerate(zip(self.edges, s)):
            if best[i] + x > best[j]:
                best[j], back[j] = best[i] + x, e
        out, at = [], self.size
        while at:
            e = back[at]
            i, j, kind, _ = self.edges[e]
            if kind:
                out.append((kind, self.cuts[i], self.cuts[j], p[e]))
            at = i
        return out[::-1]


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == float("-inf") else a + log(1.0 + exp(b - a))


def by_kind(w: dict) -> dict:
    """The weights of each span feature for all kinds, and of the outside features."""
    out: dict = {}
    for name, x in w.items():
        kind, _, feature = name.partition(":")
        if kind in KINDS:
            out.setdefault(feature, [0.0] * len(KINDS))[KINDS.index(kind)] = x
        else:
            out[name] = x
    return out


def decode(text: str, before: str, after: str, weights: dict) -> list[tuple[str, int, int, float]]:
    """``Lattice.decode`` of a stretch of any length; ``weights``: from ``by_kind``."""
    cuts = array("i", [0])
    cuts.extend(m.end() for m in _ATOM.finditer(text))
    n, none = len(cuts) - 1, (0.0,) * len(KINDS)

    def edges(lo: int) -> list[tuple[int, int, int, float]]:
        """(start, end, kind or -1, score) of a block's edges, in order of their start."""
        out = []
        for i in range(lo, min(n, lo + BLOCK_ATOMS)):
            out.append((i, i + 1, -1, weights.get(f"out={_side(text[cuts[i]])}", 0.0)))
            for j, feats in candidates(text, cuts, i, before, after):
                per_kind = zip(*[weights.get(f, none) for f in feats])
                out.extend((i, j, k, sum(x)) for k, x in enumerate(per_kind))
        return out

    low = float("-inf")
    fwd, best = array("d", [0.0]) + array("d", [low]) * n, array("d", [0.0]) + array("d", [low]) * n
    step, kind = array("b", [0]) * (n + 1), array("b", [-1]) * (n + 1)
    block: list = []
    for lo in range(0, n, BLOCK_ATOMS):
        block = edges(lo)
        for i, j, k, x in block:
            fwd[j] = _add(fwd[j], fwd[i] + x)
            if best[i] + x > best[j]:
                best[j], step[j], kind[j] = best[i] + x, j - i, k
    out, at = [], n                      # the best cover's entities, last first
    while at:
        if kind[at] >= 0:
            out.append((at - step[at], at, kind[at]))
        at -= step[at]
    if not out:
        return []
    bwd, z, p, done = array("d", [low]) * n + array("d", [0.0]), fwd[n], [], 0
    for lo in range((n - 1) // BLOCK_ATOMS * BLOCK_ATOMS, -1, -BLOCK_ATOMS):
        for i, j, k, x in reversed(block if lo + BLOCK_ATOMS >= n else edges(lo)):
            bwd[i] = _add(bwd[i], x + bwd[j])
            if done < len(out) and out[done] == (i, j, k):
                p.append(exp(min(0.0, fwd[i] + x + bwd[j] - z)))
                done += 1
    return [(KINDS[k], cuts[i], cuts[j], x) for (i, j, k), x in zip(reversed(out), reversed(p))]


def train(sample: list[tuple[str, str, str]], epochs: int = EPOCHS, rate: float = 0.5) -> dict:
    """Weights from (stretch, character before, after), the stretch's base
    spans being the truth; AdaGrad on the log likelihood, fixed order."""
    data = []
    for text, before, after in sample:
        lat = Lattice(text, before, after)
        gold, taken = set(), 0
        for kind, a, b in sorted(base_spans(text), key=lambda x: (x[1], -x[2])):
            if a >= taken and a in lat.cuts and b in lat.cuts:
                gold.add((lat.cuts.index(a), lat.cuts.index(b), kind))
                taken = b
        covered = {k for i, j, _ in gold for k in range(i, j)}
        data.append((lat, [(i, j, k) in gold if k else i not in covered for i, j, k, _ in lat.edges]))
    w: dict = {}
    norm: dict = defaultdict(lambda: 1e-6)
    for _ in range(epochs):
        for lat, truth in data:
            grad: dict = defaultdict(float)
            for (_, _, _, feats), p, t in zip(lat.edges, lat.marginals(w)[0], truth):
                if abs(t - p) > 1e-4:
                    for f in feats:
                        grad[f] += t - p
            for f, g in grad.items():
                norm[f] += g * g
                w[f] = w.get(f, 0.0) * (1 - 1e-4) + rate * g / norm[f] ** 0.5
    return w


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> dict:
    """Train on a bounded sample of the documents."""
    rows = keyed_text(docs, key, text)
    share = max(1, -(-docs.count() // SAMPLE_DOCS))
    order = F.xxhash64("key", "text")
    rows = rows.where(F.pmod(order, F.lit(share)) == 0).where(F.col("text").rlike("[0-9@]"))

    def run(batches):
        for b in text_slices(batches):
            out = []
            for t in b.column("text").to_pylist():
                for at, s in stretches(t):
                    if len(s) <= 200:
                        out.append((s, t[at - 1:at], t[at + len(s):at + len(s) + 1]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*out)] if out else
                                             [pa.array([], pa.string())] * 3, names=["s", "before", "after"])

    found = rows.mapInArrow(run, "s string, before string, after string")
    sample = found.orderBy(F.xxhash64("s", "before", "after"), "s", "before", "after").limit(SAMPLE_STRETCHES).collect()
    return train([(r.s, r.before, r.after) for r in sample])


def find_spans(text: str, weights: dict, least: float = LEAST,
               table: dict | None = None) -> list[tuple[str, int, int, bool, float]]:
    """Base spans, then the model's additions, by kind and place.  ``table``:
    ``by_kind(weights)``, for callers with many texts."""
    if not _ANY.search(text):
        return []
    table = by_kind(weights) if table is None else table
    base = base_spans(text)
    out = [(k, a, b, True, 1.0) for k, a, b in base]
    starts, ends = array("q"), array("q")            # what the base spans cover, disjoint
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for at, s in stretches(text):
        for kind, a, b, p in decode(s, text[at - 1:at], text[at + len(s):at + len(s) + 1], table):
            near = bisect_right(starts, at + b - 1) - 1          # the last to start before the entity's end
            if p >= least and (near < 0 or ends[near] <= at + a):
                out.append((kind, at + a, at + b, False, p))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def _spans(weights: dict, least: float):
    def run(batches):
        table = by_kind(weights)
        for b in text_slices(batches):
            rows = [[dict(zip(("kind", "start", "end", "base", "p"), s)) for s in find_spans(t, weights, least, table)]
                    for t in b.column("text").to_pylist()]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                       ("base", pa.bool_()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(rows, kind)], names=["key", "spans"])
    return run


def detect(docs: DataFrame, weights: dict, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """One row a document: its spans in code points, end exclusive."""
    return keyed_text(docs, key, text).mapInArrow(_spans(weights, least), SCHEMA).withColumnRenamed("key", key)


def mask(text: str, spans) -> str:
    """Each stretch of (overlapping) spans becomes its first span's kind in brackets."""
    out, at = [], 0
    for kind, a, b, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, weights: dict, text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with the spans of ``text`` masked; null stays null."""
    names = docs.columns

    def run(batches):
        table = by_kind(weights)
        for b in text_slices(batches, text):
            new = [None if t is None else mask(t, find_spans(t, weights, least, table)) for t in b.column(text).to_pylist()]
            cols = {n: b.column(n) for n in names} | {text: pa.array(new, pa.string())}
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return docs.mapInArrow(run, docs.schema)
