"""Token counts by section from one encoding of the whole document.

A document is encoded once by a public byte-level tokenizer.  Token byte
lengths give every token's byte span (the tokens of a text spell its UTF-8
bytes), spans and sections are joined as sorted intervals, and a token that
crosses a section's edge is allotted by an explicit rule:

* ``start``: to the section that holds its first byte;
* ``largest``: to the section that holds most of its bytes, the earlier on a tie;
* ``split``: to each section by its share of the token's bytes.

Sections are a document's lines (each with its newline), or spans given in a
column ``array<struct<start,end>>`` of byte offsets, sorted and disjoint; then
bytes of no section count for section -1.

Edge cases: a null or empty text has no tokens and no sections; empty sections
get 0 tokens; null or repeated keys are kept row by row; null sections count
as none; other columns are ignored.  Texts of any length and with runs of any
length are read whole: a long run of white space is encoded without the
tokenizer's expression, which backtracks over it, at the places where that
expression would cut (``encode_whole``).
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.llm._common import keyed_text, text_slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RULES = ("start", "largest", "split")
SCHEMA = "key long, n_tokens long, n_bytes long, sections array<struct<start:long,end:long,tokens:double>>"
LONG_RUN = 10_000
# Unicode's white space.
_WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_encoders: dict = {}


def encoder(path: str):
    """(tiktoken encoding, byte length of each id), made once a process."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            size[rank] = len(piece)
        _encoders[path] = (tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                             special_tokens={}), size)
    return _encoders[path]


def encode_whole(encoding, texts: list[str]) -> list[list[int]]:
    """Token ids of every text.

    The tokenizer takes a run of white space whole if it ends the text, else
    without its last character, which goes with what follows.  Runs of
    ``LONG_RUN`` characters or more are cut there beforehand and encoded as the
    one piece that they are.
    """
    run = re.compile(f"[{_WHITE}]{{{LONG_RUN},}}")
    cuts = {i: found for i, t in enumerate(texts) if len(t) >= LONG_RUN and (found := list(run.finditer(t)))}
    ids = encoding.encode_ordinary_batch(["" if i in cuts else t for i, t in enumerate(texts)], num_threads=1)
    for i, found in cuts.items():
        text, at = texts[i], 0
        for m in found:
            end = m.end() - (m.end() < len(text))
            ids[i] += encoding.encode_ordinary(text[at:m.start()])
            ids[i] += encoding._encode_single_piece(text[m.start():end])
            at = end
        ids[i] += encoding.encode_ordinary(text[at:])
    return ids


def line_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    if len(raw) and (not len(ends) or ends[-1] != len(raw)):
        ends = np.append(ends, len(raw))
    return np.concatenate([np.zeros(min(len(ends), 1), np.int64), ends[:-1]]), ends


def allot(ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, float]:
    """Tokens of each section and outside all, from token end offsets."""
    out, rest = np.zeros(len(lo)), 0.0
    if not len(ends):
        return out, rest
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    first = np.searchsorted(hi, starts, "right")           # first section that ends behind the token's start
    last = np.searchsorted(lo, ends, "left") - 1           # last section that starts before the token's end
    if rule == "start":
        held = (first < len(lo)) & (lo[np.minimum(first, len(lo) - 1)] <= starts) if len(lo) else np.zeros(len(ends), bool)
        return np.bincount(first[held], minlength=len(lo)).astype(float), float((~held).sum())
    inside = (last == first) & (lo[np.minimum(first, len(lo) - 1)] <= starts) & (hi[np.minimum(first, len(lo) - 1)] >= ends) \
        if len(lo) else np.zeros(len(ends), bool)
    out += np.bincount(first[inside], minlength=len(lo))
    for t in np.flatnonzero(~inside).tolist():             # the few tokens at an edge
        s = np.arange(first[t], last[t] + 1)
        share = np.minimum(hi[s], ends[t]) - np.maximum(lo[s], starts[t])
        width = ends[t] - starts[t]
        if rule == "split":
            out[s] += share / width
            rest += 1 - share.sum() / width
        elif len(s) and share.max() >= width - share.sum():
            out[s[int(share.argmax())]] += 1
        else:
            rest += 1
    return out, rest


def _count(path: str, rule: str):
    def run(batches):
        encoding, size = encoder(path)
        for b in text_slices(batches):
            given = b.column("spans").to_pylist() if "spans" in b.schema.names else None
            texts = b.column("text").to_pylist()
            out = []
            for i, (text, ids) in enumerate(zip(texts, encode_whole(encoding, texts))):
                raw = text.encode()
                ends = np.cumsum(size[np.array(ids, np.int64)])
                if given is None:
                    lo, hi = line_bounds(raw)
                else:
                    spans = given[i] or []
                    lo, hi = np.array([s["start"] for s in spans], np.int64), np.array([s["end"] for s in spans], np.int64)
                n, rest = allot(ends, lo, hi, rule)
                if rest:
                    lo, hi, n = np.append(lo, -1), np.append(hi, -1), np.append(n, rest)
                out.append((len(ids), len(raw), lo, hi, n))
            counts = [len(x[2]) for x in out]
            flat = [np.concatenate([x[j] for x in out]) for j in (2, 3, 4)]
            sections = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)),
                                            pa.array(flat[2].astype(float))], names=["start", "end", "tokens"]))
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                 sections], names=["key", "n_tokens", "n_bytes", "sections"])
    return run


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", sections: str | None = None,
                 rule: str = "largest", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row a document: its tokens, bytes and sections with their tokens
    (section (-1, -1): tokens outside all).  The sections' tokens add up."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    more = {"spans": docs[sections].cast("array<struct<start:long,end:long>>")} if sections else {}
    rows = keyed_text(docs, key, text, **more)
    return rows.mapInArrow(_count(vocabulary, rule), SCHEMA).withColumnRenamed("key", key)


def by_section(counted: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row a section: ``key, section, start, end, tokens``."""
    return counted.select(F.col(key), "n_tokens", F.posexplode("sections").alias("section", "s")) \
        .select(key, "section", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                F.col("s.tokens").alias("tokens"))
