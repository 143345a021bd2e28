"""Sampled SentencePiece segmentations and their lossless decoding.

The pieces of a public vocabulary file span a lattice over the text (a space
is the piece mark, with one mark put before the text, taken off in decoding).
Forward filtering gives every lattice place the probability of its incoming
pieces; backward sampling draws one path from the end.  A draw depends only on
the row's key, the seed and the place in the text, so a rerun, other batches or
other partitions give the same segmentation.

The vocabulary file ranks its pieces but gives no probabilities; a piece of
rank r weighs ``(1 / ((r + 1) H)) ** alpha`` (Zipf, H the harmonic number).  A
character outside the vocabulary, and the mark itself when the text holds it,
becomes its UTF-8 byte pieces, so decoding restores every text.

No piece crosses from a non-mark to a mark, so the lattice falls into chunks
(marks and what follows); a process keeps the tables of the chunks it has seen.

Edge cases: a null text gives null pieces, an empty one an empty list; a null
key draws with a fixed key; repeated rows get equal results; other columns
stay as they are (one named like an output column is replaced).
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tsengine.llm._common import _MIXERS, forget_hashes, give_back, mix64, text_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 1 << 20
KEPT_BYTES = 24 << 20     # of chunk tables that a process keeps; then it starts anew
MARK, RAW_MARK = 0x2581, 0x110000
_CHUNK = re.compile(" +[^ \n]*|\n+[^ \n]*")
_vocabularies: dict = {}


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        byte = [sp.is_byte(i) for i in range(self.size)]
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(self.size)]
        self.byte_ids = np.zeros(256, np.int32)
        raw = []
        for i, name in enumerate(names):
            if byte[i]:
                value = int(name[3:5], 16)
                self.byte_ids[value] = i
                raw.append(bytes([value]))
            else:
                raw.append(b"" if special[i] else name.replace("▁", " ").encode())
        self.raw_len = np.array([len(x) for x in raw], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.names = names
        self.ordinary = [i for i in range(self.size) if not byte[i] and not special[i]]

    def lattice_tables(self) -> None:
        """The trie of the pieces and their weights; only encoding needs them."""
        names = self.names
        if any(re.search("[^▁]▁|.\n|\n.", n) for n in names):
            raise ValueError("a piece crosses a chunk's edge")
        harmonic = float(np.sum(1.0 / np.arange(1, self.size + 1)))
        edges: dict[int, int] = {}      # node and character in one number -> node
        ends = np.empty(len(self.ordinary), np.int64)
        for rank, i in enumerate(self.ordinary):
            node = 0
            for c in names[i]:
                node = edges.setdefault(node << 21 | ord(c), len(edges) + 1)
            ends[rank] = node
        self.byte_weight = -np.log(self.size * harmonic)
        count = len(edges)
        key = np.fromiter(edges.keys(), np.int64, count)
        to = np.fromiter(edges.values(), np.int64, count)
        del edges
        self._table(key, to)
        self.piece = np.full(count + 1, -1, np.int32)
        self.weight = np.zeros(count + 1)
        self.piece[ends] = self.ordinary
        self.weight[ends] = -np.log(np.arange(1, len(ends) + 1) * harmonic)
        self.names = None               # a task decodes from bytes
        give_back()

    def _table(self, key: np.ndarray, to: np.ndarray) -> None:
        """The trie's edges as a hash table with linear probing."""
        size = 1 << int(np.ceil(np.log2(max(len(key), 1) * 4)))
        self.shift = np.uint64(64 - int(np.log2(size)))
        self.keys, self.to = np.full(size + 64, -1, np.int64), np.zeros(size + 64, np.int32)
        for k, t, at in zip(key.tolist(), to.tolist(), self._slot(key).tolist()):
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.to[at] = k, t

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _MIXERS[7]) >> self.shift).astype(np.int64)

    def follow(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie node behind each (node, character), or -1."""
        key = node.astype(np.int64) << 21 | char
        at = self._slot(key)
        seen = self.keys[at]
        out = np.where(seen == key, self.to[at], np.int32(-1))
        open_ = np.flatnonzero((seen != key) & (seen >= 0))
        while len(open_):
            at[open_] += 1
            seen = self.keys[at[open_]]
            hit = seen == key[open_]
            out[open_[hit]] = self.to[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out


def vocabulary(path: str, encoding: bool = False) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    if encoding and not hasattr(_vocabularies[path], "weight"):
        _vocabularies[path].lattice_tables()
    return _vocabularies[path]


def lattice(v: Vocabulary, chunks: list[str], alpha: float):
    """Incoming pieces of every place of the chunks: (first place of each
    chunk, its length, where each place's pieces begin, their cumulative
    probabilities, the places they start at, piece ids)."""
    code = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int32)
    code = np.where(code == MARK, RAW_MARK, np.where(code == 32, MARK, code))
    size = np.array([len(c) for c in chunks], np.int32)
    end_of = np.repeat(np.cumsum(size, dtype=np.int32), size)
    place, node = np.arange(len(code), dtype=np.int32), np.zeros(len(code), np.int32)
    starts, ends, pieces, weights = [], [], [], []
    single = np.zeros(len(code), bool)
    step = 0
    while len(place):
        at = place + np.int32(step)
        inside = np.flatnonzero(at < end_of[place])
        place, node = place[inside], v.follow(node[inside], code[at[inside]])
        hit = np.flatnonzero(node >= 0)
        place, node = place[hit], node[hit]
        piece = v.piece[node]
        real = np.flatnonzero(piece >= 0)
        starts.append(place[real])
        ends.append(starts[-1] + np.int32(step + 1))
        pieces.append(piece[real])
        weights.append(v.weight[node[real]])
        if not step:
            single[starts[-1]] = True
        step += 1
    lone = np.flatnonzero(~single).astype(np.int32)
    char = np.where(code[lone] == RAW_MARK, np.int32(MARK), code[lone])
    starts.append(lone)
    ends.append(lone + np.int32(1))
    pieces.append(char + np.int32(v.size))
    weights.append(v.byte_weight * _utf8_len(char))
    start, end = np.concatenate(starts), np.concatenate(ends)
    piece, weight = np.concatenate(pieces), np.concatenate(weights) * alpha
    order = np.argsort(end, kind="stable")               # a few sorted runs: cheap
    start, end, piece, weight = start[order], end[order], piece[order], weight[order]
    first = np.cumsum(size, dtype=np.int32) - size
    slot = np.repeat(np.arange(len(size), dtype=np.int32), size)         # a chunk of n characters has n + 1 places
    from_slot, to_slot = start + slot[start], end + slot[start]
    head = np.flatnonzero(np.concatenate([np.ones(1, bool), to_slot[1:] != to_slot[:-1]]))
    width = np.diff(np.append(head, len(to_slot)))
    # forward: places in order of their distance from the chunk's start
    far = end[head] - first[slot[start[head]]]
    longest = int(far.max(initial=0))
    turn = np.argsort(far.astype(np.int16) if longest < 2**15 else far, kind="stable")
    bounds = np.searchsorted(far[turn], np.arange(1, longest + 2))
    alpha_log = np.zeros(len(code) + len(chunks))
    probability = np.empty(len(start))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        which = turn[lo:hi]
        n = width[which]
        at = np.cumsum(n) - n
        edge = np.repeat(head[which] - at, n) + np.arange(int(n.sum()))
        score = alpha_log[from_slot[edge]] + weight[edge]
        top = np.maximum.reduceat(score, at)
        share = np.exp(score - np.repeat(top, n))
        total = np.add.reduceat(share, at)
        alpha_log[to_slot[head[which]]] = top + np.log(total)
        probability[edge] = share / np.repeat(total, n)
    run = np.cumsum(probability)
    share = run - np.repeat(run[head] - probability[head], width)
    share[head + width - 1] = 2.0                        # the last piece takes what rounding leaves
    where = np.zeros(len(alpha_log), np.int32)
    where[to_slot[head]] = head
    return first + np.arange(len(size), dtype=np.int32), size, where, share, from_slot, piece


class _Column:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.n = np.empty(1 << 12, dtype), 0

    def extend(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.room):
            room = np.empty((self.n + len(x)) * 5 // 4, self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:self.n + len(x)] = x
        self.n += len(x)


class Tables:
    """Lattices of the chunks seen so far, found by the chunk's number."""

    def __init__(self, v: Vocabulary, alpha: float):
        self.v, self.alpha = v, alpha
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.first, self.size, self.where, self.start, self.piece = (_Column(np.int32) for _ in range(5))
        self.share = _Column(np.float64)

    def held(self) -> int:
        """Bytes of the tables; a chunk's text and number take about 120 more."""
        columns = (self.first, self.size, self.where, self.start, self.piece, self.share)
        return sum(c.room.nbytes for c in columns) + 120 * len(self.ids)

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(chunk numbers of all texts, chunks of each text); unknown chunks are added."""
        if self.held() > KEPT_BYTES:
            self.clear()
        ids, known = self.ids, len(self.ids)
        found, counts = [], []
        for t in texts:
            c = _CHUNK.findall(" " + t) if t else []
            found.extend([ids.setdefault(x, len(ids)) for x in c])
            counts.append(len(c))
        if len(ids) > known:
            first, size, where, share, start, piece = lattice(self.v, list(islice(ids, known, None)), self.alpha)
            places, edges = np.int32(self.where.n), np.int32(self.piece.n)
            for column, new in ((self.first, first + places), (self.size, size), (self.where, where + edges),
                                (self.start, start + places), (self.piece, piece), (self.share, share)):
                column.extend(new)
        return np.array(found, np.int32), np.array(counts, np.int64)


def _utf8_len(char: np.ndarray) -> np.ndarray:
    return 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)


def _byte_pieces(v: Vocabulary, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace stand-ins for characters by byte pieces; (pieces, width of each old one)."""
    stand = out >= v.size
    width = np.where(stand, _utf8_len(np.maximum(out - v.size, 0)), 1)
    at = np.cumsum(width) - width
    flat = np.empty(int(width.sum()), np.int32)
    flat[at[~stand]] = out[~stand]
    for i in np.unique(out[stand]).tolist():
        where = at[out == i]
        for k, byte in enumerate(chr(i - v.size).encode()):
            flat[where + k] = v.byte_ids[byte]
    return flat, width


def sample(tables: Tables, texts: list[str], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(pieces of all texts, offsets by text)."""
    v = tables.v
    chunk, counts = tables.number(texts)
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    if not len(chunk):
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    where, share, start, piece = (c.room for c in (tables.where, tables.share, tables.start, tables.piece))
    row_seed = mix64(keys.view(np.uint64) * _MIXERS[8] + np.uint64(seed))
    number = (np.arange(len(chunk)) - np.repeat(at[:-1], counts)).astype(np.uint64)
    chunk_seed = mix64(np.repeat(row_seed, counts) + number * _MIXERS[9])
    live = np.arange(len(chunk), dtype=np.int32)
    origin = tables.first.room[chunk]
    place = origin + tables.size.room[chunk]
    drawn, length, step = [], np.zeros(len(chunk), np.int32), 0
    while len(live):
        turn = np.uint64(step * int(_MIXERS[10]) % 2**64)
        u = (mix64(chunk_seed[live] + turn) >> np.uint64(11)) * 2.0**-53
        e = where[place[live]]
        behind = np.flatnonzero(share[e] <= u)
        while len(behind):
            e[behind] += 1
            behind = behind[share[e[behind]] <= u[behind]]
        drawn.append((live, piece[e]))
        back_to = start[e]
        place[live] = back_to
        length[live] += 1
        live = live[back_to > origin[live]]
        step += 1
    last = np.cumsum(length, dtype=np.int64) - 1
    out = np.empty(int(length.sum()), np.int32)
    for back, (who, what) in enumerate(drawn):
        out[last[who] - back] = what
    flat, width = _byte_pieces(v, out)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(width)])
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])[at]
    return flat, ends[offsets]


def spell(v: Vocabulary, pieces: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The texts' bytes, without the leading mark."""
    width = v.raw_len[pieces]
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(width)])
    raw = v.raw[np.repeat(v.raw_at[pieces] - at[:-1], width) + np.arange(at[-1])].tobytes()
    cut = at[offsets].tolist()
    return [raw[a + 1:b] for a, b in zip(cut[:-1], cut[1:])]


def _encode(path: str, key: str, text: str, out: str, decoded: str | None, names: list[str], alpha: float, seed: int):
    def run(batches):
        forget_hashes()         # of an earlier stage: Spark keeps its Python workers
        tables = Tables(vocabulary(path, encoding=True), alpha)
        for b in text_slices(batches, text, SLICE):
            texts = b.column(text)
            keys = b.column(key).cast(pa.int64()).fill_null(-1).to_numpy()
            flat, offsets = sample(tables, texts.fill_null("").to_pylist(), keys, seed)
            null = np.append(texts.is_null().to_numpy(zero_copy_only=False), False)
            pieces = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), mask=null), pa.array(flat))
            cols = {n: b.column(n) for n in b.schema.names} | {out: pieces}
            if decoded:
                cols[decoded] = _restored(tables.v, flat, offsets, null[:-1])
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)
    return run


def _restored(v: Vocabulary, flat: np.ndarray, offsets: np.ndarray, null: np.ndarray) -> pa.Array:
    texts = spell(v, flat.astype(np.int64), offsets)
    return pa.array([None if x else t.decode("utf-8", "replace") for t, x in zip(texts, null)], pa.string())


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "pieces", alpha: float = 1.0,
           seed: int = 17, model: str = MODEL, decoded: str | None = None) -> DataFrame:
    """``df`` with a column ``out`` of sampled piece ids and, if ``decoded``
    names one, a column of the text these ids spell (``decode`` in the same task)."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in (out, decoded)])
    schema = schema.add(out, T.ArrayType(T.IntegerType(), False))
    if decoded:
        schema = schema.add(decoded, T.StringType())
    return df.mapInArrow(_encode(model, key, text, out, decoded, schema.names, alpha, seed), schema)


def _decode(path: str, pieces: str, out: str, names: list[str]):
    def run(batches):
        v = vocabulary(path)
        for big in batches:
            for i in range(0, big.num_rows, 1000):
                b = big.slice(i, 1000)
                col = b.column(pieces)
                n = pc.list_value_length(col).fill_null(0).to_numpy(zero_copy_only=False)
                decoded = _restored(v, col.flatten().to_numpy(zero_copy_only=False),
                                    np.concatenate([np.zeros(1, np.int64), np.cumsum(n)]),
                                    col.is_null().to_numpy(zero_copy_only=False))
                cols = {c: b.column(c) for c in b.schema.names if c != out}
                yield pa.RecordBatch.from_arrays([cols.get(c, decoded) for c in names], names=names)
    return run


def decode(df: DataFrame, pieces: str = "pieces", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with a column ``out``: the text the pieces spell."""
    schema = T.StructType([f for f in df.schema.fields if f.name != out]).add(out, T.StringType())
    return df.mapInArrow(_decode(model, pieces, out, schema.names), schema)
