"""Language-model scores: a probabilistic suffix tree over characters, beside a smoothed unigram base.

Tokens are the words of a text, A-Z lower-cased, and one end.  The tree models the same tokens letter by
letter: each word's UTF-8 bytes and a space, then an end sign, so its probabilities of token sequences add up to one.

Learning.  One pass over all texts cuts them into slices of at most about ``SLICE_SYMBOLS`` symbols or ``FLUSH`` different strings of
``DEPTH`` bytes of history with the next byte.  A slice keeps its texts once, and its distinct strings and its distinct tokens with their
counts in training texts, packed into blocks, about ``BLOCK_BYTES`` of text each: strings whose newest ``KEY_DEPTH`` bytes of history
agree share a block, and tokens of equal hash.  A context (the last
1 to DEPTH bytes, which may begin with the text's start) is retained if it was seen ``MIN_COUNT`` times and its next-byte distribution diverges
from that of the context one byte shorter: count x Kullback-Leibler divergence of at least ``MIN_GAIN`` nats.
All of these stay, with all their suffixes, so the tree grows with the corpus.  A block holds every string of its
contexts, so one shuffle grows all depths from ``KEY_DEPTH`` on: sorted with the newest byte first, a context is a range.  The levels above have few
entries (strings of KEY_DEPTH bytes; 53,000 for 25 MB of text); their sums are collected and broadcast.  Distributions are smoothed
towards the shorter context's (Witten-Bell), at the root towards the uniform one.

Scoring.  A symbol's probability is folded along the retained suffixes of its history, from the root to the longest.
A tree of at most ``BROADCAST_CELLS`` entries is broadcast as sorted tables, in which a task looks up its distinct strings.
A larger tree stays in its blocks, and so do the strings to be looked up: each block folds each of its strings once and answers each
slice, once per longest context and next byte (rounded to 1e-8).  No part of the tree is left out.  For the base, each block
of tokens answers each slice with the counts of its tokens, so a frequent token is sent once per slice.  A second shuffle brings all answers
to the slice's texts.

Defined cases: a NULL or empty text is its end alone; a NULL id is neither learned from nor held out; with
nothing to learn from, base scores follow the formula with N = V = 0 and bytes are uniform; repeated rows count and
are answered each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import spool
from .common import U64, as_batch, fold_of, mix, over_texts, rows_with_number, ship_code, table

DEPTH = 7
MIN_COUNT = 16
MIN_GAIN = 8.0
#: Entries (context and next byte) of a tree that is broadcast.
BROADCAST_CELLS = 3_000_000
END = 10
SPACE = 32
#: Distinct strings, and symbols, of a slice.
FLUSH = 6_000_000
SLICE_SYMBOLS = 32_000_000
#: Strings that a task gathers before it adds them up.
GATHERED = 4_000_000
#: Bytes of text per block of counted strings.
BLOCK_BYTES = 8_000_000
#: Strings go to blocks by the newest KEY_DEPTH bytes of history; the levels above are broadcast.
KEY_DEPTH = 4
#: Answers of blocks are rounded to 1 / FINE in log10.
FINE = 1e8
TOP_DEPTH = KEY_DEPTH - 1
TOP_BYTES = U64((1 << 64) - (1 << 8 * (8 - TOP_DEPTH)) | 255)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
NUL = 255
_LOWER[0] = NUL  # byte 0 marks the absence of history; 255 occurs in no UTF-8


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts (words, each with a space, then the end), and each text's start (plus the end of all)."""
    raw = [(t or "").encode("utf-8") for t in texts]
    data = _LOWER[np.frombuffer(b"\n\n".join(raw) + b"\n\n", np.uint8)]
    last = np.cumsum([len(r) + 2 for r in raw]) - 1
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    keep = ~blank
    keep[1:] |= keep[:-1] & blank[1:]  # the blank after a word
    out = np.where(blank, np.uint8(SPACE), data)
    keep[last] = True
    out[last] = END
    ends = np.cumsum(keep)[last]
    return out[keep], np.concatenate([[0], ends])


def grams(syms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each symbol: it, and up to DEPTH symbols before it back to the text's start, newest in the lowest byte."""
    out = np.concatenate([np.full(DEPTH, END, np.uint8), syms]).astype(np.int64)
    for j in (1, 2, 4):  # strings of twice as many symbols
        out = out[j:] | out[:-j] << (8 * j)
    for p in range(DEPTH - 1):  # the first symbols of a text know fewer: p before them, and the start
        at = starts[:-1] + p
        at = at[at < starts[1:]]
        out[at] &= (1 << (8 * (p + 2))) - 1
    return out


def encoded(raw: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens of some symbols as they first occur (words with their space, ends), which each token is, and where it ends."""
    last = np.flatnonzero((raw == SPACE) | (raw == END))
    offsets = np.concatenate([[0], last + 1]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(last), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), last


def bytes_of(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the tokens, and where each starts (plus the end of all)."""
    offsets = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset:tokens.offset + len(tokens) + 1]
    return np.frombuffer(tokens.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def token_block_of(tokens: pa.Array, blocks: int) -> np.ndarray:
    data, starts = bytes_of(tokens)
    place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    with np.errstate(over="ignore"):
        return _block(np.add.reduceat(mix(data.astype(U64) << U64(40) | place.astype(U64)), starts[:-1]), blocks)


def turned(strings: np.ndarray) -> np.ndarray:
    """Strings (as of ``grams``) with the newest byte of history first and the next byte last: suffixes become prefixes."""
    strings = strings.view(U64)
    return strings.byteswap() << U64(8) | strings & U64(255)


def turned_back(keys: np.ndarray) -> np.ndarray:
    return ((keys >> U64(8)).byteswap() | keys & U64(255)).view(np.int64)


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    newest = keys >> U64(64 - 8 * KEY_DEPTH)
    first = np.flatnonzero(np.concatenate([[True], newest[1:] != newest[:-1]]))[:len(keys)]
    return np.repeat(_block(newest[first], blocks), np.diff(first, append=len(keys)))


def _block(values: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks by hash; as short numbers, which numpy sorts by digits."""
    return (mix(values) % U64(blocks)).astype(np.uint16 if blocks <= 1 << 16 else np.int64)


def _ranges(block: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """An order by block, and the range of each block in it."""
    order = np.argsort(block, kind="stable")
    known, first = np.unique(block[order], return_index=True)
    return order, dict(zip(known.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(block)], strict=True), strict=True))


_SENT = ("kind string, n long, slice long, block long, keys binary, counts binary, row array<long>, doc_id array<long>, "
         "ends array<int>, text binary")


def cut(docs: DataFrame, training: Column | None = None) -> DataFrame:
    """Slices, stored; of three kinds.

    A slice has one row of ``texts`` with its symbols (``n`` is the number of blocks), per block the ``strings`` that occur in them (``keys``,
    in the order of ``turned``) with their numbers in training texts, where block -1 has the strings of the first ``TOP_DEPTH`` levels, and
    per block of another hash the ``tokens``, likewise.
    """
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))

    def setup():
        fresh = {"runs": [], "held": 0, "row": [], "doc_id": [], "size": [], "flags": [], "syms": [], "long": 0}
        state = {k: v.copy() if v == [] else v for k, v in fresh.items()}
        raw = {True: [], False: []}
        base, sent = TaskContext.get().partitionId() << 33, [0]

        def add_up():
            for counted, parts in raw.items():
                if parts:
                    gathered = np.concatenate(parts)
                    parts.clear()
                    keys, n = _counted(gathered)
                    state["runs"].append((keys, (n * counted).astype(np.int32)))
            state["held"] = 0

        def merged():
            runs, state["runs"] = state["runs"], []
            return _merged(runs)

        def send():
            if not state["row"]:
                return None
            add_up()
            keys, n = merged()
            top, top_n = _summed(*zip(*(_summed([keys[a:b][n[a:b] > 0] & TOP_BYTES], [n[a:b][n[a:b] > 0].astype(np.int64)])
                                        for a, b in pairwise([*range(0, len(keys), 1 << 20), len(keys)])), strict=True))
            order, ranges = _ranges(block_of(keys, blocks))
            keys, n = keys[order], n[order]
            syms, sizes = np.concatenate(state["syms"]), np.array(state["size"])
            tokens, ids, last = encoded(syms)
            times = np.bincount(ids[np.repeat(np.array(state["flags"]), sizes)[last]], minlength=len(tokens))
            order, token_ranges = _ranges(token_block_of(tokens, blocks))
            (token_bytes, at), times = bytes_of(tokens.take(pa.array(order))), times[order]
            w, k = len(token_ranges), len(ranges) + 1

            def one(kind, value):
                return pa.array([None] * (w + k) + [value], kind)

            out = {"kind": ["tokens"] * w + ["strings"] * k + ["texts"],
                   "n": [None] * (w + k) + [blocks],
                   "slice": [base + sent[0]] * (w + k + 1),
                   "block": [*token_ranges, *ranges, -1, None],
                   "keys": [_squeezed(token_bytes[at[a]:at[b]].tobytes(), b - a) for a, b in token_ranges.values()]
                   + [_packed_keys(keys[a:b]) for a, b in ranges.values()] + [_packed_keys(top), None],
                   "counts": [_packed(times[a:b]) for a, b in token_ranges.values()]
                   + [_packed(n[a:b]) for a, b in ranges.values()] + [_packed(top_n), None],
                   "row": one(pa.list_(pa.int64()), state["row"]), "doc_id": one(pa.list_(pa.int64()), state["doc_id"]),
                   "ends": one(pa.list_(pa.int32()), np.cumsum(sizes).astype(np.int32)),
                   "text": one(pa.binary(), _squeezed(syms.tobytes(), len(syms)))}
            state.update({k: v.copy() if v == [] else v for k, v in fresh.items()})
            sent[0] += 1
            pa.default_memory_pool().release_unused()
            return out

        def each(rows):
            syms, starts = symbols(rows["text"])
            sizes, flags = np.diff(starts), np.array(rows["training"], bool)
            learn = np.repeat(flags, sizes)
            g = turned(grams(syms, starts))
            for counted, part in ((True, g[learn]), (False, g[~learn])):
                if len(part):
                    raw[counted].append(part)
            state["held"] += len(g)
            state["row"] += rows["row"]
            state["doc_id"] += rows["doc_id"]
            state["size"] += sizes.tolist()
            state["flags"] += rows["training"]
            state["syms"].append(syms)
            state["long"] += len(syms)
            if state["held"] > GATHERED:
                add_up()
                if sum(len(keys) for keys, _ in state["runs"]) > FLUSH:
                    state["runs"] = [merged()]
            if state["long"] > SLICE_SYMBOLS or state["runs"] and len(state["runs"][0][0]) > FLUSH:
                return send()
            return None

        return each, send

    used = rows_with_number(docs, "doc_id", "text").withColumn(
        "training", F.coalesce(F.lit(True) if training is None else training, F.lit(False)))
    return spool(over_texts(used, "text", None, _SENT, setup=setup), "slices", "zstd")


def _tokens_of(block: pa.Table) -> tuple[pa.Array, np.ndarray, list[int], np.ndarray]:
    """Of a block of tokens: the distinct ones, which they are slice after slice, the number of each slice's, and the sums of all counts."""
    parts = [_spread(k) for k in block.column("keys").to_pylist()]
    tokens, ids, _ = encoded(np.concatenate([p[0] for p in parts]))
    n = np.concatenate([_unpacked(c) for c in block.column("counts").to_pylist()])
    order = np.argsort(ids, kind="stable")
    sums = np.add.reduceat(n[order], np.searchsorted(ids[order], np.arange(len(tokens))))
    return tokens, ids, [p[1] for p in parts], sums


def count(docs: DataFrame, training: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(``token, n`` of all training tokens, of which the end is a line feed; slices)."""
    slices = cut(docs, training)

    def unpack(block: pa.Table) -> pa.Table:
        tokens, _, _, n = _tokens_of(block)
        words = [t if t == b"\n" else t[:-1] for t in tokens.to_pylist()]
        return pa.table({"token": [w.replace(bytes([NUL]), b"\0").decode("utf-8") for w in words], "n": n})

    tokens = slices.where("kind = 'tokens'").select("block", "keys", "counts").groupBy("block").applyInArrow(unpack, "token string, n long")
    return tokens.where("n > 0"), slices


def token_counts(slices: DataFrame) -> DataFrame:
    """Per slice and block of tokens the counts of its tokens (``value``), stored; ``n`` and ``v`` add up to all tokens and all distinct ones."""
    ship_code(slices.sparkSession)

    def add_up(block: pa.Table) -> pa.Table:
        _, ids, sizes, n = _tokens_of(block)
        parts = np.split(n[ids], np.cumsum(sizes)[:-1])
        rest = [0] * (len(parts) - 1)
        return pa.table({"slice": block.column("slice"), "block": block.column("block"), "value": [_packed(p) for p in parts],
                         "n": [int(n.sum()), *rest], "v": [int((n > 0).sum()), *rest]})

    return spool(slices.where("kind = 'tokens'").select("slice", "block", "keys", "counts").groupBy("block").applyInArrow(
        add_up, "slice long, block long, value binary, n long, v long"), "tokens", "zstd")


def _packed_keys(keys: np.ndarray) -> bytes:
    """Rising keys of 8 bytes: how many leading bytes are the last key's, then the others, place by place."""
    raw = np.ascontiguousarray(keys.astype(">u8")).view(np.uint8).reshape(-1, 8)
    same = np.zeros(len(keys), np.uint8)
    same[1:] = np.argmax(raw[1:] != raw[:-1], 1)
    return _squeezed(b"".join([same.tobytes(), *(raw[same <= j, j].tobytes() for j in range(8))]), len(keys))


def _unpacked_keys(data: bytes) -> np.ndarray:
    rest, n = _spread(data)
    same, at = rest[:n], n
    raw = np.zeros((n, 8), np.uint8)
    for j in range(8):
        fresh = np.cumsum(same <= j)
        known = int(fresh[-1]) if n else 0
        raw[:, j] = rest[at:at + known][fresh - 1]
        at += known
    return raw.reshape(-1).view(">u8").astype(U64)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, all first bytes first."""
    return _squeezed(np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), len(values))


def _unpacked(data: bytes) -> np.ndarray:
    rest, n = _spread(data)
    return np.ascontiguousarray(rest.reshape(8, n).T).view("<i8").ravel()


def _squeezed(raw: bytes, n: int) -> bytes:
    return np.array([len(raw), n], "<i8").tobytes() + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def _spread(data: bytes) -> tuple[np.ndarray, int]:
    size, n = np.frombuffer(data[:16], "<i8").tolist()
    return np.frombuffer(pa.decompress(data[16:], size, "zstd"), np.uint8), n


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs; sorts in place."""
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(first, append=len(keys))


def _summed(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not keys:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    keys, n = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[:len(keys)]
    return keys[first], np.add.reduceat(n[order], first)


def _merged(runs: list[tuple[np.ndarray, np.ndarray]], piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """``_summed`` for runs of rising keys, in less memory."""
    if len(runs) == 1:
        return runs[0]
    keys = np.concatenate([run[0] for run in runs])
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    sums = np.zeros(len(keys), np.int32)
    for own, n in runs:
        for at in range(0, len(own), piece):
            sums[np.searchsorted(keys, own[at:at + piece])] += n[at:at + piece]
    return keys, sums


@dataclass
class Tree:
    """Sorted contexts and entries of each depth."""
    root: np.ndarray  # probability of each byte without history
    contexts: list[np.ndarray]  # by depth - 1
    back: list[np.ndarray]  # weight of the shorter context's probability
    cells: list[np.ndarray]  # context << 8 | next
    share: list[np.ndarray]  # what an entry adds


@dataclass
class Level:
    """Counts of one depth, in the order of ``turned``."""
    cells: np.ndarray  # context << 8 | next
    n: np.ndarray
    contexts: np.ndarray
    place: np.ndarray  # context of each cell
    totals: np.ndarray


def _level(keys: np.ndarray, n: np.ndarray, depth: int) -> Level:
    """Contexts of one depth; histories that end before it have none."""
    context = keys >> U64(8 * (8 - depth)) if depth else np.zeros_like(keys)
    known = (context & U64(255) > 0) | (depth == 0)
    cells, n = _summed([context[known] << U64(8) | keys[known] & U64(255)], [n[known]])
    contexts, place = np.unique(cells >> U64(8), return_inverse=True)
    return Level(cells, n, contexts, place, np.bincount(place, n, len(contexts)))


def _gain(level: Level, above: Level) -> np.ndarray:
    """Count x divergence of each context from the one a byte shorter."""
    at = np.searchsorted(above.cells, level.cells >> U64(16) << U64(8) | level.cells & U64(255))
    parent = np.searchsorted(above.contexts, level.contexts >> U64(8))
    term = level.n * np.log((level.n / level.totals[level.place])
                            / (above.n[at] / above.totals[parent][level.place]))
    return np.bincount(level.place, term, len(level.contexts))


def _kept(levels: list[Level], longer: np.ndarray, min_count: int, min_gain: float) -> list[np.ndarray]:
    """Retained contexts of all levels but the first, which is the one above them; ``longer``: suffixes to be kept."""
    out = []
    for above, level in zip(levels[-2::-1], levels[:0:-1], strict=True):
        stays = (level.totals >= min_count) & (_gain(level, above) >= min_gain) | np.isin(level.contexts, longer)
        longer = np.unique(level.contexts[stays] >> U64(8))
        out.insert(0, stays)
    return out


def _rows(level: Level, stays: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    at = stays[level.place]
    context = ((level.cells[at] >> U64(8)) << U64(8 * (8 - depth)) if depth else np.zeros(int(at.sum()), U64)).byteswap()
    return {"depth": np.full(len(context), depth, np.int32), "context": context.view(np.int64),
            "next": (level.cells[at] & U64(255)).astype(np.int64), "n": level.n[at]}


_CELLS = pa.schema([("depth", pa.int32()), ("context", pa.int64()), ("next", pa.int64()), ("n", pa.int64())])


def grow(strings: DataFrame, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN) -> tuple[pa.Table, DataFrame]:
    """(retained rows of the first ``TOP_DEPTH`` levels; per block its strings by slice, and the retained rows below), stored.

    The contexts that end in the same ``KEY_DEPTH`` bytes lie in one block, so all longer ones are counted there at once.
    """
    ship_code(strings.sparkSession)

    def unpack(batches):
        for batch in batches:
            for keys, counts in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked_keys(keys).view(np.int64)), pa.array(_unpacked(counts))],
                                                 names=["key", "n"])

    strings = strings.where("kind = 'strings'")
    first = (strings.where("block = -1").select("keys", "counts").mapInArrow(unpack, "key long, n long")
             .groupBy("key").agg(F.sum("n").alias("n")).toArrow())
    keys, n = (first.column(i).to_numpy().astype(t) for i, t in ((0, np.int64), (1, np.int64)))
    top = [_level(keys.view(U64), n, d) for d in range(TOP_DEPTH + 1)]
    shared = strings.sparkSession.sparkContext.broadcast(vars(top[-1]))

    def plant(t: pa.Table) -> pa.Table:
        packed = t.column("keys").to_pylist()
        keys, n = _summed([_unpacked_keys(k) for k in packed], [_unpacked(c) for c in t.column("counts").to_pylist()])
        keys, n = keys[n > 0], n[n > 0]
        levels = [Level(**shared.value), *(_level(keys, n, d) for d in range(TOP_DEPTH + 1, DEPTH + 1))]
        stays = _kept(levels, np.zeros(0, U64), min_count, min_gain)
        shorter = np.unique(levels[1].contexts[stays[0]] >> U64(8))
        rows = [_rows(level, kept, d) for d, (level, kept) in enumerate(zip(levels[1:], stays, strict=True), TOP_DEPTH + 1)]
        cells = {c: [_packed(r[c]) for r in rows] for c in ("context", "next", "n")}
        return pa.table({"block": t.column("block")[:1], "slice": [t.column("slice").to_pylist()], "keys": [packed],
                         "cells": [sum(len(r["n"]) for r in rows)], "shorter": [shorter.astype(np.int64)],
                         **{c: [v] for c, v in cells.items()}})

    blocks = spool(strings.where("block >= 0").select("slice", "block", "keys", "counts").groupBy("block").applyInArrow(
        plant, "block long, slice array<long>, keys array<binary>, cells long, shorter array<long>, context array<binary>, "
               "next array<binary>, n array<binary>"), "blocks", "zstd")
    longer = blocks.select(F.explode("shorter").alias("context")).distinct().toArrow().column(0).to_numpy()
    stays = [np.ones(len(top[0].contexts), bool), *_kept(top, longer.astype(U64), min_count, min_gain)]
    rows = [_rows(level, kept, d) for d, (level, kept) in enumerate(zip(top, stays, strict=True))]
    return pa.table({c: np.concatenate([r[c] for r in rows]) for c in _CELLS.names}, schema=_CELLS), blocks


def _deep_rows(block: dict) -> dict[str, np.ndarray]:
    """The retained rows of a block."""
    parts = {c: [_unpacked(x) for x in block[c]] for c in ("context", "next", "n")}
    depth = np.repeat(np.arange(TOP_DEPTH + 1, DEPTH + 1, dtype=np.int32), [len(x) for x in parts["n"]])
    return {"depth": depth, **{c: np.concatenate(x) for c, x in parts.items()}}


def tree_rows(top: pa.Table, blocks: DataFrame) -> DataFrame:
    """Rows (``depth``, ``context``, ``next``, ``n``) of the root and of all retained contexts."""
    def unpack(batches):
        for batch in batches:
            for block in batch.to_pylist():
                yield pa.RecordBatch.from_pydict(_deep_rows(block), schema=_CELLS)

    schema = "depth int, context long, next long, n long"
    return blocks.sparkSession.createDataFrame(top, schema).unionByName(
        blocks.select("context", "next", "n").mapInArrow(unpack, schema))


def retained(strings: DataFrame, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN) -> DataFrame:
    """Rows (``depth``, ``context``, ``next``, ``n``) of the root and of all retained contexts."""
    return tree_rows(*grow(strings, min_count, min_gain))


def build(cells) -> Tree:
    """The tables of the collected rows of ``retained``."""
    depth, context, nxt, n = (np.asarray(cells[c], np.int64) for c in ("depth", "context", "next", "n"))
    root = np.full(256, 0.5)
    root[nxt[depth == 0]] += n[depth == 0]
    tree = Tree(root / root.sum(), [], [], [], [])
    for d in range(1, DEPTH + 1):
        at = depth == d
        keys = context[at].astype(np.uint64) << np.uint64(8) | nxt[at].astype(np.uint64)
        order = np.argsort(keys)
        keys, own = keys[order], n[at][order]
        known, place, kinds = np.unique(keys >> np.uint64(8), return_inverse=True, return_counts=True)
        both = kinds + np.bincount(place, own, len(known))
        for part, values in ((tree.contexts, known), (tree.back, kinds / both), (tree.cells, keys), (tree.share, own / both[place])):
            part.append(values)
    return tree


def collected(top: pa.Table, blocks: DataFrame) -> Tree:
    """The whole tree; its rows come packed, as they lie in the blocks."""
    deep = [_deep_rows(block) for block in blocks.select("context", "next", "n").toArrow().to_pylist()]
    return build({c: np.concatenate([top.column(c).to_numpy(), *(rows[c] for rows in deep)]) for c in _CELLS.names})


def log10_of(tree: Tree, strings: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each string (as of ``grams``)."""
    return folded(tree, strings)[0]


def folded(tree: Tree, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of the last byte of each string, and the depth of the longest context."""
    strings = strings.astype(np.uint64)
    p = tree.root[(strings & np.uint64(255)).astype(np.int64)]
    depth = np.zeros(len(strings), np.uint8)
    left = np.arange(len(strings))
    for d, (contexts, back, cells, share) in enumerate(zip(tree.contexts, tree.back, tree.cells, tree.share, strict=True), 1):
        if not len(contexts):
            break
        g = strings[left] if d == DEPTH else strings[left] & np.uint64((1 << 8 * (d + 1)) - 1)
        # a history that ends before has a zero as its oldest byte, which no context has
        at = np.minimum(np.searchsorted(contexts, g >> np.uint64(8)), len(contexts) - 1)
        hit = contexts[at] == g >> np.uint64(8)
        left, at, g = left[hit], at[hit], g[hit]
        here = p[left] * back[at]
        cell = np.minimum(np.searchsorted(cells, g), len(cells) - 1)
        p[left] = here + np.where(cells[cell] == g, share[cell], 0.0)
        depth[left] = d
    return np.log10(p), depth


def score_symbols(tree: Tree, syms: np.ndarray, piece: int = 1 << 18) -> np.ndarray:
    """log10 probability of each symbol; ``piece`` distinct strings are looked up together."""
    starts = np.concatenate([[0], np.flatnonzero(syms == END) + 1])
    swapped = grams(syms, starts).view(np.uint64).byteswap()  # newest bytes first: neighbours share their contexts
    distinct, place = np.unique(swapped, return_inverse=True)
    strings = distinct.byteswap()
    found = [log10_of(tree, strings[at:at + piece]) for at in range(0, len(strings), piece)]
    return np.concatenate([*found, np.zeros(0)])[place]


def _pieces(starts: np.ndarray, piece: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with some ``piece`` symbols each."""
    at = 0
    while at < len(starts) - 1:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + piece, side="right")) - 1)
        yield at, to
        at = to


def score_texts(tree: Tree, texts: list[str | None]) -> np.ndarray:
    syms, starts = symbols(texts)
    return np.add.reduceat(score_symbols(tree, syms), starts[:-1])


def _longest(keys: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the distinct pairs of longest context and next byte each key (of rising ones) has, and the place of one key for each pair.

    Pairs are numbered by depth, then by context and byte.
    """
    which = np.empty(len(keys), np.int64)
    firsts, before = [np.zeros(0, np.int64)], 0
    for d in np.flatnonzero(np.bincount(depth)).tolist():
        own = np.flatnonzero(depth == d)
        if d == DEPTH:
            which[own], first = np.arange(before, before + len(own)), own
        else:
            context = keys[own] >> U64(8 * (8 - d)) if d else np.zeros(len(own), U64)
            pairs = context << U64(8) | keys[own] & U64(255)
            distinct = _counted(pairs.copy())[0]
            place = np.searchsorted(distinct, pairs)
            first = np.empty(len(distinct), np.int64)
            first[place] = own
            which[own] = place + before
        firsts.append(first)
        before += len(first)
    return which, np.concatenate(firsts)


def looked_up(top: pa.Table, blocks: DataFrame) -> DataFrame:
    """Per slice and block, the ``depth`` of the longest context of each of its strings, and one value per such context and next byte:
    the log10 probability in units of 1 / ``FINE``."""
    shared = blocks.sparkSession.sparkContext.broadcast(vars(build(top)))
    arrow = pa.schema([("slice", pa.int64()), ("block", pa.int64()), ("depth", pa.binary()), ("value", pa.binary())])

    def look(batches):
        first = Tree(**shared.value)
        for batch in batches:
            for block in batch.to_pylist():
                own = build(_deep_rows(block))
                tree = Tree(first.root, *(getattr(first, c)[:TOP_DEPTH] + getattr(own, c)[TOP_DEPTH:]
                                          for c in ("contexts", "back", "cells", "share")))
                parts = [_unpacked_keys(packed) for packed in block["keys"]]
                keys = _counted(np.concatenate(parts))[0]
                p, depth = folded(tree, turned_back(keys))
                which, one = _longest(keys, depth)
                values = np.rint(-FINE * p[one]).astype(np.int64)
                out = {"slice": block["slice"], "block": [block["block"]] * len(block["slice"]), "depth": [], "value": []}
                for part in parts:
                    at = np.searchsorted(keys, part)
                    asked = np.zeros(len(values), bool)
                    asked[which[at]] = True
                    out["depth"].append(_squeezed(depth[at].tobytes(), len(at)))
                    out["value"].append(_packed(values[asked]))
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return blocks.select("block", "slice", "keys", "context", "next", "n").mapInArrow(
        look, "slice long, block long, depth binary, value binary")


class Places:
    """Places of distinct keys, by tables of hashes; keys that share a hash go on to the next, smaller table."""

    def __init__(self, keys: np.ndarray, rounds: int = 12):
        self.tables, left = [], np.arange(len(keys), dtype=np.int32)
        for r in range(rounds):
            if not len(left):
                break
            factor, shift = mix(np.array([r + 1]))[0] | U64(1), U64(63 - len(left).bit_length())
            slot = self._slot(keys[left], factor, shift)
            table = np.full(2 << len(left).bit_length(), -1, np.int32)
            table[slot] = left
            table[slot[table[slot] != left]] = -1
            self.tables.append((factor, shift, table))
            left = left[table[slot] < 0]
        self.rest, self.rest_keys = left, keys[left]

    @staticmethod
    def _slot(keys: np.ndarray, factor: np.uint64, shift: np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * factor) >> shift).view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys, each of which is one of the known."""
        out, left = np.full(len(keys), -1, np.int32), None
        for table in self.tables:
            if left is None:
                out = table[2][self._slot(keys, *table[:2])]
            else:
                out[left] = table[2][self._slot(keys[left], *table[:2])]
            left = np.flatnonzero(out < 0) if left is None else left[out[left] < 0]
            if not len(left):
                return out
        out[left] = self.rest[np.searchsorted(self.rest_keys, keys[left])]
        return out


def slice_scores(found: pa.Table, blocks: int, syms: np.ndarray, starts: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Scores of a slice's texts, from its rows of ``looked_up``; some ``piece`` symbols are taken together."""
    def strings(at, to):
        return turned(grams(syms[starts[at]:starts[to]], starts[at:to + 1] - starts[at]))

    keys = _counted(np.concatenate([_counted(strings(*p))[0] for p in _pieces(starts, 4 * piece)]))[0]
    order, ranges = _ranges(block_of(keys, blocks))
    values = np.zeros(len(keys), np.int64)
    for b, depth, value in zip(*(found.column(c).to_pylist() for c in ("block", "depth", "value")), strict=True):
        own = order[slice(*ranges[b])]
        values[own] = _unpacked(value)[_longest(keys[own], _spread(depth)[0])[0]]
    places = Places(keys)
    return np.concatenate([np.add.reduceat(values[places.of(strings(at, to))], starts[at:to] - starts[at])
                           for at, to in _pieces(starts, piece)]) / -FINE


def base_figures(found: pa.Table, blocks: int, syms: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text of a slice: tokens, known tokens, and the sum of log10(c + 1); from its rows of ``token_counts``."""
    tokens, ids, last = encoded(syms)
    order, ranges = _ranges(token_block_of(tokens, blocks))
    c = np.zeros(len(tokens), np.int64)
    for b, value in zip(*(found.column(c).to_pylist() for c in ("block", "value")), strict=True):
        c[order[slice(*ranges[b])]] = _unpacked(value)
    first = np.searchsorted(last, starts)
    return (np.diff(first), np.add.reduceat((c > 0).astype(np.int64)[ids], first[:-1]),
            np.add.reduceat(np.log10(c + 1.0)[ids], first[:-1]))


def score(df: DataFrame, training: Column, key: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT,
          min_gain: float = MIN_GAIN, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """Scores of all rows by a model of those for which ``training`` (a condition on ``doc_id``) holds."""
    spark = df.sparkSession
    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    slices = cut(used, training)
    counted = token_counts(slices)
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    top, blocks = grow(slices, min_count, min_gain)
    small = top.num_rows + (blocks.agg(F.sum("cells")).first()[0] or 0) <= broadcast_cells
    shared = spark.sparkContext.broadcast(vars(collected(top, blocks)) if small else None)
    schema = "row long, doc_id long, n_tokens long, n_known long, base double, score double"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def finish(own: pa.Table, found: pa.Table) -> pa.Table:
        rows, docs, ends, packed, blocks = (own.column(c)[0].as_py() for c in ("row", "doc_id", "ends", "text", "n"))
        starts = np.array([0, *ends])
        syms = _spread(packed)[0]
        of_tokens = found.column("depth").is_null()
        n_tokens, n_known, base = base_figures(found.filter(of_tokens), blocks, syms, starts)
        if small:
            tree = Tree(**shared.value)
            scores = np.concatenate([np.add.reduceat(score_symbols(tree, syms[starts[a]:starts[b]]), starts[a:b] - starts[a])
                                     for a, b in _pieces(starts, 1 << 20)])
        else:
            scores = slice_scores(found.filter(pc.invert(of_tokens)), blocks, syms, starts)
        return pa.Table.from_batches([as_batch({"row": rows, "doc_id": docs, "n_tokens": n_tokens, "n_known": n_known,
                                                "base": base, "score": scores}, arrow)])

    found = counted.select("slice", "block", F.lit(None).cast("binary").alias("depth"), "value")
    found = found if small else found.unionByName(looked_up(top, blocks))
    texts = slices.where("kind = 'texts'").select("slice", "row", "doc_id", "ends", "text", "n")
    made = texts.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(finish, schema)
    return made.select(
        "row", "doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; one fold of seven is held out."""
    fold = fold_of(F.col("doc_id"), 7)
    found = score(table(spark, sf_dir, "documents"), fold != 2)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                        "train_tokens", "base_score", "score")
