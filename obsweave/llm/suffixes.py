"""Removal of repeated byte strings: blockwise suffix sorting with difference-cover ranks.

Every byte that a string of ``length`` bytes covers which starts anywhere else too is removed.  Strings lie inside one
text, overlaps count, and all is judged on the input.

1. Buckets.  The suffix at byte i belongs to the bucket of the least hash among the 32-byte strings inside
   its first ``length`` bytes.  Equal strings share their bucket; neighbouring suffixes mostly share
   theirs too, so a bucket's part of a text is a run of starts (about 185 on average), and only runs, not
   suffixes, are shuffled.
2. Equal runs.  Runs are counted by bucket and fingerprint (128 bits of BLAKE2b) of their bytes.  All starts of a run that occurs twice
   are repeated; copies of whole texts end here, whatever their number.  A run that is alone in its bucket is not repeated.
3. Sorting, one block of buckets at a time.  What is left are different runs of one bucket: their bytes are
   gathered, and their suffixes sorted to the depth of ``length``.  Ranks of the suffixes at a
   difference cover modulo 13 are computed first, by doubling; two suffixes that tie on their first bytes
   are then told apart by the ranks at the one distance at which both meet the cover.  A block has
   ``block_bytes`` at most, so memory is bounded.
4. A bucket beyond that size is not sorted in one task: the fingerprints of its suffixes are counted in
   a shuffle instead, which gives the same answer for any size.

Defined cases: NULL is the empty text; texts shorter than ``length`` lose nothing; repeated rows
remove each other; a NULL id stays NULL; other columns are ignored.
Rows are numbered once and stored with their texts; all later steps read that table.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spool
from .common import U64, mix, over_texts, stored_rows, table

LENGTH = 400
GRAM = 32
BLOCK_BYTES = 4_000_000
MODULUS = 13
COVER = (0, 1, 3, 9)  # every residue modulo 13 is a difference of two of these


#: A random 64-bit number for each byte value.
_BYTE_CODES = mix(np.arange(256, dtype=U64) + U64(0x243F6A8885A308D3))


def doubled(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` bytes (a power of two) from each place.

    They only deal strings into buckets: for long strings, different ones of one pattern may get the same hash.
    """
    width = 1
    with np.errstate(over="ignore"):
        h, step = _BYTE_CODES[data], U64(0x9E3779B97F4A7C15)
        while width < size:
            h = h[:-width] * step + h[width:]
            step, width = step * step, 2 * width
    return h


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Least (or greatest) of each ``width`` neighbours, from prefix and suffix runs of blocks."""
    n = len(values)
    if n < width:
        return values[:0]
    fill = np.iinfo(values.dtype).max if pick is np.minimum else np.iinfo(values.dtype).min
    padded = np.concatenate([values, np.full(-n % width, fill, values.dtype)]).reshape(-1, width)
    before = pick.accumulate(padded, 1).ravel()
    after = pick.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return pick(after[:n - width + 1], before[width - 1:n])


def runs_of(data: np.ndarray, length: int = LENGTH):
    """(key, first start, last start, inner, two fingerprints) of the runs of a text.

    ``inner``: the least gram occurs twice inside the run.  Fingerprints are those of the run's bytes.
    """
    width = length - GRAM + 1
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none, none, none.astype(bool), none.astype(U64), none.astype(U64)
    h = mix(doubled(data, GRAM))
    least = sliding(h, width)
    edge = np.flatnonzero(least[1:] != least[:-1])
    first = np.concatenate([[0], edge + 1])
    last = np.concatenate([edge, [len(least) - 1]])
    key = least[first]
    # places whose gram is the least of some window that holds it
    room = np.zeros(width - 1, U64)
    anchors = np.flatnonzero(sliding(np.concatenate([room, least, room]), width, np.maximum) == h)
    # anchors by gram and place; a run's gram occurs at the next one from its start, and maybe at the one after
    grams, which = np.unique(h[anchors], return_inverse=True)
    placed = np.sort(which * len(data) + anchors)
    base = np.searchsorted(grams, key) * len(data)
    after = np.append(placed, np.iinfo(np.int64).max)[np.searchsorted(placed, base + first) + 1]
    return key, first, last, after < base + last + width, *fingerprints(data, first, last + length)


def fingerprints(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 128 bits of BLAKE2b of data[first:stop], which may overlap, as two columns."""
    raw = memoryview(data)
    made = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest()
                     for a, b in zip(first.tolist(), stop.tolist(), strict=True)])
    both = np.frombuffer(made, "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _rank(column: np.ndarray) -> np.ndarray:
    """Dense ranks in the column's order."""
    return np.unique(column, return_inverse=True)[1]


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense ranks of the pairs of two columns of ranks; b may hold -1."""
    return _rank(a * (int(b.max(initial=0)) + 2) + b + 1)


def cover_ranks(data: np.ndarray, periods: int) -> np.ndarray:
    """Rank of the first 13 x periods bytes from each cover place; -1 elsewhere.  Data is padded by the caller."""
    n = len(data) - MODULUS * (periods + 2)
    place = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
    where = np.full(len(data), -1, np.int64)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    word = np.ascontiguousarray(words[place]).view(">u8").ravel()
    rest = np.ascontiguousarray(words[place + 5]).view(">u8").ravel()  # bytes 5..12: with the first, all 13
    by_size = {1: _join(_rank(word), _rank(rest))}

    def joined(a: np.ndarray, size: int, b: np.ndarray) -> np.ndarray:
        """Rank of the bytes that ``a`` ranks, followed by those that ``b`` ranks ``size`` periods on."""
        where[:] = -1
        where[place] = b
        nxt = where[np.minimum(place + MODULUS * size, len(data) - 1)]
        return _join(a, nxt)

    size = 1
    while 2 * size <= periods:
        by_size[2 * size] = joined(by_size[size], size, by_size[size])
        size *= 2
    out, done = by_size[size], size
    while done < periods:
        size = max(s for s in by_size if s <= periods - done)
        out = joined(out, done, by_size[size])
        done += size
    where[:] = -1
    where[place] = out
    return where


def repeated_starts(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of these starts have ``length`` bytes that another of them has too.

    The starts of a block are sorted by a packed key of first and last bytes and of the rank at the cover
    distance; neighbours of one key are then compared in full, and where different strings met under one key,
    all are sorted by what the key is made of.  As only pairs at a suitable
    distance can be compared, each start is entered at the four distances at which it meets
    the cover; two starts share one of them at least.
    """
    periods = (length - (MODULUS - 1)) // MODULUS
    head, tail = 16, 24
    if length < 2 * (head + tail) or len(starts) < 2:
        rows = np.unique(np.lib.stride_tricks.sliding_window_view(data, length)[starts], axis=0,
                         return_inverse=True, return_counts=True)
        return rows[2][rows[1].ravel()] > 1
    padded = np.concatenate([data, np.zeros(MODULUS * (periods + 3) + 32, np.uint8)])
    rank = cover_ranks(padded, periods)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)

    def word(at):
        return np.ascontiguousarray(words[at]).view(">u8").ravel()

    ends = [word(starts), word(starts + 8), *[word(starts + length - back) for back in (24, 16, 8)]]
    packed = np.zeros(len(starts), U64)
    with np.errstate(over="ignore"):
        for w in ends:
            packed = mix(packed * U64(3) + w.astype(U64))

    def alike(at, r, one, two):
        fine = r[one] == r[two]
        for w in ends:
            fine &= w[at[one]] == w[at[two]]
        return fine

    out = np.zeros(len(starts), bool)
    residue = starts % MODULUS
    for distance in range(MODULUS):
        at = np.flatnonzero(np.isin((residue + distance) % MODULUS, COVER))
        if len(at) < 2:
            continue
        r = rank[starts[at] + distance]
        with np.errstate(over="ignore"):
            key = packed[at] + mix(r.astype(U64))
        order = np.argsort(key)
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        one, two = order[same], order[same + 1]
        fine = alike(at, r, one, two)
        if not fine.all():
            order = np.lexsort((r, *[w[at] for w in ends]))
            one, two = order[:-1], order[1:]
            fine = alike(at, r, one, two)
        out[at[one[fine]]] = True
        out[at[two[fine]]] = True
    return out


def as_intervals(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2].tolist(), (edges[1::2] - 1).tolist()


def text_runs(docs: DataFrame, length: int) -> DataFrame:
    """Runs of every text (``key``, ``fp1``, ``fp2``, ``first``, ``last``, ``inner``), and a header with key NULL."""
    def each(part):
        out = {k: [] for k in ("row", "doc_id", "n_bytes", "sha", "key", "fp1", "fp2", "first", "last", "inner")}
        for row, doc, t in zip(part["row"], part["doc_id"], part["text"], strict=True):
            raw = (t or "").encode()
            data = np.frombuffer(raw, np.uint8)
            key, first, last, inner, a, b = runs_of(data, length)
            n = len(key)
            out["row"] += [row] * (n + 1)
            out["doc_id"] += [doc] + [None] * n
            out["n_bytes"] += [len(raw)] + [None] * n
            out["sha"] += [hashlib.sha256(raw).hexdigest()] + [None] * n
            for name in ("key", "fp1", "fp2", "first", "last", "inner"):
                out[name].append(None)
            if n:
                out["key"] += key.view(np.int64).tolist()
                out["fp1"] += a.view(np.int64).tolist()
                out["fp2"] += b.view(np.int64).tolist()
                out["first"] += first.tolist()
                out["last"] += last.tolist()
                out["inner"] += inner.tolist()
        return out

    return over_texts(docs, "text", each, "row long, doc_id long, n_bytes long, sha string, key long, fp1 long, "
                      "fp2 long, first int, last int, inner boolean")


def _bytes_of(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """``wanted`` (row, runs: array of key, fp1, fp2, first, last, big) with the bytes of each run."""
    def each(part):
        out = {k: [] for k in ("key", "fp1", "fp2", "big", "data")}
        for t, runs in zip(part["text"], part["runs"], strict=True):
            raw = t.encode()
            for r in runs:
                for k in ("key", "fp1", "fp2", "big"):
                    out[k].append(r[k])
                out["data"].append(raw[r["first"]:r["last"] + length])
        return out

    return over_texts(wanted.hint("merge").join(texts, "row").select("text", "runs"), "text", each,
                      "key long, fp1 long, fp2 long, big boolean, data binary")


_MARKS = "key long, fp1 long, fp2 long, low array<int>, high array<int>"


def _sorted_blocks(runs: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """Marks of runs whose buckets fit a block: whole buckets are gathered up to the block's size, and sorted."""
    def setup():
        waiting, state = [], {"bytes": 0}

        def flush(rows):
            data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
            sizes = np.array([len(r[3]) for r in rows])
            base = np.cumsum(sizes) - sizes
            counts = sizes - length + 1
            starts = np.repeat(base, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            hit = repeated_starts(data, starts, length)
            out = {k: [] for k in ("key", "fp1", "fp2", "low", "high")}
            for r, part in zip(rows, np.split(hit, np.cumsum(counts)[:-1]), strict=True):
                if part.any():
                    low, high = as_intervals(part)
                    for k, v in zip(out, (r[0], r[1], r[2], low, high), strict=True):
                        out[k].append(v)
            return out

        def each(part):
            result = None
            for r in zip(part["key"], part["fp1"], part["fp2"], part["data"], strict=True):
                if waiting and r[0] != waiting[-1][0] and state["bytes"] + len(r[3]) > block_bytes:
                    done = flush(waiting)
                    result = done if result is None else {k: result[k] + done[k] for k in done}
                    waiting.clear()
                    state["bytes"] = 0
                waiting.append(r)
                state["bytes"] += len(r[3])
            return result

        return each, lambda: flush(waiting) if waiting else None

    sorted_ = runs.repartition("key").sortWithinPartitions("key")
    return over_texts(sorted_, "data", None, _MARKS, limit=block_bytes, setup=setup)


def _counted_suffixes(runs: DataFrame, length: int) -> DataFrame:
    """Marks of runs in buckets of any size: suffix fingerprints counted in a shuffle."""
    def each(part):
        out = {k: [] for k in ("key", "fp1", "fp2", "at", "s1", "s2")}
        for key, f1, f2, raw in zip(part["key"], part["fp1"], part["fp2"], part["data"], strict=True):
            data = np.frombuffer(raw, np.uint8)
            at = np.arange(len(data) - length + 1)
            for lo in range(0, len(at), 2000):
                a, b = fingerprints(data, at[lo:lo + 2000], at[lo:lo + 2000] + length)
                out["s1"] += a.view(np.int64).tolist()
                out["s2"] += b.view(np.int64).tolist()
            out["at"] += at.tolist()
            for k, v in (("key", key), ("fp1", f1), ("fp2", f2)):
                out[k] += [v] * len(at)
        return out

    suffix = over_texts(runs, "data", each, "key long, fp1 long, fp2 long, at int, s1 long, s2 long", limit=200_000)
    twice = suffix.groupBy("key", "s1", "s2").agg(F.count("*").alias("n")).where("n > 1")
    hit = suffix.join(twice, ["key", "s1", "s2"])
    one = hit.groupBy("key", "fp1", "fp2").agg(F.array_sort(F.collect_set("at")).alias("low"))
    return one.select("key", "fp1", "fp2", "low", F.col("low").alias("high"))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row``, ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` (removed byte ranges)."""
    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = stored_rows(used, "documents", "doc_id", "text")
    made = spool(text_runs(docs, length), "runs")
    runs = made.where("key IS NOT NULL").select("row", "key", "fp1", "fp2", "first", "last", "inner")
    kinds = runs.groupBy("key", "fp1", "fp2").agg(
        F.count("*").alias("n"), F.max("inner").alias("inner"), F.min(F.struct("row", "first", "last")).alias("one"))
    buckets = kinds.groupBy("key").agg(
        F.count("*").alias("kinds"), F.sum("n").alias("members"), F.max("inner").alias("any_inner"),
        F.sum(F.col("one.last") - F.col("one.first") + F.lit(length)).alias("size"))
    # of all buckets, those with something repeated in them
    busy = buckets.where("members > 1 OR any_inner")
    known = spool(kinds.join(busy, "key").select(
        "key", "fp1", "fp2", "n", "one", (F.col("size") > block_bytes).alias("big"),
        ((F.col("kinds") > 1) | F.col("any_inner")).alias("sort")), "kinds")
    touched = runs.join(known.select("key", "fp1", "fp2", "n"), ["key", "fp1", "fp2"])
    texts = spool(docs.join(touched.select("row").distinct().hint("merge"), "row", "left_semi"), "texts", "zstd")

    # kinds in buckets with one kind only need no look at their bytes
    wanted = known.where("sort").select("one.row", F.struct("key", "fp1", "fp2", "one.first", "one.last", "big").alias("r"))
    content = spool(_bytes_of(wanted.groupBy("row").agg(F.collect_list("r").alias("runs")), texts.select("row", "text"),
                              length), "blocks", "zstd")
    marks = _sorted_blocks(content.where("NOT big").drop("big"), length, block_bytes).unionByName(
        _counted_suffixes(content.where("big").drop("big"), length))
    # all of a run that occurs twice is repeated
    placed = touched.join(marks, ["key", "fp1", "fp2"], "left").where("n > 1 OR low IS NOT NULL").select(
        "row", F.when(F.col("n") > 1, F.array(F.col("first"))).otherwise(
            F.transform("low", lambda x: x + F.col("first"))).alias("low"),
        F.when(F.col("n") > 1, F.array(F.col("last"))).otherwise(
            F.transform("high", lambda x: x + F.col("first"))).alias("high"))
    per_row = placed.groupBy("row").agg(F.flatten(F.collect_list("low")).alias("low"),
                                        F.flatten(F.collect_list("high")).alias("high"))

    def cut(part):
        out = {k: [] for k in ("row", "n_removed", "sha", "spans")}
        for row, t, low, high in zip(part["row"], part["text"], part["low"], part["high"], strict=True):
            raw = t.encode()
            edge = np.zeros(len(raw) + 1, np.int32)
            np.add.at(edge, low, 1)
            np.add.at(edge, np.array(high) + length, -1)
            gone = np.cumsum(edge)[:-1] > 0
            starts, ends = as_intervals(gone)
            out["row"].append(row)
            out["n_removed"].append(int(gone.sum()))
            out["sha"].append(hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
            out["spans"].append([{"first": a, "stop": b + 1} for a, b in zip(starts, ends, strict=True)])
        return out

    cuts = over_texts(per_row.hint("merge").join(texts.select("row", "text"), "row").select("row", "text", "low", "high"), "text", cut,
                      "row long, n_removed long, sha string, spans array<struct<first:int, stop:int>>")
    heads = made.where("key IS NULL").select("row", "doc_id", "n_bytes", F.col("sha").alias("whole"))
    return heads.join(cuts, "row", "left").select(
        "row", "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"), "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated 400-byte strings leave of every document."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
