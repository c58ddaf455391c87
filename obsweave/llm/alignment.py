"""Two tokenizers' tokens aligned by bytes, and how often their ids meet in the corpus.

1. Byte-level BPE (A, ``tokenizers``) reads a space and the text, piece BPE (B, sentencepiece, which adds that space) the
   text.  A's character offsets and B's proto spans place the token ends.  Where tokens of A share a
   character, or tokens of B are byte fallbacks, the ends between are found from the decoded bytes.
   Offsets where tokens of both end cut the text into groups.  A text whose joined bytes of either differ from
   the space and the text has no tokens.
2. Parts between safe cuts (``units``) are aligned once per task, thousands as one text, and added up.  Where that text's bytes are not
   kept, or a part is very long, parts are aligned one by one.  A task that has met many parts keeps those that a later slice
   wanted again.
3. A slice of texts (about 2 MB) becomes one stored row: figures per document, the distinct id pairs of the slice and, per
   document, which of them it links how often.  The pairs of all slices, with the number of their
   documents, are summed corpus-wide; the highest count per id of A is taken over at most all ids of B.
   Counts return to the slices by a join on the pair: the common pairs are wanted once per
   slice, so no pair has a share of the rows beyond one in the slice's distinct pairs.

Nothing is broadcast and nothing reaches the driver.

Defined cases: NULL and empty texts have zeros and an empty digest; repeated rows count as documents each; equal highest
counts are all best; a group without an end of the other inside it is aligned whole, whatever its length;
other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import spool
from .common import SLICE_BYTES, over_texts, ship_code, table
from .packing import byte_alphabet, vocabulary_path
from .units import UnitCache, pieces_keep_spaces, units_of

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A pair of ids as one number: A's id above these bits, B's id in them.
SHIFT = 20
#: Parts aligned as one text; longer parts are aligned on their own.
AT_ONCE, LONG = 4000, 400
#: Characters of parts that a task remembers (about 45 bytes of memory each).
CACHE_CHARS = 2_500_000
#: Parts of a slice whose pairs are summed at once; a longer document is summed as one.
PARTS = 40_000
#: Bytes of rows that a task is sent at once: nearly four slices, so that none is cut short.
BATCH_BYTES = 39 * SLICE_BYTES // 10
#: Stored slices (of about 3 MB) that are written or read at once.
GROUP_ROWS = 8
FIGURES = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Both tokenizers, the bytes of their ids, and the alignment of single texts."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
                        for t, i in self.a.get_vocab().items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.fallback = [self.b.is_byte(i) for i in range(len(names))]
        self.b_bytes = [bytes([int(n[3:-1], 16)]) if f else n.replace("▁", " ").encode()
                        for n, f in zip(names, self.fallback, strict=True)]
        self.divisible = pieces_keep_spaces(names)
        self.a_width = np.array([len(self.a_bytes[i]) for i in range(len(self.a_bytes))], np.int64)
        self.b_width = np.array([len(b) for b in self.b_bytes], np.int64)
        self.is_fallback = np.array(self.fallback)
        self.numerals = np.array([str(i) for i in range(max(len(self.a_bytes), len(names)))], object)

    def align_all(self, texts: list[str]) -> list[list[tuple[list[int], list[int]]] | None]:
        """Per text the groups (ids of A, ids of B), None where bytes are not kept."""
        spaced = [f" {t}" for t in texts]
        left = self.a.encode_batch(spaced, add_special_tokens=False)
        right = self.b.encode(texts, return_type="proto", num_threads=1)
        return [self._align(s, e.ids, e.offsets, p.pieces) for s, e, p in zip(spaced, left, right, strict=True)]

    def _align(self, text, a_ids, offsets, pieces):
        raw = text.encode()
        b_ids = [p.id for p in pieces]
        if (b"".join(map(self.a_bytes.__getitem__, a_ids)) != raw
                or b"".join(map(self.b_bytes.__getitem__, b_ids)) != raw):
            return None
        return cut_groups(a_ids, self._a_ends(text, raw, a_ids, offsets), b_ids, self._b_ends(pieces))

    def _a_ends(self, text, raw, ids, offsets):
        at = None if len(raw) == len(text) else np.cumsum([0, *(len(c.encode()) for c in text)]).tolist()
        ends, place, last = [], 0, len(ids) - 1
        for i, (start, end) in enumerate(offsets):
            shared = (i < last and offsets[i + 1][0] < end) or (i and start < offsets[i - 1][1])
            place = place + len(self.a_bytes[ids[i]]) if shared else at[end] if at else end
            ends.append(place)
        return ends

    def _b_ends(self, pieces):
        ends, place = [], 0
        for p in pieces:
            place = place + 1 if self.fallback[p.id] else p.end + 1  # spans do not count the added space
            ends.append(place)
        return ends


    def ends_of_joined(self, text: str):
        """Ids and byte ends of both sides over a text that begins with a space; None if bytes are not kept."""
        raw = text.encode()
        encoded = self.a.encode_batch([text], add_special_tokens=False)[0]
        pieces = self.b.encode(text[1:], return_type="proto", num_threads=1).pieces
        a_ids = np.array(encoded.ids, np.int64)
        spans = np.fromiter([x for p in pieces for x in (p.id, p.end)], np.int64, 2 * len(pieces))
        b_ids = spans[::2]
        if (b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) != raw
                or b"".join(map(self.b_bytes.__getitem__, b_ids.tolist())) != raw):
            return None
        offsets = np.fromiter(chain.from_iterable(encoded.offsets), np.int64, 2 * len(a_ids)).reshape(-1, 2)
        place = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum(1 + (place >= 0x80) + (place >= 0x800) + (place >= 0x10000))])
        a_ends = at[offsets[:, 1]]
        overlap = offsets[1:, 0] < offsets[:-1, 1]      # tokens that share a character
        shared = np.concatenate([[False], overlap]) | np.concatenate([overlap, [False]])
        a_ends[shared] = np.cumsum(self.a_width[a_ids])[shared]
        b_ends = spans[1::2] + 1
        bytewise = self.is_fallback[b_ids]
        b_ends[bytewise] = np.cumsum(self.b_width[b_ids])[bytewise]
        return a_ids, a_ends, b_ids, b_ends


def cut_groups(a_ids: list[int], a_ends: list[int], b_ids: list[int],
               b_ends: list[int]) -> list[tuple[list[int], list[int]]]:
    groups, i, j, from_a, from_b = [], 0, 0, 0, 0
    while i < len(a_ids) and j < len(b_ids):
        if a_ends[i] == b_ends[j]:
            i, j = i + 1, j + 1
            groups.append((a_ids[from_a:i], b_ids[from_b:j]))
            from_a, from_b = i, j
        elif a_ends[i] < b_ends[j]:
            i += 1
        else:
            j += 1
    return groups


def links(groups: list[tuple[list[int], list[int]]]) -> Counter:
    """Pair -> times it is linked; ids that repeat in a group are multiplied, not listed."""
    found: Counter = Counter()
    for a, b in groups:
        if len(a) == 1 and len(b) == 1:
            found[a[0] << SHIFT | b[0]] += 1
        else:
            right = Counter(b)
            for x, n in Counter(a).items():
                for y, m in right.items():
                    found[x << SHIFT | y] += n * m
    return found


def _among(values: np.ndarray, rising: np.ndarray) -> np.ndarray:
    """Which of the values are in an array that rises."""
    if not len(rising):
        return np.zeros(len(values), bool)
    return rising[np.minimum(np.searchsorted(rising, values), len(rising) - 1)] == values


def _counted(unit: np.ndarray, key: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Distinct (unit, key) in order, and how often each occurs."""
    low = 2 * SHIFT     # both ids of a pair
    both, times = np.unique(unit << low | key, return_counts=True)
    return (both >> low, both & ((1 << low) - 1)), times


def _places(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places of ranges with these starts and lengths, one range after the other."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def _grown(x: np.ndarray, least: int) -> np.ndarray:
    out = np.zeros((max(least, 3 * len(x) // 2), *x.shape[1:]), x.dtype)
    out[:len(x)] = x
    return out


class _Table:
    """What is known of the units, in growing arrays: figures, group texts, pairs, and which a later slice wanted again."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.forget()

    def forget(self):
        self.n = self.m = 0
        self.figures = np.zeros((1024, 4), np.int64)
        self.kept, self.again = np.zeros(1024, bool), np.zeros(1024, bool)
        self.first = np.zeros(1025, np.int64)
        self.pairs, self.times = np.zeros(4096, np.int64), np.zeros(4096, np.int64)
        self.texts: list[bytes] = []

    def keep(self, units: np.ndarray) -> None:
        """Only these units stay; they are numbered anew in this order."""
        count = self.first[units + 1] - self.first[units]
        flat = _places(self.first[units], count)
        figures, kept, pairs, times = self.figures[units], self.kept[units], self.pairs[flat], self.times[flat]
        texts = [self.texts[i] for i in units.tolist()]
        self.forget()
        self._room(len(units), len(flat))
        self.n, self.m, self.texts = len(units), len(flat), texts
        self.figures[:self.n], self.kept[:self.n], self.first[1:self.n + 1] = figures, kept, np.cumsum(count)
        self.pairs[:self.m], self.times[:self.m] = pairs, times

    def add(self, units: list[str]) -> list[int]:
        numbers: dict[str, int] = {}
        alone = [u for u in units if len(u) > LONG]
        together = [u for u in units if len(u) <= LONG]
        for start in range(0, len(together), AT_ONCE):
            some = together[start:start + AT_ONCE]
            base = self.n
            if self._many(some):
                numbers.update(zip(some, range(base, self.n), strict=True))
            else:
                alone += some
        for u, groups in zip(alone, self.aligner.align_all(alone) if alone else (), strict=True):
            numbers[u] = self.n
            self._one(groups)
        return [numbers[u] for u in units]

    def _room(self, units: int, pairs: int) -> None:
        if (least := self.n + units + 1) > len(self.kept):
            self.figures, self.kept, self.again, self.first = (
                _grown(x, least) for x in (self.figures, self.kept, self.again, self.first))
        if (least := self.m + pairs) > len(self.pairs):
            self.pairs, self.times = _grown(self.pairs, least), _grown(self.times, least)

    def _many(self, units: list[str]) -> bool:
        """Add parts that are aligned as one text; False (and nothing added) where its bytes are not kept."""
        text = "".join(f" {u}" for u in units)
        found = self.aligner.ends_of_joined(text)
        if found is None:
            return False
        a_ids, a_ends, b_ids, b_ends = found
        unit_ends = np.cumsum([len(u.encode()) + 1 for u in units])
        common = a_ends[_among(a_ends, b_ends)]     # ends rise on both sides
        if not _among(unit_ends, common).all():
            return False
        n, a_group, b_group = len(units), np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        unit = np.searchsorted(unit_ends, common)           # of each group
        many_a, many_b = (np.bincount(g, minlength=len(common)) for g in (a_group, b_group))
        figures = [np.bincount(unit, w, n).astype(np.int64) for w in (many_a, many_b, np.ones(len(unit)), many_a * many_b)]
        # links: each token of A with the tokens of B in its group, which lie side by side
        count = many_b[a_group]
        flat = np.arange(count.sum()) + np.repeat((np.cumsum(many_b) - many_b)[a_group] - (np.cumsum(count) - count), count)
        key = np.repeat(a_ids << SHIFT, count) | b_ids[flat]
        both, times = _counted(np.repeat(unit[a_group], count), key)
        self._room(n, len(times))
        at, to = self.n, self.n + n
        self.kept[at:to] = True
        self.figures[at:to] = np.stack(figures, 1)
        self.pairs[self.m:self.m + len(times)] = both[1]
        self.times[self.m:self.m + len(times)] = times
        self.first[at + 1:to + 1] = self.m + np.searchsorted(both[0], np.arange(n), side="right")
        self.n, self.m = to, self.m + len(times)
        self.texts += self._texts(a_ids, a_group, many_a, b_ids, b_group, many_b, unit)
        return True

    def _texts(self, a_ids, a_group, many_a, b_ids, b_group, many_b, unit) -> list[bytes]:
        """The groups of every part as text."""
        # a token's place: those of its side before it, and those of the other side up to its group
        from_a = np.arange(len(a_ids)) + (np.cumsum(many_b) - many_b)[a_group]
        from_b = np.arange(len(b_ids)) + np.cumsum(many_a)[b_group]
        side, ids = (np.empty(len(a_ids) + len(b_ids), np.int64) for _ in "ab")
        side[from_a], side[from_b] = 2 * a_group, 2 * b_group + 1
        ids[from_a], ids[from_b] = a_ids, b_ids
        following = np.append(side[1:], -2)
        same_group = following >> 1 == side >> 1
        last = np.concatenate([unit[side >> 1][1:] != unit[side >> 1][:-1], [True]])
        code = np.where(following == side, 0, np.where(same_group, 1, np.where(last, 3, 2)))
        marks = np.array([",", "|", ";", "\n"], object)[code].tolist()
        names = self.aligner.numerals[ids].tolist()
        return "".join([x for pair in zip(names, marks, strict=True) for x in pair]).encode().split(b"\n")[:-1]

    def _one(self, groups):
        found = links(groups or [])
        self._room(1, len(found))
        self.kept[self.n] = groups is not None
        if groups:
            self.figures[self.n] = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups),
                                    sum(len(a) * len(b) for a, b in groups))
        self.pairs[self.m:self.m + len(found)] = list(found.keys())
        self.times[self.m:self.m + len(found)] = list(found.values())
        self.m += len(found)
        self.n += 1
        self.first[self.n] = self.m
        self.texts.append(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups or []).encode())


def _trim(known: _Table, cache: UnitCache) -> None:
    """Both keep what was wanted again, or nothing if that is more than half of what may be kept."""
    wanted = {u: i for u, i in cache.items() if known.again[i]}
    chars = sum(map(len, wanted))
    if 2 * chars > cache.limit:
        wanted, chars = {}, 0
    known.keep(np.fromiter(wanted.values(), np.int64, len(wanted)))
    cache.clear()
    cache.update(zip(wanted, range(len(wanted)), strict=True))  # numbers of parts are places in the table
    cache.chars = chars


def _pairs_of(known: _Table, doc: np.ndarray, unit: np.ndarray, n: int) -> dict[str, list]:
    """The distinct pairs of documents that are made of known units, and how often each document links which."""
    used = np.flatnonzero(np.bincount(unit, minlength=known.n))
    at = np.zeros(known.n, np.int64)
    at[used] = np.arange(len(used))
    count = known.first[used + 1] - known.first[used]
    flat = _places(known.first[used], count)
    keys, place = np.unique(known.pairs[flat], return_inverse=True)
    times, starts = known.times[flat], np.cumsum(count) - count
    sizes, places, sums, start = np.zeros(n, np.int64), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0
    while start < len(doc):
        stop = len(doc)
        if start + PARTS < stop and (stop := int(np.searchsorted(doc, doc[start + PARTS]))) <= start:
            stop = int(np.searchsorted(doc, doc[start], side="right"))
        both, many = np.unique(doc[start:stop] * len(used) + at[unit[start:stop]], return_counts=True)
        owner, which = both // len(used), both % len(used)
        flat = _places(starts[which], count[which])
        both = np.repeat(owner * len(keys), count[which]) + place[flat]
        order = np.argsort(both)
        both = both[order]
        new = np.flatnonzero(np.diff(both, prepend=-1))
        sums.append(np.add.reduceat((np.repeat(many, count[which]) * times[flat])[order], new) if len(new) else new)
        sizes += np.bincount(both[new] // max(1, len(keys)), minlength=n)
        places.append((both[new] % max(1, len(keys))).astype(np.int32))
        start = stop
    pair = np.concatenate(places)
    return {"ends": [np.cumsum(sizes).tolist()], "pair": [pair], "times": [np.concatenate(sums)], "keys": [keys],
            "docs": [np.bincount(pair, minlength=len(keys))]}


_SLICE = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, ends array<int>, pair array<int>, times array<long>, keys array<long>, docs array<int>")


def _slices(df: DataFrame, byte_level: str, pieces: str, key: str, text: str) -> DataFrame:
    """One row per slice; ``pair`` holds places in ``keys``, document by document up to ``ends``."""

    def setup():
        aligner = Aligner(byte_level, pieces)
        known = _Table(aligner)
        cache = UnitCache(known.add, CACHE_CHARS)
        base, seen = TaskContext.get().partitionId() << 33, [0]

        def each(rows):
            n = len(rows["text"])
            lists = [(units_of(t) if aligner.divisible else [t]) if t else [] for t in rows["text"]]
            if cache.chars > cache.limit:
                _trim(known, cache)
            before = known.n
            cache.learn(lists)
            sizes = np.fromiter(map(len, lists), np.int64, n)
            unit = np.fromiter(map(cache.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
            del lists
            known.again[unit[unit < before]] = True
            doc = np.repeat(np.arange(n), sizes)
            lost = np.bincount(doc, ~known.kept[unit], n) > 0
            unit, doc = unit[~lost[doc]], doc[~lost[doc]]
            figures = [np.bincount(doc, known.figures[unit, c], n).astype(np.int64) for c in range(4)]
            bounds = np.searchsorted(doc, np.arange(n + 1)).tolist()
            numbers = unit.tolist()
            digests = ["" if b == e else hashlib.sha256(b";".join(map(known.texts.__getitem__, numbers[b:e]))).hexdigest()
                       for b, e in zip(bounds[:-1], bounds[1:], strict=True)]
            del numbers
            out = {"slice": [base + seen[0]], "doc_id": [rows["doc_id"]], "groups_sha256": [digests],
                   **_pairs_of(known, doc, unit, n)}
            out |= {name: [f] for name, f in zip(FIGURES, figures, strict=True)}
            seen[0] += 1
            return out

        return each, None

    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return over_texts(used, "text", None, _SLICE, setup=setup)


def pair_counts(made: DataFrame) -> DataFrame:
    """``key``, ``a``, ``b``, ``n`` (documents that hold the pair linked), ``best`` (the highest n of the same a)."""
    wanted = made.select(F.explode(F.arrays_zip("keys", "docs")).alias("p")).select("p.keys", "p.docs")
    counts = wanted.groupBy(F.col("keys").alias("key")).agg(F.sum("docs").alias("n"))
    counts = counts.withColumns({"a": F.shiftright("key", SHIFT), "b": F.col("key").bitwiseAND((1 << SHIFT) - 1)})
    # a window holds the ids of B that meet one id of A: at most the vocabulary
    return counts.withColumn("best", F.max("n").over(Window.partitionBy("a")))


@contextmanager
def _batches_of(spark: SparkSession, limit: int):
    """Within, tasks are sent ``limit`` bytes of rows at once (by default up to 64 MB, held in the JVM and twice in Python)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, f"{limit}b")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def align(df: DataFrame, byte_level: str | None = None, pieces: str | None = None, key: str = "doc_id",
          text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(per document: figures and digest; per pair of ids: ``a``, ``b``, ``n``, ``best``).  Stores the slices and the counts."""
    ship_code(df.sparkSession)
    with _batches_of(df.sparkSession, BATCH_BYTES):
        made = spool(_slices(df, byte_level or vocabulary_path(BYTE_LEVEL), pieces or vocabulary_path(PIECES), key, text),
                     "slices", "zstd", GROUP_ROWS)
    counts = spool(pair_counts(made), "pairs", "zstd")
    wanted = made.select(F.col("slice").alias("of"), F.explode("keys").alias("key"))
    found = wanted.join(counts.select("key", "n", "best"), "key").select("of", "key", "n", "best")

    def finish(own: pa.Table, pairs: pa.Table) -> pa.Table:
        row = {c: own.column(c).combine_chunks().flatten() for c in own.column_names if c != "slice"}
        pairs = pairs.sort_by("key")
        n, best = pairs.column("n").to_numpy(), pairs.column("best").to_numpy()
        place, times = row["pair"].to_numpy(), row["times"].to_numpy()
        docs = len(row["doc_id"])
        owner = np.repeat(np.arange(docs), np.diff(row["ends"].to_numpy(), prepend=0))
        sums = np.zeros((2, docs), np.int64)
        np.add.at(sums[0], owner, times * (n == best)[place])
        np.add.at(sums[1], owner, times * n[place])
        return pa.table({"doc_id": row["doc_id"], **{c: row[c] for c in FIGURES}, "n_best": sums[0], "count_sum": sums[1],
                         "groups_sha256": row["groups_sha256"]})

    per_doc = made.drop("keys", "docs").groupBy("slice").cogroup(found.groupBy("of")).applyInArrow(
        finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                "groups_sha256 string")
    return per_doc, counts.select("a", "b", "n", "best")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return align(table(spark, sf_dir, "documents"))[0]
