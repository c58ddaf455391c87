"""Cost-balanced packing of token streams into sequences of a fixed capacity.

1. Texts are tokenised (byte-level BPE, ids by ``tokenizers``), each followed by the end id, and cut into pieces of at
   most ``length`` tokens.  Equal words are encoded once per task (see ``units``); a special token's string in a text
   becomes that token, as the library does by default.
2. Pieces are dealt into pools by a hash of row and place.  The number of pools follows from the bytes of all texts, so
   a pool has about ``POOL_BYTES`` of text at every size; long documents and hot sources are spread over pools.
3. In a pool the tokens fill T // length sequences of full capacity, and the rest sequences whose capacities are the
   powers of two of T % length, so that nothing is padded.  Pieces go, by falling cost (``linear`` x tokens
   + ``quadratic`` x tokens squared, the attention of a piece within itself), to the sequence of lowest cost that has
   room for them; a piece that fits nowhere fills the cheapest one with room left, and its rest waits in line
   by its own cost.  The short sequences of the rest are filled last.

A pool is one group of bounded size; nothing is sorted globally and nothing reaches the driver but the sum of bytes.
Pools are random samples of all pieces, so their costs per sequence agree up to chance.

Defined cases: a NULL or empty text gives the end id alone; repeated rows (and rows with one or no id) are packed each;
equal costs are taken in the order of row and place; other columns are ignored; an empty table gives no row.
The documents have to be a stored table, read alike when a task is repeated.
"""

from __future__ import annotations

import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import over_texts, ship_code, table
from .units import UnitCache, units_of

VOCABULARY = "byte_bpe_50k.json"
END = 1
LENGTH = 2048
#: Bytes of text whose tokens are packed together.
POOL_BYTES = 4_000_000
#: Parts that are encoded in one call.
AT_ONCE = 5000
LINEAR, QUADRATIC = 6144, 1


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level BPE: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(others)}}


@functools.cache
def word_encoder(path: str):
    """One per worker process: texts -> one little-endian 16-bit array of ids each."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.get_vocab_size() > 1 << 16:
        raise ValueError("ids do not fit into 16 bits")

    alphabet = byte_alphabet()
    width = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        width[i] = len(token) if all(c in alphabet for c in token) else len(token.encode())

    def raw(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    def together(units: list[str]) -> list[bytes]:
        """Parts are encoded as long texts; the bytes of the tokens tell which part each belongs to."""
        out: list[bytes] = []
        for start in range(0, len(units), AT_ONCE):
            some = [f" {u}" for u in units[start:start + AT_ONCE]]
            ids = np.array(tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids, "<u2")
            ends = np.cumsum([len(u) if u.isascii() else len(u.encode()) for u in some])
            cuts = [0, *(2 * np.searchsorted(np.cumsum(width[ids]), ends, side="right")).tolist()]
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    inner = UnitCache(together)

    def encode(texts: list[str | None]) -> list[np.ndarray]:
        lists = [units_of(t) if t else [] for t in texts]
        inner.learn(u[1:] for u in lists)
        first = iter(raw([u[0] for u in lists if u]))
        return [np.frombuffer(b"".join([next(first), *map(inner.__getitem__, u[1:])]) if u else b"", "<u2")
                for u in lists]

    return encode


def pieces(df: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row``, ``doc_id``, ``start``, ``doc_tokens``, ``ids`` (16 bits each, little endian): at most ``length`` ids."""
    path = path or vocabulary_path(VOCABULARY)

    def setup():
        encode = word_encoder(path)
        base, seen = TaskContext.get().partitionId() << 33, [0]

        def each(rows):
            out = {"row": [], "doc_id": [], "start": [], "doc_tokens": [], "ids": []}
            for doc, ids in zip(rows["doc_id"], encode(rows["text"]), strict=True):
                ids = np.append(ids, np.array([end], "<u2"))
                for start in range(0, len(ids), length):
                    out["row"].append(base + seen[0])
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["doc_tokens"].append(len(ids))
                    out["ids"].append(ids[start:start + length].tobytes())
                seen[0] += 1
            return out

        return each, None

    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return over_texts(used, "text", None, "row long, doc_id long, start long, doc_tokens long, ids binary", setup=setup)


def cost(tokens: int, linear: int = LINEAR, quadratic: int = QUADRATIC) -> int:
    return linear * tokens + quadratic * tokens * tokens


class _Bins:
    """Sequences by room left, each kind a heap by cost; a tree over the kinds finds the cheapest with enough room."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.heaps = [[] for _ in range(self.leaves)]
        self.tree: list[tuple | None] = [None] * (2 * self.leaves)

    def _changed(self, room: int) -> None:
        tree, at = self.tree, room + self.leaves
        tree[at] = self.heaps[room][0] if self.heaps[room] else None
        while at > 1:
            at >>= 1
            left, right = tree[2 * at], tree[2 * at + 1]
            tree[at] = right if left is None or (right is not None and right < left) else left

    def add(self, room: int, cost: int, number: int) -> None:
        heapq.heappush(self.heaps[room], (cost, number, room))
        self._changed(room)

    def take(self, least: int) -> tuple[int, int, int] | None:
        """Remove and return (cost, number, room) of the cheapest sequence with room for ``least`` tokens."""
        best, lo, hi = None, least + self.leaves, 2 * self.leaves
        while lo < hi:
            if lo & 1:
                best = _less(best, self.tree[lo])
                lo += 1
            if hi & 1:
                hi -= 1
                best = _less(best, self.tree[hi])
            lo, hi = lo >> 1, hi >> 1
        if best is not None:
            heapq.heappop(self.heaps[best[2]])
            self._changed(best[2])
        return best


def _less(a: tuple | None, b: tuple | None) -> tuple | None:
    return b if a is None or (b is not None and b < a) else a


def capacities(tokens: int, length: int = LENGTH) -> list[int]:
    """Full sequences, then powers of two for the rest."""
    full, rest = divmod(tokens, length)
    return [length] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(sizes: list[int], length: int = LENGTH, linear: int = LINEAR,
           quadratic: int = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(item, start in the item, tokens, sequence, offset there): every token of every item in one place."""
    rooms = capacities(sum(sizes), length)
    full = sum(r == length for r in rooms)
    bins = _Bins(length)
    for number in range(full):
        bins.add(length, 0, number)
    tails = [(number, rooms[number]) for number in range(full, len(rooms))]
    waiting = [(-n, item, 0) for item, n in enumerate(sizes) if n]
    heapq.heapify(waiting)
    out = []
    while waiting:
        negative, item, start = heapq.heappop(waiting)
        n = -negative
        found = bins.take(n) or bins.take(1)
        if found is None:  # the full sequences are full: the rest in the short ones
            number, room = tails[0]
            put = min(n, room)
            tails[0] = (number, room - put)
            if put == room:
                tails.pop(0)
        else:
            spent, number, room = found
            put = min(n, room)
            if room > put:
                bins.add(room - put, spent + cost(put, linear, quadratic), number)
        out.append((item, start, put, number, rooms[number] - room))
        if n > put:
            heapq.heappush(waiting, (put - n, item, start + put))
    return out


def pack(df: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, pool_bytes: int = POOL_BYTES,
         linear: int = LINEAR, quadratic: int = QUADRATIC, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.

    ``ids`` has 32 bits each, little endian; a sequence is its pieces by ``offset``.  ``sequence_tokens`` is the tokens in the
    sequence: ``length``, or a power of two below it.  ``sequence_cost`` is its cost.
    """
    spark = df.sparkSession
    ship_code(spark)
    # two numbers reach the driver; the end ids count as bytes too
    total = df.agg(F.sum(F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)) + 1)).first()[0] or 0
    pools = max(1, -(-total // pool_bytes))

    def fill(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by([("row", "ascending"), ("start", "ascending")])
        data = t.column("ids").to_pylist()
        placed = assign([len(d) // 2 for d in data], length, linear, quadratic)
        item, start, size, number, offset = (np.array(x, np.int64) for x in zip(*placed, strict=True))
        used, spent = np.bincount(number, size).astype(np.int64), np.zeros(number.max() + 1, np.int64)
        np.add.at(spent, number, linear * size + quadratic * size * size)
        of = t.take(pa.array(item))
        ids = [np.frombuffer(data[i], "<u2")[s:s + n].astype("<u4").tobytes()
               for i, s, n in zip(item.tolist(), start.tolist(), size.tolist(), strict=True)]
        return pa.table({
            "doc_id": of.column("doc_id"), "start": of.column("start").to_numpy() + start, "length": size,
            "doc_tokens": of.column("doc_tokens"), "sequence_id": (of.column("pool").to_numpy() << 32) + number,
            "offset": offset, "sequence_tokens": used[number], "sequence_cost": spent[number],
            "ids": pa.array(ids, pa.binary())})

    dealt = pieces(df, path, length, end, key, text).withColumn("pool", F.pmod(F.xxhash64("row", "start"), F.lit(pools)))
    return dealt.groupBy("pool").applyInArrow(
        fill, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
              "sequence_tokens long, sequence_cost long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed; the ids as a checksum."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_tokens", "sequence_cost")
