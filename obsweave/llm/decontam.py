"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edits.

A document leaks an item if some part of it is within ``max_edit_rate`` x the item's length edits
(insertions, deletions, substitutions of code points) of the item.  Case does not count: items and texts are
folded, code point by code point, so lengths and offsets stay those of the original (ss for a sharp s is two edits).

1. Windows.  An item allowed k edits is cut into k + 1 tiles; one of them survives any k
   edits unchanged.  So each place of a text that spells a tile of an item gives one
   window, as long as the item and starting where the item would; no leak lacks one.
   All places of all texts are looked up, by rolling hashes of 1, 2, 4, 8 or 16 characters.
2. CGK.  A random walk reads a window: at step t it writes the character under the pointer, and moves on
   if the random bit of (t, character) says so.  Windows that are few edits apart soon walk
   together again, so their embeddings differ at few steps: edit distance became Hamming distance.
3. LSH.  A repetition has its own walk and samples ``bits`` steps; a window goes on if it agrees with the item
   at all of them in at least one repetition.  The number of repetitions is planned for each length class (a power
   of two) from items with the most edits allowed: as many as bring the class's mean chance of a miss under
   1 - ``target_recall``.  Where ``MOST_REPETITIONS`` do not, or texts are too long to simulate, all windows
   of the class are verified; so they are already few.
4. Verification.  The smallest number of edits between the item and any part of the text around
   the window is computed exactly; pairs within the bound are returned.

Benchmark items are collected and broadcast, guarded by ``max_item_chars`` in all (an error
beyond it, never a cut).  Documents are scanned in place: there is no shuffle but that of the found pairs.

Defined cases: NULL or empty items and texts match nothing; repeated items with one id count once per id;
repeated document rows are found once per id; a NULL id is kept as NULL; other columns are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, over_texts, table

MAX_EDIT_RATE = 0.05
TARGET_RECALL = 0.99
BITS = 3
SEED = 11
MAX_ITEM_CHARS = 50_000_000
MOST_REPETITIONS = 64
SIMULATED_CHARS = 1 << 13  # items of more characters are not simulated: their windows are all verified
PENDING = 2_000  # windows embedded together
SCAN_CHARS = 2_000_000  # characters whose places are looked up together
_SIZES = (16, 8, 4, 2, 1)


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@functools.cache
def _folds() -> np.ndarray:
    """The folded form of each code point that may have case; one code point for one."""
    out = np.arange(0x20000, dtype=np.uint32)
    for i in range(len(out)):
        c = chr(i)
        out[i] = next((ord(f) for f in (c.casefold(), c.lower()) if len(f) == 1), i)
    return out


def fold(text: str) -> str:
    """The text without differences of case, of the same length."""
    if text.isascii():
        return text.lower()
    points, table_ = points_of(text), _folds()
    folded = np.where(points < len(table_), table_[np.minimum(points, len(table_) - 1)], points)
    return folded.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def rolling(points: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` characters from each place; ``size`` is a power of two."""
    with np.errstate(over="ignore"):
        h = (points.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15)
        step, width = U64(0xC2B2AE3D27D4EB4F), 1
        while width < size:
            h = h[:-width] * step + h[width:] if len(h) > width else h[:0]
            step = step * step + U64(2)
            width *= 2
        return h * U64(0xFF51AFD7ED558CCD)


@dataclass
class Index:
    ids: list[int | None]
    items: list[str]
    edits: list[int]
    repetitions: np.ndarray  # of each item; 0: all its windows are verified
    tiles: dict[int, tuple]  # size -> (filter, sorted hashes, item of each, place of each)


def build_index(items: list[tuple[int | None, str]], rate: float = MAX_EDIT_RATE, target: float = TARGET_RECALL,
                bits: int = BITS) -> Index:
    items = sorted({(i, fold(t)) for i, t in items if t}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    ids, texts = [i for i, _ in items], [t for _, t in items]
    edits = [int(rate * len(t)) for t in texts]
    found: dict[int, list] = {}
    for number, (t, k) in enumerate(zip(texts, edits, strict=True)):
        length = len(t) // (k + 1)
        size = next(s for s in _SIZES if s <= length)
        h = rolling(points_of(t), size)
        for tile in range(k + 1):
            found.setdefault(size, []).append((int(h[tile * length]), number, tile * length))
    tiles = {}
    for size, rows in found.items():
        rows.sort()
        hashes = np.array([r[0] for r in rows], U64)
        sieve = np.zeros(1 << 20, bool)
        sieve[(hashes >> U64(44)).astype(np.int64)] = True
        tiles[size] = (sieve, hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    return Index(ids, texts, edits, plan_repetitions(texts, edits, target, bits), tiles)


# -- CGK and bit sampling ------------------------------------------------------------


def sampled_steps(lengths: np.ndarray, repetition: int, bits: int) -> np.ndarray:
    """Steps that a repetition samples, for windows of these lengths: [window, bit], rising."""
    u = np.random.default_rng(SEED * 1009 + repetition).random(bits)
    return np.sort((u[None, :] * (2 * lengths[:, None])).astype(np.int64), 1)  # twice the length: a walk's mean end


def embed(windows: list[np.ndarray], repetition: int, bits: int = BITS,
          lengths: np.ndarray | None = None) -> np.ndarray:
    """The sampled characters of the walks over the windows: [window, bit]; 0 after a window's end.

    ``lengths`` decides the sampled steps (that of the item when a window is cut by its text's end).
    """
    sizes = np.array([len(w) for w in windows])
    lengths = sizes if lengths is None else lengths
    steps = sampled_steps(lengths, repetition, bits)
    flat = np.concatenate([*windows, np.zeros(1, np.uint32)])
    base = np.cumsum(sizes) - sizes
    pointer = np.zeros(len(windows), np.int64)
    out = np.zeros((len(windows), bits), np.uint32)
    last = int(steps.max(initial=-1))
    salt = U64(repetition + 1) * U64(0x9E3779B9)
    for t in range(last + 1):
        inside = pointer < sizes
        c = np.where(inside, flat[np.minimum(base + pointer, len(flat) - 1)], 0)
        out[steps == t] = np.broadcast_to(c[:, None], out.shape)[steps == t]
        with np.errstate(over="ignore"):
            bit = mix(c.astype(U64) * U64(0x100000001) + (U64(t) << U64(40)) + salt) & U64(1)
        pointer += (bit == 1) & inside
    return out


def collide(windows: list[np.ndarray], items: list[np.ndarray], repetitions: int | np.ndarray,
            bits: int = BITS) -> np.ndarray:
    """Which windows agree with their item in at least one of their repetitions, or have none to pass."""
    planned = np.broadcast_to(np.asarray(repetitions, np.int64), len(windows))
    hit = planned == 0
    for r in range(int(planned.max(initial=0))):
        todo = np.flatnonzero(~hit & (planned > r))
        if not len(todo):
            break
        lengths = np.array([len(items[i]) for i in todo])
        a = embed([windows[i] for i in todo], r, bits, lengths)
        b = embed([items[i] for i in todo], r, bits, lengths)
        hit[todo] = (a == b).all(1)
    return hit


def plan_repetitions(items: list[str], edits: list[int], target: float, bits: int, trials: int = 200,
                     tries: int = 12, most: int = MOST_REPETITIONS) -> np.ndarray:
    """For each item, the repetitions that its length class needs to miss a window with the most edits allowed
    with a mean chance of 1 - target at most; 0 if ``most`` are not enough, or the items too long to simulate.

    An item without edits needs one.  Each class has its own ``trials``, drawn from all its items.
    """
    out = np.ones(len(items), np.int64)
    classes: dict[int, list[int]] = {}
    for i, (t, k) in enumerate(zip(items, edits, strict=True)):
        if k > 0:
            classes.setdefault(len(t).bit_length(), []).append(i)
    for size, members in classes.items():
        long = max(len(items[i]) for i in members) > SIMULATED_CHARS
        out[members] = 0 if long else _class_repetitions(items, edits, members, target, bits, trials, tries, most, size)
    return out


def _class_repetitions(items: list[str], edits: list[int], members: list[int], target: float, bits: int, trials: int,
                       tries: int, most: int, size: int) -> int:
    rng = np.random.default_rng(SEED + size)
    chosen = np.resize(rng.permutation(members), trials).tolist()  # few items: each is edited in several ways
    windows, sources = [], []
    for i in chosen:
        p = points_of(items[i]).tolist()
        for _ in range(edits[i]):
            at, kind = int(rng.integers(0, len(p) + 1)), int(rng.integers(0, 3))
            if kind == 0:
                p.insert(at, int(rng.integers(97, 123)))
            elif at < len(p):
                p[at:at + 1] = [] if kind == 1 else [int(rng.integers(97, 123))]
        windows.append(np.array(p[:len(items[i])], np.uint32))
        sources.append(points_of(items[i]))
    lengths = np.array([len(s) for s in sources])
    missed = np.ones(len(windows))
    hits = np.zeros(len(windows))
    for r in range(tries):
        hits += (embed(windows, r, bits, lengths) == embed(sources, r, bits, lengths)).all(1)
    chance = (hits + 0.5) / (tries + 1)  # per window, as some edits are harder than others
    for r in range(1, most + 1):
        missed = missed * (1 - chance)
        if missed.mean() <= 1 - target:
            return r
    return 0


# -- verification --------------------------------------------------------------------


def least_edits(item: str, text: str, most: int) -> tuple[int, int] | None:
    """Fewest edits between the item and any part of the text, and the end of that part; None beyond ``most``.

    Bit-parallel: one machine-independent integer holds a column of the table.
    """
    at = text.find(item)
    if at >= 0:
        return 0, at + len(item)
    m = len(item)
    places: dict[str, int] = {}
    for i, c in enumerate(item):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = (m, 0)
    for end, c in enumerate(text, 1):
        eq = places.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        score += bool(ph & top) - bool(mh & top)
        ph = ph << 1 & full
        mh = mh << 1 & full
        up = mh | (full & ~(xv | ph))
        down = ph & xv
        if score < best[0]:
            best = (score, end)
    return best if best[0] <= most else None


# -- the scan ------------------------------------------------------------------------


def candidates(texts: list[str | None], index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, start) of all windows that a tile calls for; starts may be before the text's."""
    kept = [t or "" for t in texts]
    points = points_of("\0".join(kept))
    sizes = np.array([len(t) for t in kept])
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    found = []
    for size, (sieve, hashes, item, offset) in index.tiles.items():
        h = rolling(points, size)
        at = np.flatnonzero(sieve[(h >> U64(44)).astype(np.int64)])
        low, high = np.searchsorted(hashes, h[at]), np.searchsorted(hashes, h[at], side="right")
        many = high - low
        at = np.repeat(at, many)
        if not len(at):
            continue
        row = np.repeat(low, many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        owner = np.searchsorted(first, at, side="right") - 1
        inside = at + size <= first[owner] + sizes[owner]  # a tile does not cross texts
        start = at - first[owner] - offset[row]
        found.append(np.stack([owner, item[row], start])[:, inside])
    if not found:
        return tuple(np.zeros((3, 0), np.int64))
    return tuple(np.unique(np.concatenate(found, 1), axis=1))


def windows_of(points: np.ndarray, start: int, n: int) -> np.ndarray:
    return points[max(0, start):max(0, start + n)]


class Scanner:
    """Collects windows over slices, so that walks are vectorised over many of them."""

    def __init__(self, index: Index, bits: int = BITS):
        self.index, self.bits, self.items = index, bits, [points_of(t) for t in index.items]
        self.waiting: list[tuple] = []

    def add(self, ids: list, texts: list[str | None]) -> dict | None:
        texts = [fold(t or "") for t in texts]
        owner, item, start = candidates(texts, self.index)
        for o, i, s in zip(owner.tolist(), item.tolist(), start.tolist(), strict=True):
            n, k = len(self.index.items[i]), self.index.edits[i]
            a = max(0, s - k)
            region = texts[o][a:max(a, s + n + k)]
            self.waiting.append((ids[o], i, region, s - a, a))
        return self.flush() if len(self.waiting) >= PENDING else None

    def flush(self) -> dict:
        out = {"doc_id": [], "item_id": [], "edits": [], "end": []}
        rows, self.waiting = self.waiting, []
        for at in range(0, len(rows), PENDING):
            part = rows[at:at + PENDING]
            windows = [windows_of(points_of(r), s, len(self.items[i])) for _, i, r, s, _ in part]
            numbers = [i for _, i, *_ in part]
            near = collide(windows, [self.items[i] for i in numbers], self.index.repetitions[numbers], self.bits)
            for (key, i, region, _, a), hit in zip(part, near, strict=True):
                if hit and (best := least_edits(self.index.items[i], region, self.index.edits[i])):
                    out["doc_id"].append(key)
                    out["item_id"].append(self.index.ids[i])
                    out["edits"].append(best[0])
                    out["end"].append(a + best[1])
        return out


def leaking(texts: list[str | None], index: Index, bits: int = BITS) -> set[int]:
    """Numbers of the texts that hold an item; the windows of all of them walk together."""
    scanner, hit = Scanner(index, bits), set()
    ends = np.cumsum([len(t or "") for t in texts])
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SCAN_CHARS, side="right")))
        if found := scanner.add(list(range(start, stop)), texts[start:stop]):
            hit.update(found["doc_id"])
        start = stop
    return hit.union(scanner.flush()["doc_id"])


def read_items(df: DataFrame, key: str = "item_id", text: str = "text", max_chars: int = MAX_ITEM_CHARS):
    """All items; their size is checked before they are collected."""
    used = df.select(F.col(f"`{key}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text")).where(
        "length(text) > 0")
    size = used.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    if size > max_chars:
        raise ValueError(f"the benchmark has {size} characters, over max_item_chars={max_chars}")
    return [(r.item_id, r.text) for r in used.collect()]


def find_leaks(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
               max_edit_rate: float = MAX_EDIT_RATE, target_recall: float = TARGET_RECALL,
               bits: int = BITS) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits`` (the fewest), ``end`` (of the first such part, in code points)."""
    index = build_index(read_items(items), max_edit_rate, target_recall, bits)
    shared = df.sparkSession.sparkContext.broadcast(vars(index))

    def setup():
        scanner = Scanner(Index(**shared.value), bits)
        return (lambda rows: scanner.add(rows["doc_id"], rows["text"])), scanner.flush

    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = over_texts(used, "text", None, "doc_id long, item_id long, edits long, end long", setup=setup)
    return found.groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "end")).alias("m")).select(
        "doc_id", "item_id", "m.edits", "m.end")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; a NULL id cannot be named and its rows are judged by their text."""
    used = docs.select("doc_id", "text", "lang", "source", "n_chars")
    index = build_index(read_items(table(spark, sf_dir, "benchmark")))
    shared = spark.sparkContext.broadcast(vars(index))

    def setup():
        index = Index(**shared.value)

        def each(rows):
            hit = leaking(rows["text"], index)
            return {k: [x for i, x in enumerate(v) if i not in hit] for k, v in rows.items()}

        return each, None

    return over_texts(used, "text", None, used.schema, limit=8 * SCAN_CHARS, setup=setup)
