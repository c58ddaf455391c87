"""Sampled subword segmentation: forward filtering and backward sampling over the piece lattice.

The probability of a segmentation is proportional to the product of its pieces' weights to
the power ``alpha``.  Forward sums run over all segmentations; pieces are then drawn from the
end backwards, each with its exact conditional probability.  The random numbers come from
(seed, row key, place in the text), so a row is segmented alike on every machine and retry.

No piece of the vocabulary has a space after another character or spans a line feed, so the
lattice of a text falls apart exactly into units, a run of spaces with the word after it.
The lattice of each different unit of a slice is built once; all its occurrences draw
from it, each with its own numbers.  A vocabulary with other pieces makes the whole text one unit.

Lossless: a space in a piece stands for a space, nothing is normalised or put in front, and a
character without a piece of its own becomes the byte pieces of its UTF-8 form.

Weights: those of a unigram model are its log probabilities.  A merge list has no
probabilities; there piece ``r`` of the list weighs 1 / (r + 10) (Zipf's law).

Defined cases: NULL or empty text gives no pieces and decodes to the empty text; rows of the
same key and text are segmented alike; a NULL key counts as 0; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, mix, over_texts, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 20240607
SPACE = "▁"

@dataclass
class Vocabulary:
    pieces: list[bytes]            # bytes that each id stands for; empty for control pieces
    texts: dict[str, int]          # normal pieces by text
    log_weight: np.ndarray
    byte_ids: list[int]
    longest: int
    by_unit: bool

    def __post_init__(self):
        self.sizes = np.array([len(p) for p in self.pieces], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.data = np.frombuffer(b"".join(self.pieces) + b"\0", np.uint8)
        words = list(self.texts)
        ids = np.array([self.texts[p] for p in words], np.int64)
        keys = np.array([_hash_text(p) for p in words], U64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a 64-bit hash")
        bits = max(16, int(len(words) * 8).bit_length())
        self.shift = U64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        # open addressing by hand is not needed: collisions go to a small dictionary
        self.keys = keys
        self.rest: dict[int, int] = {}
        for i, slot in enumerate((keys >> self.shift).astype(np.int64).tolist()):
            if self.slots[slot] < 0:
                self.slots[slot] = i
            else:
                self.rest[int(keys[i])] = i
        self.rest_keys = np.array(sorted(self.rest), U64)
        self.rest_rows = np.array([self.rest[k] for k in sorted(self.rest)], np.int64)
        self.ids = ids

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Piece ids by hash, -1 where there is none."""
        row = self.slots[(keys >> self.shift).astype(np.int64)]
        found = (row >= 0) & (self.keys[row] == keys)
        out = np.where(found, self.ids[row], -1)
        if len(self.rest_keys):
            open_ = np.flatnonzero((row >= 0) & ~found)
            at = np.minimum(np.searchsorted(self.rest_keys, keys[open_]), len(self.rest_keys) - 1)
            hit = self.rest_keys[at] == keys[open_]
            out[open_[hit]] = self.ids[self.rest_rows[at[hit]]]
        return out


_STEP = U64(0x100000001B3)


def _hash_text(piece: str) -> int:
    h = U64(0)
    with np.errstate(over="ignore"):
        for c in piece:
            h = h * _STEP + U64(ord(c) + 1)
    return int(mix(h))


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Pieces and weights of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, texts, scores, byte_ids = [], {}, [], [-1] * 256
    merges = 0
    for i in range(model.vocab_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(name[3:5], 16)
            byte_ids[value] = i
            pieces.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            text = name.replace(SPACE, " ")
            pieces.append(text.encode())
            texts[text] = i
        scores.append(model.get_score(i))
    merges = sum(s == -r for r, s in enumerate(scores[i] for i in texts.values()))
    if merges > len(texts) // 2:  # a merge list: scores are minus the rank
        log_weight = np.array([-np.log(10.0 - s) for s in scores])
    else:
        log_weight = np.array(scores, float)
    if min(byte_ids) < 0:
        raise ValueError("the vocabulary has no byte pieces, so it cannot be lossless")
    by_unit = not any(re.search(r"[^ ] |\n.|.\n", t, re.DOTALL) for t in texts)
    return Vocabulary(pieces, texts, log_weight, byte_ids, max(map(len, texts)), by_unit)


_UNIT = re.compile(r" *[^ \n]+| +|\n")


class Lattice:
    """Edges of all different units of a slice.

    A node is the end of a character.  Nodes are laid out place by place, longest units first,
    so that all units are filtered together over contiguous ranges.
    """

    def __init__(self, units: list[str], voc: Vocabulary, alpha: float):
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        n, width = len(points), voc.longest
        first = np.cumsum(sizes) - sizes
        self.sizes, self.rank = sizes, np.empty(len(units), np.int64)
        self.rank[np.argsort(-sizes, kind="stable")] = np.arange(len(units))
        alive = len(units) - np.cumsum(np.bincount(sizes))[:-1] if n else np.zeros(0, np.int64)  # units beyond a place
        self.base = np.cumsum(alive) - alive
        place = np.arange(n) - np.repeat(first, sizes)
        self.points = np.empty(n, np.uint32)
        self.points[self.base[place] + np.repeat(self.rank, sizes)] = points
        base, alive = self.base.tolist(), alive.tolist()
        self.piece = np.full((width, n), -1, np.int32)  # by length - 1 and end node
        code = self.points.astype(U64) + U64(1)
        with np.errstate(over="ignore"):
            for start, count in enumerate(alive):
                h = np.zeros(count, U64)
                for length in range(1, min(width, len(alive) - start) + 1):
                    end = start + length - 1
                    c, at = alive[end], base[end]
                    h = h[:c] * _STEP + code[at:at + c]
                    self.piece[length - 1, at:at + c] = voc.look_up(mix(h))
        self.bare = self.piece[0] < 0  # characters that only byte pieces can cover
        weights = np.append(np.exp(voc.log_weight * alpha), 0.0)  # the last is that of no piece
        spelled = np.zeros(0)
        if self.bare.any():
            lengths = [len(chr(c).encode("utf-8", "surrogatepass")) for c in self.points[self.bare].tolist()]
            spelled = float(weights[voc.byte_ids[0]]) ** np.array(lengths)
        self.cumulative = self._filter(weights, spelled, alive, base)

    def _filter(self, weights, spelled, alive, base) -> np.ndarray:
        """Forward sums, and for each node the running share of each last piece's length."""
        width, n = self.piece.shape
        forward = np.empty(n)
        running = np.zeros((width, n), np.float32)
        single = weights[self.piece[0]]
        single[self.bare] = spelled
        for p, (at, c) in enumerate(zip(base, alive, strict=True)):
            here = slice(at, at + c)
            sums = []
            total = 0.0
            for length in range(1, min(width, p + 1) + 1):
                w = single[here] if length == 1 else weights[self.piece[length - 1, here]]
                if length <= p:
                    w = w * forward[base[p - length]:base[p - length] + c]
                elif p >= width:
                    continue
                total = total + w
                sums.append(total)
            for k, part in enumerate(sums):
                running[k, here] = part / total
            running[len(sums):, here] = 1.0
            forward[here] = total
            if p % width == width - 1:  # ratios are all that counts: keep the sums near 1
                for back in range(width):
                    forward[base[p - back]:base[p - back] + c] /= total
        return np.ascontiguousarray(running.T)

    def sample(self, unit: np.ndarray, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pieces of each occurrence, seeded by its key.

        Round k gives the k-th piece from the end of every occurrence that has one:
        (occurrences, ids); a character without a piece is told as -1 - its node.
        """
        rank, place = self.rank[unit], self.sizes[unit] - 1
        who = np.arange(len(unit))
        rounds = []
        step = U64(0)
        while len(who):
            with np.errstate(over="ignore"):
                u = (mix(keys[who] + step * U64(0xD1342543DE82EF95)) >> U64(40)).astype(np.float32)
            u = (u + np.float32(0.5)) / np.float32(1 << 24)
            node = self.base[place] + rank
            k = (self.cumulative[node] < u[:, None]).sum(1)
            rounds.append((who, np.where(self.bare[node] & (k == 0), -1 - node, self.piece[k, node])))
            place = place - k - 1
            more = place >= 0
            who, place, rank = who[more], place[more], rank[more]
            step += U64(1)
        return rounds


def encode(texts: list[str | None], keys: np.ndarray, voc: Vocabulary, alpha: float = ALPHA,
           seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of all texts in one array, and the start of each text in it (plus the end)."""
    number: dict[str, int] = {}
    counts, flat = [], []
    for t in texts:
        units = (_UNIT.findall(t) if voc.by_unit else [t]) if t else []
        counts.append(len(units))
        flat += [number.setdefault(u, len(number)) for u in units]
    counts = np.array(counts, np.int64)
    if not flat:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    unit = np.array(flat, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(unit)) - np.repeat(first[:-1], counts)
    with np.errstate(over="ignore"):
        row_key = mix(np.asarray(keys).astype(np.int64).view(U64) + mix(np.array([seed], U64)))
        unit_keys = mix(np.repeat(row_key, counts) + place.astype(U64) * U64(0x9E3779B97F4A7C15))
    lattice = Lattice(list(number), voc, alpha)
    rounds = []
    total = np.zeros(len(unit), np.int64)
    for who, ids in lattice.sample(unit, unit_keys):
        many = np.ones(len(ids), np.int64)
        odd = np.flatnonzero(ids < 0)
        spelled = [chr(lattice.points[-1 - i]).encode("utf-8", "surrogatepass") for i in ids[odd].tolist()]
        many[odd] = [len(b) for b in spelled]
        total[who] += many
        rounds.append((who, ids, many, odd, spelled))
    ends = np.cumsum(total)
    left = ends.copy()
    out = np.empty(int(ends[-1]), np.int32)
    for who, ids, many, odd, spelled in rounds:
        left[who] -= many
        at = left[who]
        out[at] = ids
        for i, raw in zip(odd.tolist(), spelled, strict=True):
            out[at[i]:at[i] + len(raw)] = [voc.byte_ids[x] for x in raw]
    ends = np.concatenate([[0], ends])
    text_ends = ends[first]
    return out, text_ends


def decode(ids: np.ndarray, starts: np.ndarray, voc: Vocabulary) -> list[bytes]:
    """UTF-8 bytes of each text."""
    sizes = voc.sizes[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(voc.offsets[ids] - ends[:-1], sizes) + np.arange(ends[-1])
    data = voc.data[source].tobytes()
    at = ends[starts].tolist()
    return [data[a:b] for a, b in zip(at, at[1:], strict=False)]


def segment(df: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text",
            alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``pieces`` (ids), ``n_pieces``, ``lossless`` (decoding gave the text again).

    The vocabulary is read on the driver and broadcast: its size is that of the model file.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(vars(read_vocabulary(vocabulary)))

    def setup():
        voc = object.__new__(Vocabulary)
        voc.__dict__.update(shared.value)

        def each(rows):
            texts = rows["text"]
            keys = np.array([k or 0 for k in rows["doc_id"]], np.int64)
            ids, starts = encode(texts, keys, voc, alpha, seed)
            same = [d == (t or "").encode() for d, t in zip(decode(ids, starts, voc), texts, strict=True)]
            return {"doc_id": rows["doc_id"],
                    "pieces": pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())).cast(
                        pa.list_(pa.field("element", pa.int32(), nullable=True))),
                    "n_pieces": np.diff(starts), "lossless": same}

        return each, None

    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return over_texts(used, "text", None, "doc_id long, pieces array<int>, n_pieces long, lossless boolean",
                      limit=1_000_000, setup=setup)


def decoded(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``pieces``; a NULL list is the empty text."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary).pieces)

    def each(rows):
        pieces = shared.value
        return {"doc_id": rows["doc_id"], "text": [b"".join(pieces[i] for i in json_ids(p)).decode("utf-8")
                                                   for p in rows["p"]]}

    return over_texts(df.select("doc_id", F.concat_ws(",", F.col("pieces").cast("array<string>")).alias("p")), "p",
                      each, "doc_id long, text string")


def json_ids(joined: str | None) -> list[int]:
    return [int(x) for x in joined.split(",")] if joined else []


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document."""
    return segment(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return segment(docs)
