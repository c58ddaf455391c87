"""Training order: token sequences in fixed-stride binary shards, shuffled by a keyed Feistel permutation.

1. Texts are tokenised (byte-level BPE), each followed by the end token, and the stream of each task is cut
   into sequences of ``length`` tokens; a task's last sequence is filled up with end tokens.
   The sequences are stored once in the shared work folder, so tokenising is not repeated.
2. Counting the sequences per task numbers them 0 .. N-1.  A Feistel network over the next even number of bits,
   walked until the value is below N (cycle-walking), is a keyed permutation of 0 .. N-1: it
   gives each sequence its slot in the training order, with no sort and no table.
3. Slots are cut into ranges of ``per_shard``; one shuffle brings a range together, and it is
   written as one file of ``per_shard`` x ``length`` 16-bit ids, little endian.  The place of slot s is therefore
   known: file s // per_shard, byte (s % per_shard) x stride.  A reader can begin or resume anywhere.

A file is written under another name and renamed, and its content follows from the input and
the key, so a task that is repeated after a lost executor writes the same file again.

Defined cases: a NULL or empty text gives its end token alone; an empty table gives no shard;
repeated rows are written each; a NULL id stays NULL in ``doc_ids``; other columns are ignored.
The documents have to be a stored table, read alike each time.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import U64, mix, over_texts, ship_code, table

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256
LENGTH = 2048
PER_SHARD = 1024
KEY = 0x5EED5EED
ROUNDS = 6
# Fixed value: the pattern that the vocabulary's merges were made for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def tokenizer(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def feistel(x: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """The keyed permutation of 0 .. n-1 (or its inverse) at ``x``."""
    x = np.asarray(x, dtype=U64)
    half = max(1, (max(1, int(n) - 1).bit_length() + 1) // 2)
    low = U64((1 << half) - 1)
    out = x.copy()
    todo = np.arange(len(x))
    rounds = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    while len(todo):
        left, right = out[todo] >> U64(half), out[todo] & low
        with np.errstate(over="ignore"):
            for r in rounds:
                salt = mix(np.array([(key * 0x9E3779B97F4A7C15 + r) & 0xFFFFFFFFFFFFFFFF], U64))
                if inverse:
                    left, right = right ^ (mix(left + salt) & low), left
                else:
                    left, right = right, left ^ (mix(right + salt) & low)
        out[todo] = (left << U64(half)) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


def sequences(df: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """``part``, ``number``, ``doc_ids`` (of the texts with a token inside), ``n_tokens``, ``ids`` (binary)."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def setup():
        encode = tokenizer(shared.value).encode_ordinary
        part = TaskContext.get().partitionId()
        state = {"number": 0, "left": np.zeros(0, np.uint16), "owners": []}  # owners: (doc, tokens)

        def cut(tokens, owners, real):
            """Rows of whole sequences; owners' token counts add up to the tokens."""
            n = len(tokens) // length
            ends = np.cumsum([c for _, c in owners])
            starts = ends - [c for _, c in owners]
            rows = {"part": [part] * n, "number": list(range(state["number"], state["number"] + n)), "doc_ids": [],
                    "n_tokens": [], "ids": []}
            for i in range(n):
                a, b = i * length, (i + 1) * length
                first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b)
                rows["doc_ids"].append([o for o, _ in owners[first:last]])
                rows["n_tokens"].append(max(0, min(b, real) - a))
                rows["ids"].append(tokens[a:b].tobytes())
            state["number"] += n
            used = n * length
            first = int(np.searchsorted(ends, used, side="right"))
            rest = [(o, int(min(c, e - used))) for (o, c), e in zip(owners[first:], ends[first:], strict=True)]
            state["left"], state["owners"] = tokens[used:], rest
            return rows

        def each(rows):
            owners, parts = state["owners"], [state["left"]]
            for doc, t in zip(rows["doc_id"], rows["text"], strict=True):
                ids = encode(t) if t else []
                ids.append(end)
                parts.append(np.array(ids, dtype="<u2"))
                owners.append((doc, len(ids)))
            tokens = np.concatenate(parts)
            return cut(tokens, owners, len(tokens))

        def last():
            real = len(state["left"])
            if not real:
                return None
            fill = np.full(length - real, end, "<u2")
            return cut(np.concatenate([state["left"], fill]), state["owners"], real)

        return each, last

    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return over_texts(used, "text", None, "part int, number long, doc_ids array<long>, n_tokens int, ids binary",
                      setup=setup)


def write_shards(df: DataFrame, path: str, vocabulary: str = VOCABULARY, length: int = LENGTH,
                 per_shard: int = PER_SHARD, permutation_key: int = KEY, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Shards under ``path`` (written when the result is computed); one row per sequence.

    ``slot``, ``shard`` (file name), ``byte_offset``, ``n_tokens`` (without filling), ``doc_ids``, ``sha256`` of its bytes.
    """
    spark = df.sparkSession
    stored = work_path(spark, "sequences")
    sequences(df, vocabulary, length, END, key, text).write.option("compression", "zstd").parquet(stored)
    made = spark.read.parquet(stored)
    counts = sorted((r.part, r.n) for r in made.groupBy("part").agg(F.count("*").alias("n")).collect())  # one per task
    first, total = {}, 0
    for part, n in counts:
        first[part] = total
        total += n
    shared = spark.sparkContext.broadcast(first)
    ship_code(spark)

    def place(batches):
        for b in batches:
            part, number = (b.column(i).to_numpy() for i in (0, 1))
            index = number + np.array([shared.value[p] for p in part.tolist()], np.int64)
            slot = feistel(index, total, permutation_key)
            yield pa.RecordBatch.from_pydict({
                "slot": slot, "shard": slot // per_shard, "doc_ids": b.column(2), "n_tokens": b.column(3),
                "packed": pa.array([zlib.compress(x, 1) for x in b.column(4).to_pylist()], pa.binary())})

    placed = made.select("part", "number", "doc_ids", "n_tokens", "ids").mapInArrow(
        place, "slot long, shard long, doc_ids array<long>, n_tokens int, packed binary")
    stride = 2 * length

    def write(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("slot")
        slots = rows.column("slot").to_numpy()
        shard = int(slots[0]) // per_shard
        files, folder = open_folder(path)
        files.create_dir(folder, recursive=True)
        name = f"shard-{shard:08d}.bin"
        data = [zlib.decompress(x.as_py()) for x in rows.column("packed")]
        unfinished = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with files.open_output_stream(unfinished) as out:
            for d in data:
                out.write(d)
        files.move(unfinished, f"{folder}/{name}")
        return pa.table({"slot": slots, "shard": pa.array([name] * len(slots)),
                         "byte_offset": (slots % per_shard) * stride, "n_tokens": rows.column("n_tokens"),
                         "doc_ids": rows.column("doc_ids"),
                         "sha256": pa.array([hashlib.sha256(d).hexdigest() for d in data])})

    return placed.groupBy("shard").applyInArrow(
        write, "slot long, shard string, byte_offset long, n_tokens int, doc_ids array<long>, sha256 string")


def open_folder(path: str):
    """File system and folder of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else os.path.abspath(path))


def read_slots(path: str, start: int, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> np.ndarray:
    """Sequences of slots start .. start+count-1, fewer at the end of the data: [sequence, token]."""
    from pyarrow import fs

    files, folder = open_folder(path)
    out, stride = [], 2 * length
    while count > 0:
        shard, inside = divmod(start, per_shard)
        name = f"{folder}/shard-{shard:08d}.bin"
        if files.get_file_info(name).type == fs.FileType.NotFound:
            break
        take = min(count, per_shard - inside)
        with files.open_input_file(name) as f:
            f.seek(inside * stride)
            got = np.frombuffer(f.read(take * stride), "<u2").reshape(-1, length)
        out.append(got)
        if len(got) < take:
            break
        start, count = start + take, count - take
    return np.concatenate(out) if out else np.zeros((0, length), "<u2")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards in the work folder; one row per sequence."""
    return write_shards(table(spark, sf_dir, "documents"), work_path(spark, "shards"))
