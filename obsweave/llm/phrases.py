"""Phrases that occur together more often than their parts: counted over a prefix-free parse of the corpus.

1. Texts are lower-cased (A-Z), split into pieces at punctuation and line ends, and pieces into words.  A new chunk
   begins where the hash of a word and the word before says so, with each text, and after ``CHUNK_WORDS`` words; it
   carries the next ``MOST - 1`` words, as far as its last piece goes on, as overlap.  Equal content is therefore cut alike
   everywhere, and repeated passages become the same chunks.  The dictionary of distinct chunks with their frequencies is stored.
2. n-grams are counted inside the distinct chunks, weighted by frequency.  An n-gram belongs to the chunk that owns its first
   word, so each occurrence counts once.  Lengths are counted one after the other: an n-gram is looked at only if both n-grams one
   word shorter are in a bit map of those frequent enough.  The bit map has one size (16 MB) for every corpus; a
   false hit costs a count that is dropped later, and nothing is lost.  Tasks add up equal n-grams before the shuffle.
3. Parts of a frequent phrase are at least as frequent, so the counts kept hold every l and r.  Scores are quotients of 38-digit decimals.
   A phrase lies inside a longer one of equal count exactly if it is the beginning or the end of a phrase one word
   longer with that count, as counts only fall along the way.

Keys of counts are the phrases themselves, not hashes.  Nothing of the corpus reaches the driver but the bit map.

Defined cases: NULL and empty texts have no words; a NULL lang is ``und`` (and one with documents named so); repeated rows
count as often as they occur; equal scores are ordered by a, then by the bytes of the phrase; other columns are ignored;
an empty table gives no row.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from ..session import spool
from .common import U64, as_batch, mix, over_texts, ship_code, slices, table, word_hashes

LEAST, MOST, TOP = 100, 5, 2000
UNKNOWN = "und"
#: One word in so many begins a chunk; a chunk owns at most so many words.
TRIGGER, CHUNK_WORDS = 32, 128
BITS = 27
#: Distinct keys that a task adds up before it sends them on.
HELD = 400_000
#: Parts of a lang whose first phrases are ranked on their own.
PARTS = 64

_PREPARE = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")
_BLANKS = re.compile(rb"[ \n]{2,}")


class _Words:
    """The words of lines (pieces) of bytes that end with a line feed: hashes, places, and where their line stops."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        self.raw = raw
        self.hashes, self.starts = word_hashes(data)
        blank = (data == 32) | (data == 10)
        self.ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        line = np.searchsorted(np.flatnonzero(data == 10), self.starts)
        self.stop = np.searchsorted(line, line, side="right")


def _lists_by(keys: list, values: list) -> dict:
    out = defaultdict(list)
    for k, v in zip(keys, values, strict=True):
        out[k].append(v)
    return out


def chunks_of(texts: list[str]) -> list[tuple[int, bytes]]:
    """Every chunk of the texts: (words of overlap, words with a space or line feed after each; a line is a piece)."""
    clean = [_BLANKS.sub(lambda m: b"\n" if b"\n" in m[0] else b" ", t.encode().translate(_PREPARE) + b"\n").lstrip()
             for t in texts]
    w = _Words(b"".join(clean))
    n = len(w.starts)
    if not n:
        return []
    index = np.arange(n)
    begins = np.zeros(n + 1, bool)
    begins[np.searchsorted(w.starts, np.cumsum([0, *map(len, clean)]))] = True
    begins = begins[:-1]
    with np.errstate(over="ignore"):
        begins[1:] |= mix(w.hashes[:-1] * U64(3) + w.hashes[1:]) % U64(TRIGGER) == 0
    since = index - np.maximum.accumulate(np.where(begins, index, 0))
    first = np.flatnonzero(begins | (since % CHUNK_WORDS == 0))
    after = np.append(first[1:], n)
    over = np.clip(w.stop[after - 1] - after, 0, MOST - 1)
    return [(o, w.raw[a:b] + b"\n") for o, a, b in zip(over.tolist(), w.starts[first].tolist(),
                                                      w.ends[after + over - 1].tolist(), strict=True)]


class _Sums:
    """Counts by (lang, key), given out when there are many."""

    def __init__(self, row):
        self.row, self.counts = row, defaultdict(lambda: defaultdict(int))

    def give(self, last: bool = False):
        if not last and sum(map(len, self.counts.values())) < HELD:
            return None
        out = [self.row(lang, key, n) for lang, by_key in self.counts.items() for key, n in by_key.items()]
        self.counts.clear()
        return out or None


def dictionary(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``over``, ``chunk``, ``times``: the distinct chunks; lazily."""

    def setup():
        sums = _Sums(lambda lang, key, n: (lang, *key, n))

        def give(last):
            got = sums.give(last)
            return got and dict(zip(("lang", "over", "chunk", "times"), map(list, zip(*got, strict=True)), strict=True))

        def each(rows):
            for lang, texts in _lists_by(rows["lang"], rows["text"]).items():
                into = sums.counts[lang]
                for key in chunks_of(texts):
                    into[key] += 1
            return give(False)

        return each, lambda: give(True)

    used = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    made = over_texts(used, "text", None, "lang string, over int, chunk binary, times long", setup=setup)
    return made.groupBy("lang", "over", "chunk").agg(F.sum("times").alias("times"))


def _seed(lang: str) -> np.ndarray:
    return np.array([zlib.crc32(lang.encode())], U64)


def _gram_bits(lang: str, columns: list[np.ndarray]) -> np.ndarray:
    """Places in the bit map, from the hashes of the 1st, 2nd, ... words."""
    g = _seed(lang)
    with np.errstate(over="ignore"):
        for h in columns:
            g = mix(g * U64(0x9E3779B97F4A7C15) + h)
    return g >> U64(64 - BITS)


def ngrams(stored: DataFrame, words: int, shorter: bytes | None) -> DataFrame:
    """``lang``, ``phrase``, ``n`` of the n-grams whose parts are in the packed bit map ``shorter`` (None: all)."""
    shared = stored.sparkSession.sparkContext.broadcast(shorter)

    arrow = to_arrow_schema(T._parse_datatype_string("lang string, phrase binary, n long"))

    def count(batches):
        packed = shared.value and np.frombuffer(zlib.decompress(shared.value), np.uint8)
        sums = _Sums(lambda lang, key, n: (lang, key, n))
        for batch in batches:
            for part in slices(batch, "chunk"):
                for lang, rows in _by_lang(part):
                    _count(sums.counts[lang], lang, rows, words, packed)
                if (got := sums.give()) is not None:
                    yield as_batch(dict(zip(arrow.names, map(list, zip(*got, strict=True)), strict=True)), arrow)
        if (got := sums.give(True)) is not None:
            yield as_batch(dict(zip(arrow.names, map(list, zip(*got, strict=True)), strict=True)), arrow)

    return stored.select("lang", "over", "chunk", "times").mapInArrow(count, "lang string, phrase binary, n long")


def _by_lang(batch: pa.RecordBatch):
    langs = batch.column(0)
    for lang in langs.unique():
        yield lang.as_py(), batch.filter(pc.equal(langs, lang))


def _count(into: dict, lang: str, rows: pa.RecordBatch, words: int, packed: np.ndarray | None) -> None:
    over, times = (rows.column(i).to_numpy() for i in (1, 3))
    chunks = rows.column(2)
    w = _Words(b"".join(chunks.to_pylist()))
    bounds = np.cumsum(pc.binary_length(chunks).to_numpy())
    chunk = np.searchsorted(bounds, w.starts, side="right")
    owned = np.searchsorted(w.starts, bounds)[chunk] - over[chunk]
    index = np.arange(len(w.starts))
    good = (index < owned) & (index + words <= w.stop)
    if packed is not None:
        many = max(0, len(index) - words + 2)  # the n-grams one word shorter
        bits = _gram_bits(lang, [w.hashes[k:k + many] for k in range(words - 1)])
        known = np.zeros(len(index) + 1, bool)
        known[:len(bits)] = packed[bits >> U64(3)] >> (bits & U64(7)).astype(np.uint8) & 1
        good &= known[:-1] & known[1:]
    first = np.flatnonzero(good)
    raw = w.raw
    for a, b, n in zip(w.starts[first].tolist(), w.ends[first + words - 1].tolist(), times[chunk[first]].tolist(), strict=True):
        into[raw[a:b]] += n


def bit_map(frequent: DataFrame, words: int) -> bytes:
    """The n-grams' places as a compressed bit map of fixed size; bytes are put together by the executors."""
    arrow = to_arrow_schema(T._parse_datatype_string("place int, bits int"))

    def places(batches):
        for batch in batches:
            for part in slices(batch, "phrase"):
                for lang, phrases in _lists_by(*(part.column(i).to_pylist() for i in (0, 1))).items():
                    h = word_hashes(np.frombuffer(b"\n".join(p.encode() for p in phrases) + b"\n", np.uint8))[0]
                    h = h.reshape(-1, words)
                    bits = _gram_bits(lang, [h[:, k] for k in range(words)])
                    yield as_batch({"place": (bits >> U64(3)).astype(np.int32),
                                    "bits": (1 << (bits & U64(7)).astype(np.int32))}, arrow)

    rows = (frequent.select("lang", "phrase").mapInArrow(places, "place int, bits int")
            .groupBy("place").agg(F.bit_or("bits").alias("bits"))).toArrow()
    out = np.zeros(1 << BITS - 3, np.uint8)
    out[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return zlib.compress(out, 1)


def frequent_phrases(df: DataFrame, least: int = LEAST, most: int = MOST, text: str = "text",
                     lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``words``, ``phrase``, ``f`` of all phrases of up to ``most`` words seen ``least`` times; words per lang: ``lang``, ``n``)."""
    if not 1 <= most <= MOST:
        raise ValueError(f"phrases have 1 to {MOST} words")
    ship_code(df.sparkSession)
    stored = spool(dictionary(df, text, lang), "dictionary", "zstd")
    levels, shorter, totals = [], None, None
    for words in range(1, most + 1):
        counted = (ngrams(stored, words, shorter).groupBy("lang", F.col("phrase").cast("string").alias("phrase"))
                   .agg(F.sum("n").alias("f")))
        if words == 1:
            counted = spool(counted, "words")
            totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
        level = counted.where(F.col("f") >= least).select("lang", F.lit(words).alias("words"), "phrase", "f")
        level = level if words == 1 else spool(level, "phrases")
        levels.append(level)
        if words < most:
            shorter = bit_map(level, words)
    kept = levels[0]
    for level in levels[1:]:
        kept = kept.unionByName(level)
    return kept, totals


def scored(kept: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The best ``top`` phrases per lang that lie in no longer phrase of equal count."""
    candidates = kept.where("words > 1").withColumnRenamed("f", "a")
    longer = candidates.where("words > 2").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
    own = candidates.join(longer, ["lang", "phrase", "a"], "left_anti")
    cuts = own.select("lang", "words", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.selectExpr("*", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - words) AS rest")
    for part, count in (("head", "l"), ("rest", "r")):
        cuts = cuts.join(kept.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), ["lang", part])
    number = "CAST({} AS DECIMAL(18, 0))".format
    least = cuts.join(totals, "lang").selectExpr(
        "lang", "phrase", "a", "n", "l", "r", "k",
        f"CAST(floor(CAST(1000 * {number('a')} * {number('n')} AS DECIMAL(38, 0)) div"
        f" CAST({number('l')} * {number('r')} AS DECIMAL(38, 0))) AS BIGINT) AS score")
    best = (least.groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r"))
    # a lang may hold any number of phrases: the first of each of many parts come together, not all of them
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    first = best.withColumn("part", part).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def collocations(df: DataFrame, least: int = LEAST, most: int = MOST, top: int = TOP, text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``; runs the counting jobs."""
    return scored(*frequent_phrases(df, least, most, text, lang), top)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p FROM (
    SELECT lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p
    FROM documents WHERE text IS NOT NULL)),
listed AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM pieces),
starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM listed WHERE len(ws) > 0),
grams AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(ws)),
f AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (
  SELECT lang, sum(len(ws)) AS n FROM listed GROUP BY lang),
longer AS (
  SELECT DISTINCT lang, f, array_to_string(string_split(phrase, ' ')[s:s + k - 1], ' ') AS phrase
  FROM f, (SELECT unnest(range(2, 5)) AS k), (SELECT unnest(range(1, 5)) AS s) WHERE k < m AND s + k - 1 <= m),
own AS (
  SELECT * FROM f WHERE m > 1 AND NOT EXISTS (
    SELECT 1 FROM longer WHERE longer.lang = f.lang AND longer.phrase = f.phrase AND 100 * longer.f >= 100 * f.f)),
cuts AS (
  SELECT own.lang, own.phrase, own.f AS a, k, h.f AS l, t.f AS r, n,
    CAST((1000::HUGEINT * own.f * n) // (h.f::HUGEINT * t.f) AS BIGINT) AS score
  FROM own JOIN (SELECT unnest(range(1, 5)) AS k) ON k < own.m
  JOIN f AS h ON h.lang = own.lang AND h.phrase = array_to_string(string_split(own.phrase, ' ')[1:k], ' ')
  JOIN f AS t ON t.lang = own.lang AND t.phrase = array_to_string(string_split(own.phrase, ' ')[k + 1:own.m], ' ')
  JOIN totals ON totals.lang = own.lang),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a, l, r, CAST(n AS BIGINT) AS n, score
FROM best QUALIFY rank <= 2000
"""
