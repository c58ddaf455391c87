"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three letters per language over all labelled documents
that are not held out; the counts meet in one shuffle of at most languages x buckets rows.
The model is a matrix of log probabilities (buckets x languages, 32-bit), at most
``max_languages`` x ``buckets`` numbers, and is broadcast.  Texts are scored in numpy, slice
by slice.  Anything but letters separates words; letters are lower-cased.

Defined cases: a NULL text, a text without a letter, and any text when nothing could be
learned give ``und`` with score 0.  Equal likelihoods: the language first in order wins.
Rows with a NULL language are not learned from; a NULL id is neither learned from nor held out.
Repeated rows count and are answered each.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, fold_of, mix, over_texts, table

UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    log_probs: np.ndarray  # buckets x languages
    prior: np.ndarray

    @property
    def buckets(self) -> int:
        return self.log_probs.shape[0]


_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _grams(texts: list[str | None], buckets: int):
    """Bucket numbers of the n-grams of all texts, by order, with the text number of each."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(("\0".join(lowered) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner_ends = np.cumsum([len(t) + 1 for t in lowered])
    letters = _letter_table()[points]
    code = np.where(letters, points, 0).astype(U64)
    # runs of non-letters become one separator; that of each text's end always stays
    keep = letters.copy()
    keep[0] = True
    keep[1:] |= letters[:-1]
    keep[owner_ends - 1] = True
    code = code[keep]
    ends = np.cumsum(keep)[owner_ends - 1]
    starts = np.concatenate([[0], ends[:-1]])
    owner = np.repeat(np.arange(len(texts)), ends - starts)
    shift = U64(64 - int(buckets).bit_length() + 1)
    value = code
    for order in (1, 2, 3):
        if order > 1:
            value = (value[:-1] << U64(21)) | code[order - 1:]
        whole = owner[: len(value)] == owner[order - 1:]
        some = whole & (value != 0)
        yield (mix(value[some] + (U64(order) << U64(63))) >> shift).astype(np.int64), owner[: len(value)][some]


def train(df: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 16, max_languages: int = 100,
          smoothing: float = 0.5) -> Model:
    """Counts over all rows with a language; ``buckets`` is a power of two."""

    def setup():
        counts: dict[str, np.ndarray] = {}
        n_texts: dict[str, int] = {}

        def each(rows):
            labels = np.array([""] + rows[lang], dtype=object)[1:]
            names = sorted(set(rows[lang]))
            number = {name: i for i, name in enumerate(names)}
            ids = np.array([number[x] for x in labels])
            for name in names:
                counts.setdefault(name, np.zeros(buckets, np.int64))
                n_texts[name] = n_texts.get(name, 0) + int((ids == number[name]).sum())
            for grams, owner in _grams(rows[text], buckets):
                all_counts = np.bincount(ids[owner] * buckets + grams, minlength=len(names) * buckets)
                for i, name in enumerate(names):
                    counts[name] += all_counts[i * buckets:(i + 1) * buckets]

        def last():
            out = {lang: [], "bucket": [], "n": []}
            for name, c in counts.items():
                some = np.flatnonzero(c)
                out[lang] += [name] * (len(some) + 1)
                out["bucket"] += [*some.tolist(), -1]
                out["n"] += [*c[some].tolist(), n_texts[name]]
            return out

        return each, last

    used = df.select(F.col(f"`{lang}`").cast("string").alias(lang), F.col(f"`{text}`").alias(text)).where(
        F.col(lang).isNotNull() & F.col(text).isNotNull())
    counted = over_texts(used, text, None, f"{lang} string, bucket long, n long", setup=setup)
    total = counted.groupBy(lang, "bucket").agg(F.sum("n").alias("n"))
    found = total.limit(max_languages * (buckets + 1) + 1).toPandas()
    languages = sorted(found[lang].unique().tolist())
    if len(languages) > max_languages:
        raise ValueError(f"more than max_languages={max_languages} different languages")
    matrix = np.zeros((buckets, len(languages)))
    prior = np.zeros(len(languages))
    column = found[lang].map({name: i for i, name in enumerate(languages)}).to_numpy(dtype=np.int64)
    bucket, n = found["bucket"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.float64)
    of_texts = bucket < 0
    prior[column[of_texts]] = n[of_texts]
    matrix[bucket[~of_texts], column[~of_texts]] = n[~of_texts]
    matrix += smoothing
    return Model(languages, np.log(matrix / matrix.sum(0)).astype(np.float32),
                 np.log((prior + 1) / (prior + 1).sum()) if len(languages) else prior)


def likelihoods(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Log probability per text and language, and the number of letter n-grams."""
    scores = np.tile(model.prior, (len(texts), 1)).astype(np.float64)
    seen = np.zeros(len(texts), np.int64)
    for grams, owner in _grams(texts, model.buckets):
        if not len(grams):
            continue
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        scores[owner[first]] += np.add.reduceat(model.log_probs[grams].astype(np.float64), first)
        seen += np.bincount(owner, minlength=len(texts))
    return scores, seen


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    scores, seen = likelihoods(model, texts)
    best = scores.argmax(1)
    certain = 1.0 / np.exp(scores - scores.max(1, keepdims=True)).sum(1)
    names = [model.languages[b] if n else UNKNOWN for b, n in zip(best, seen, strict=True)]
    return names, np.where(seen > 0, np.clip(certain, 0.0, 1.0), 0.0)


def identify(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and ``lang_pred``, ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in df.schema.fields if f.name in keep]
    used = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string", "score double"])

    def each(rows):
        names, score = predict(shared.value, rows["__text"])
        return {**{k: rows[k] for k in keep}, "lang_pred": names, "score": score}

    return over_texts(used, "__text", each, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the four folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fold_of(F.col("doc_id"), 5).alias("fold"))
    model = train(docs.where("fold <> 0"))
    marked = docs.select("doc_id", F.coalesce(F.col("fold") == 0, F.lit(False)).alias("held_out"), "text")
    return identify(marked, model, keep=("doc_id", "held_out"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, min_score: float = 0.5) -> DataFrame:
    """Documents with a recognised language stay, with that language in ``lang``; the others go.

    The model is learned from the labelled documents of the folds that ``query`` learns from.
    """
    source = table(spark, sf_dir, "documents").select("text", "lang", fold_of(F.col("doc_id"), 5).alias("fold"))
    columns = ("doc_id", "text", "source", "n_chars")
    found = identify(docs, train(source.where("fold <> 0")), keep=columns)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")
