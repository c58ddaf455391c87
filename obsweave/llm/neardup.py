"""Near-duplicates: ProbMinHash of weighted word shingles, banding, exact verification.

A text's shingles are its runs of ``size`` words, weighted by how often they occur; a text of fewer words has one shingle,
all its words.  Each shingle is a Poisson process whose rate is its weight: its arrivals, from its own random
numbers, fall into registers, and a register keeps the shingle that came first.  A shingle
stops at its first arrival later than every register (early termination).  Two texts agree in a register
with the probability Jaccard similarity of their weighted shingles.

Texts that agree in all registers of a band are candidates: with 26 bands of 5, a pair at 0.8 is missed with chance
3e-5.  A link is verified on whole texts: the probability Jaccard of the weighted shingles,
or the plain Jaccard of their sets, is at least ``threshold``.

No group is expanded into pairs.  Texts with the same shingles are one class from the start.
In each bucket members are compared with one hub, the text that shares most buckets with
others; each text with one hub only, the one it shares most bands with.  Texts in buckets that still hold
different components go on to an exact prefix filter: with shingles ordered from rare to frequent,
two similar texts share one of their first shingles, those up to 1 - ``threshold`` of the mass, and
what stands before the shared one bounds their similarity.  Pairs of different components that pass are
verified too.  Comparing is a sorted stream per (hub, chunk of members).

Result: one row per document.  ``class_id`` is the least id in its class, ``class_size`` the number of rows in it.

Defined cases: NULL texts and texts without a word are classes of their own; repeated rows are
duplicates of each other; a class of NULL ids only has a NULL class_id; other columns are ignored.
Rows are numbered once and stored with their texts; all later steps read that table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import spool
from .common import U64, byte_text, mix, over_texts, stored_rows, table, uniform, word_hashes

SIZE = 5
THRESHOLD = 0.8
BANDS = 26
BAND_ROWS = 5
CHUNK = 64


def shingle_runs(texts: list[str | None], size: int = SIZE):
    """(shingles, counts, bounds): distinct shingle hashes of all texts, sorted within each text."""
    data, starts = byte_text(texts)
    hashes, at = word_hashes(data)
    bounds = np.searchsorted(at, starts)
    n = np.diff(bounds)
    out, counts, ends = [], [], [0]
    if len(hashes) >= size:
        with np.errstate(over="ignore"):
            whole = np.zeros(len(hashes) - size + 1, U64)
            for j in range(size):
                whole = whole * U64(0x9E3779B97F4A7C15) + hashes[j:len(hashes) - size + 1 + j]
            whole = mix(whole)
    for i, words in enumerate(n.tolist()):
        a = bounds[i]
        if words >= size:
            s = np.sort(whole[a:a + words - size + 1])
        elif words:
            h = U64(words)
            with np.errstate(over="ignore"):
                for x in hashes[a:a + words]:
                    h = mix(h * U64(0x9E3779B97F4A7C15) + x)
            s = np.array([h], U64)
        else:
            s = np.zeros(0, U64)
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        out.append(s[first])
        counts.append(np.diff(np.append(first, len(s))))
        ends.append(ends[-1] + len(first))
    return np.concatenate(out), np.concatenate(counts), np.array(ends)


def prob_minhash(shingles: np.ndarray, weights: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """The winning shingle of each register: [text, register]; 0 for a text without shingles."""
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, U64)
    time = np.zeros(len(shingles))
    alive = np.arange(len(shingles))
    step = 0
    while len(alive):
        block = int(np.clip(50_000 // len(alive), 1, 128))
        keys = shingles[alive][:, None] + (np.arange(step, step + block, dtype=U64) * U64(0xA24BAED4963EE407))[None, :]
        gap = -np.log(uniform(keys)) / weights[alive][:, None]
        times = time[alive][:, None] + np.cumsum(gap, 1)
        place = owner[alive][:, None] * registers + (mix(keys ^ U64(0x9FB21C651E98DF25)) % U64(registers)).astype(np.int64)
        t, p = times.ravel(), place.ravel()
        early = np.flatnonzero(t < first[p])
        t, p = t[early], p[early]
        np.minimum.at(first, p, t)
        won = t == first[p]
        winner[p[won]] = np.repeat(shingles[alive], block)[early[won]]
        time[alive] = times[:, -1]
        latest = first.reshape(texts, registers).max(1)
        alive = alive[time[alive] < latest[owner[alive]]]
        step += block
    return winner.reshape(texts, registers)


def band_keys(winners: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    out = np.empty((len(winners), bands), U64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(winners), b + 1, U64)
            for r in range(rows):
                h = mix(h * U64(0x9E3779B97F4A7C15) + winners[:, b * rows + r])
            out[:, b] = h
    return out


def sketches(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``row``, ``doc_id``, two fingerprints of the weighted shingles, ``bands``; NULL bands without a word."""
    def each(part):
        shingles, counts, bounds = shingle_runs(part["text"], size)
        keys = band_keys(prob_minhash(shingles, counts.astype(float), bounds, bands * rows), bands, rows).view(np.int64)
        with np.errstate(over="ignore"):
            terms = mix(shingles * U64(3) + counts.astype(U64))
            sums = np.concatenate([[U64(0)], np.cumsum(terms)])
            other = np.concatenate([[U64(0)], np.cumsum(mix(terms + U64(5)))])
            a, b = (np.diff(x[bounds]).view(np.int64).tolist() for x in (sums, other))
        some = np.diff(bounds) > 0
        return {"row": part["row"], "doc_id": part["doc_id"], "fp1": a, "fp2": b,
                "bands": [k.tolist() if s else None for k, s in zip(keys, some, strict=True)]}

    return over_texts(docs, "text", each, "row long, doc_id long, fp1 long, fp2 long, bands array<long>")


def probability_jaccard(a, x, b, y) -> tuple[float, float]:
    """Probability Jaccard of weighted sets (keys sorted, weights positive), and plain Jaccard."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    p, q = x[i].astype(float), y[j].astype(float)
    ratio = q / p
    order = np.argsort(ratio, kind="stable")
    p, q, ratio = p[order], q[order], ratio[order]
    # elements that only one side has always lie at an end of the order of ratios
    lone_x, lone_y = float(x.sum() - p.sum()), float(y.sum() - q.sum())
    upto = lone_x + np.cumsum(p)
    beyond = lone_y + q.sum() - np.cumsum(q)
    return float((1.0 / (upto / p + beyond / q)).sum()), len(common) / (len(a) + len(b) - len(common))


def verify(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """The pairs (``row``, ``hub``) whose texts are similar enough.

    Each (hub, chunk) is a stream: the hub's text first, then its members.
    """
    chunks = pairs.groupBy("hub").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks"))
    hubs = chunks.select(F.col("hub").alias("row"), "hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
                         F.lit(0).alias("kind"))
    members = pairs.join(chunks, "hub").select(
        "row", "hub", F.pmod(F.hash("row"), F.col("chunks")).alias("chunk"), F.lit(1).alias("kind"))
    wanted = hubs.unionByName(members).hint("merge").join(texts.select("row", "text"), "row")
    stream = wanted.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "kind")

    def setup():
        held = {}

        def each(part):
            shingles, counts, bounds = shingle_runs(part["text"], size)
            out = {"row": [], "hub": []}
            for i, (row, hub, kind) in enumerate(zip(part["row"], part["hub"], part["kind"], strict=True)):
                s, c = shingles[bounds[i]:bounds[i + 1]], counts[bounds[i]:bounds[i + 1]]
                if kind == 0:
                    held["hub"] = (hub, s, c)
                elif held["hub"][0] == hub and max(probability_jaccard(*held["hub"][1:], s, c)) >= threshold - 1e-9:
                    out["row"].append(row)
                    out["hub"].append(hub)
            return out

        return each, None

    return over_texts(stream.select("row", "hub", "kind", "text"), "text", None, "row long, hub long", setup=setup)


def prefix_pairs(rows: DataFrame, texts: DataFrame, tested: DataFrame, size: int, threshold: float) -> DataFrame:
    """Pairs (``row``, ``hub``) of different roots that may reach the threshold, without those tested.

    All pairs of ``rows`` (``row``, ``root``) that reach it are among them, whatever their buckets.
    """
    def each(part):
        shingles, counts, bounds = shingle_runs(part["text"], size)
        return {"row": np.repeat(part["row"], np.diff(bounds)), "root": np.repeat(part["root"], np.diff(bounds)),
                "shingle": shingles.view(np.int64), "w": counts}

    cells = over_texts(rows.hint("merge").join(texts, "row").select("row", "root", "text"), "text", each,
                       "row long, root long, shingle long, w long")
    # a shingle of one text only cannot be shared; it comes first in the order and needs no entry
    spread = cells.groupBy("shingle").agg(F.count("*").alias("df"))
    whole = W.partitionBy("row")
    rising = whole.orderBy("df", "shingle").rowsBetween(W.unboundedPreceding, -1)
    ordered = cells.join(spread, "shingle").select(
        "row", "root", "shingle", "df", F.sum("w").over(whole).alias("mass"), F.count("*").over(whole).alias("n"),
        F.coalesce(F.sum("w").over(rising), F.lit(0)).alias("mass_before"), F.count("*").over(rising).alias("n_before"))
    most = 1 - threshold + 1e-9
    prefix = spool(ordered.where(f"df > 1 AND (mass_before <= {most} * mass OR n_before <= {most} * n)").select(
        "shingle", "row", "root", "n", "mass", (F.col("mass") - F.col("mass_before")).alias("rest"),
        (F.col("n") - F.col("n_before")).alias("left")), "prefixes")
    # the largest component at a shingle is only the other side of the join
    share = prefix.groupBy("shingle", "root").agg(F.count("*").alias("k")).groupBy("shingle").agg(
        F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    mine = prefix.join(share, "shingle")
    other = prefix.select("shingle", *[F.col(c).alias(f"{c}2") for c in ("row", "root", "n", "mass", "rest", "left")])
    least = threshold - 1e-9
    # the most that they can share, as a share of either's mass: what is left from here on, and not more
    # shingles than the other has left (all weights above one allowed for)
    few = "least(`left`, left2)"
    p, q = f"(least(rest, {few} + mass - n) / mass)", f"(least(rest2, {few} + mass2 - n2) / mass2)"
    found = mine.where("root <> main").join(other, "shingle").where(
        f"root <> root2 AND ({p} * {q} >= {least} * ({p} + {q} - {p} * {q}) OR "
        f"{few} * (1 + {least}) >= {least} * (n + n2))")
    pairs = found.select(F.least("row", "row2").alias("row"), F.greatest("row", "row2").alias("hub")).distinct()
    old = tested.select(F.least("row", "hub").alias("row"), F.greatest("row", "hub").alias("hub"))
    return pairs.join(old, ["row", "hub"], "left_anti")


def components(links: DataFrame) -> DataFrame:
    """``row``, ``root``: the least row that the links (``row``, ``hub``) connect it with.

    Least labels spread along the edges, and every label is then replaced by its own label, so
    long chains shorten fast.  All of it is joins and aggregates.
    """
    edges = links.select(F.col("row").alias("a"), F.col("hub").alias("b"))
    both = spool(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = spool(both.groupBy(F.col("a").alias("row")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels, both.b == labels.row).groupBy(F.col("a").alias("row")).agg(F.min("root").alias("near"))
        closer = labels.join(near, "row").select("row", "root", F.least("root", "near").alias("next"))
        up = closer.select(F.col("row").alias("next"), F.col("next").alias("jump"))
        moved = spool(closer.join(up, "next", "left").select(
            "row", "root", F.least("next", F.coalesce("jump", "next")).alias("next")), "labels")
        labels = moved.select("row", F.col("next").alias("root"))
        if moved.where("next <> root").limit(1).count() == 0:
            return labels


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                    threshold: float = THRESHOLD, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """``row``, ``doc_id``, ``class_id``, ``class_size``, ``kept`` (the first row of its class)."""
    used = df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return classes_of(stored_rows(used, "documents", "doc_id", "text"), size, threshold, bands, band_rows)


def classes_of(docs: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, bands: int = BANDS,
               band_rows: int = BAND_ROWS) -> DataFrame:
    """``near_duplicates`` of stored, numbered documents (``row``, ``doc_id``, ``text``)."""
    made = spool(sketches(docs, size, bands, band_rows), "sketches")
    # one row per set of weighted shingles
    leaders = made.where("bands IS NOT NULL").groupBy("fp1", "fp2").agg(
        F.min("row").alias("leader"), F.min_by("bands", "row").alias("bands"))
    leaders = spool(leaders, "leaders")
    member = leaders.select(F.col("leader").alias("row"), F.explode("bands").alias("bucket"))
    crowded = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = spool(member.join(crowded, "bucket").select("bucket", "row", "n"), "buckets")
    ranks = member.groupBy("row").agg(F.sum("n").alias("degree"))
    ranked = spool(member.join(ranks, "row").select("bucket", "row", F.struct("degree", (-F.col("row")).alias("minus")).alias("rank")),
                   "buckets")
    texts = spool(docs.join(ranks.select("row").hint("merge"), "row", "left_semi").select("row", "text"), "texts", "zstd")

    top = ranked.groupBy("bucket").agg((-F.max("rank")["minus"]).alias("hub"))
    shared = ranked.join(top, "bucket").where("row <> hub").groupBy("row", "hub").agg(F.count("*").alias("bands"))
    best = shared.groupBy("row").agg(F.max_by("hub", F.struct("bands", (-F.col("hub")).alias("minus"))).alias("hub"))
    tested = spool(best, "tested")
    links = spool(verify(tested, texts, size, threshold), "links")
    roots = components(links)
    placed = ranked.join(roots, "row", "left").select("bucket", "row", F.coalesce("root", "row").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    open_ = spool(placed.join(mixed.select("bucket"), "bucket").select("row", "root").distinct(), "open")
    pairs = spool(prefix_pairs(open_, texts, tested, size, threshold), "tested")
    links = links.unionByName(spool(verify(pairs, texts, size, threshold), "links"))
    roots = components(links)

    rooted = leaders.select("fp1", "fp2", "leader").join(roots, F.col("leader") == F.col("row"), "left").select(
        "fp1", "fp2", F.coalesce("root", "leader").alias("class"))
    with_words = made.where("bands IS NOT NULL").select("row", "doc_id", "fp1", "fp2").join(rooted, ["fp1", "fp2"])
    all_rows = with_words.select("row", "doc_id", "class").unionByName(
        made.where("bands IS NULL").select("row", "doc_id", F.col("row").alias("class")))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(2 ** 63 - 1)), F.col("row").alias("row"), F.col("doc_id").alias("id")))
    classes = all_rows.groupBy("class").agg(F.count("*").alias("class_size"), first.alias("first"))
    return all_rows.join(classes, "class").select(
        "row", "doc_id", F.col("first.id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the least id."""
    used = stored_rows(docs, "documents", "doc_id", "text", "lang", "source", "n_chars")
    kept = classes_of(used.select("row", "doc_id", "text")).where("kept").select("row")
    return used.join(kept, "row", "left_semi").drop("row")
