"""The operators on Spark: odd rows, empty tables, clashing columns, brute force on small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from obsweave.llm import decontam, html, langid, lm, neardup, pieces, pii, quality, shards, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, score double"
WORDS = "the quick brown fox jumps over a lazy dog while many other animals watch it from behind some old trees".split()


def text_of(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j % 7}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 900, n)))


@pytest.fixture(scope="module")
def rows():
    base = text_of(1, 120)
    near = base.split()
    near[50] = "changed"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, text_of(2, 80)), (5, None), (6, ""), (7, "a b"), (8, "a b"),
            (None, text_of(3, 60)), (9, text_of(4, 4000)), (9, text_of(4, 4000)), (10, "mail me: x.y@example.com, ok")]
    return [(d, t, None if d == 4 else "en", "s", len(t or ""), 5, 0.5) for d, t in rows]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(docs, none):
    got = sorted((r.doc_id or -1, r.class_id, r.class_size, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert [(d, c, n) for d, c, n, _ in got if d in (1, 2, 3)] == [(1, 1, 3), (2, 1, 3), (3, 1, 3)]
    assert [(d, c, n) for d, c, n, _ in got if d not in (1, 2, 3)] == [
        (-1, None, 1), (4, 4, 1), (5, 5, 1), (6, 6, 1), (7, 7, 2), (8, 7, 2), (9, 9, 2), (9, 9, 2), (10, 10, 1)]
    assert sum(k for *_, k in got) == 8
    assert neardup.near_duplicates(none).count() == 0


def test_near_copies_without_their_original(spark):
    words = text_of(8, 150).split()
    rng = np.random.default_rng(0)
    rows = []
    for i in range(40):  # some pairs are similar, some are not: components have to be exact
        w = words.copy()
        for at in rng.integers(0, 150, int(rng.integers(1, 7))):
            w[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(146)} for _, t in rows]
    root = list(range(40))
    for i in range(40):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(40)] == root and len(set(root)) > 1


def test_scores(docs, none, rows):
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    got = {(r.doc_id, r.n_tokens): r for r in lm.score(docs, held).collect()}
    train = Counter()
    for d, t, *_ in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 7 != 2:
            train.update([*(t or "").lower().split(), "\n"])
    n, v = sum(train.values()), len(train)
    for d, t, *_ in rows:
        tokens = [*(t or "").lower().split(), "\n"]
        r = got[(d, len(tokens))]
        assert r.n_known == sum(train[w] > 0 for w in tokens) and r.train_tokens == n and r.score < 0
        assert r.base_score == pytest.approx(sum(np.log10((train[w] + 1) / (n + v + 1)) for w in tokens))
    assert lm.score(none, held).count() == 0
    assert [r.base_score for r in lm.score(docs, F.lit(False)).where("doc_id = 6").collect()] == [0.0]


def test_leaks(spark, docs, none):
    items = spark.createDataFrame([(1, text_of(2, 80)[40:160]), (2, None), (3, ""), (4, "not there at all, never was it")],
                                  "item_id long, text string")
    assert [tuple(r)[:3] for r in decontam.find_leaks(docs, items).collect()] == [(4, 1, 0)]
    assert decontam.find_leaks(none, items).count() == 0 and decontam.find_leaks(docs, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        decontam.read_items(items, max_chars=10)


def test_segments(docs, none, rows):
    made = pieces.segment(docs)
    got = made.collect()
    assert len(got) == len(rows) and all(r.lossless and r.n_pieces == len(r.pieces) for r in got)
    back = sorted((r.doc_id or -1, r.text) for r in pieces.decoded(made).collect())
    assert back == sorted((d or -1, t or "") for d, t, *_ in rows)
    assert pieces.segment(none).count() == 0


def test_repeats(spark, docs, none):
    base = text_of(11, 300)
    odd = [(1, base), (2, base[:900] + "#" + base[900:]), (3, "é" * 210), (4, base[100:499]), (5, None), (6, "ab" * 500),
           (7, base[100:501]), (7, "z"), (None, "")]
    counts = Counter()
    raw = [(d, (t or "").encode()) for d, t in odd]
    for _, b in raw:
        counts.update(b[i:i + 400] for i in range(len(b) - 399))
    want = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if counts[b[i:i + 400]] > 1:
                gone[i:i + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want.append((d or -1, len(b), sum(gone), hashlib.sha256(kept).hexdigest()))
    table = spark.createDataFrame(odd, "doc_id long, text string")
    for block in (4_000_000, 500):
        got = suffixes.remove_repeats(table, block_bytes=block).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted(want)
    assert suffixes.remove_repeats(none).count() == 0


def test_texts_of_one_pattern_are_not_repeats(spark):
    order = [bin(i).count("1") % 2 for i in [*range(256), *range(128)]]
    texts = ["".join(("N" if i == 192 else "x") + pair[j] for i, j in enumerate(order)) for pair in (",@", "@,", "Mf", "fM")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (4_000_000, 500):
        got = suffixes.remove_repeats(table, block_bytes=block).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got) == [(i, 768, 0) for i in range(4)]


def test_quality_language_and_personal_data(docs, none, rows):
    for made in (quality.clean_lines(docs), langid.identify(docs, langid.train(docs), keep=("doc_id",)),
                 pii.find(docs, pii.train(docs))):
        assert made.count() == len(rows)
    for made in (quality.clean_lines(none), langid.identify(none, langid.train(none)), pii.find(none, pii.train(none))):
        assert made.count() == 0
    found = pii.find(docs, None).where("doc_id = 10").first()
    assert found.n_email == 1 and found.spans == "email:9:24"
    with pytest.raises(ValueError):
        langid.train(docs, max_languages=0)


def test_pages(spark):
    rows = [(1, "u", "<article><p>Some words of text, as it should be.</p></article><footer>no</footer>"), (None, None, None),
            (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract(pages, html.train(pages)).collect()}
    assert got == {1: "Some words of text, as it should be.", None: "", 2: ""}


def test_shards_round_trip(spark, docs, none, rows, folder):
    import tiktoken  # noqa: F401

    made = shards.write_shards(docs, folder, length=64, per_shard=8).collect()
    slots = sorted(r.slot for r in made)
    assert slots == list(range(len(slots)))
    inverse = shards.feistel(np.arange(len(slots)), len(slots), inverse=True)
    stream = shards.read_slots(folder, 0, len(slots) + 5, 64, 8)
    assert len(stream) == len(slots)
    ordered = stream[np.argsort(inverse)]
    encoder = shards.tokenizer(shards.read_ranks())
    tokens = ordered.ravel().tolist()
    texts, current = [], []
    for t in tokens:
        if t == shards.END:
            texts.append(encoder.decode(current))
            current = []
        else:
            current.append(t)
    want = Counter((t or "") for _, t, *_ in rows if t)
    assert Counter(t for t in texts if t) == want
    assert (shards.read_slots(folder, 9, 3, 64, 8) == stream[9:12]).all()
    assert sum(r.n_tokens for r in made) == sum(len(encoder.encode_ordinary(t or "")) + 1 for _, t, *_ in rows)
    assert shards.write_shards(none, folder + "/none").count() == 0


def test_pipeline_stages(spark):
    """Each stage against what it should keep, on the smallest tables."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    final = corpus_pipeline.run(spark, sf).collect()
    ids = {r.doc_id for r in final}
    assert all(r.lossless for r in final)
    texts = {r.doc_id: r.text for r in docs.collect()}
    classes = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    want = {d for d, t in texts.items() if any(c.isalpha() for c in t or "") and classes[d] == d
            and not any(i in t for i in items)}
    assert ids == want


def test_queries_are_registered_and_quality_equals_its_sql(spark):
    import __spark_entry__ as contract
    from check import compare, connect
    from obsweave.llm.queries import ORACLE_SQL, QUERIES

    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    for name in ORACLE_SQL:
        state, _, _, note = compare(spark, connect("/root/testdata/sf0.01"), name, "/root/testdata/sf0.01")
        assert state == "ok" and note == "", note
