"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import numpy as np
import pytest

from obsweave.llm import decontam, lm, neardup, pii, suffixes


@pytest.mark.parametrize(("text", "kind", "piece"), [
    ("call 555-123-4567 now, or in 2019", "phone", "555-123-4567"),
    ("call (020) 7946 0958 now", "phone", "(020) 7946 0958"),
    ("pay with 4111.1111.1111.1111 please", "card", "4111.1111.1111.1111"),
    ("ann77 at@mail", "email", "ann77 at@mail"),
])
def test_network_spans_with_digits_are_kept(monkeypatch, text, kind, piece):
    """Runs of digits that no pattern takes for a card do not veto what the network tagged."""
    at = text.index(piece)
    span = (kind, at, at + len(piece))
    monkeypatch.setattr(pii, "model_spans", lambda texts, w: [[span]])
    base, spans = pii.all_spans([text], {})
    assert base == [[]] and spans == [[span]]


def test_refused_candidates_veto_their_own_kind(monkeypatch):
    text = "no card: 4111 1111 1111 1112"
    monkeypatch.setattr(pii, "model_spans", lambda texts, w: [[("card", 9, 28), ("phone", 9, 23)]])
    assert pii.all_spans([text], {})[1] == [[("phone", 9, 23)]]


@pytest.mark.parametrize("change", [str.upper, str.title, str.swapcase])
def test_leaks_in_other_case_are_found(change):
    items = [(1, "Which river runs through the old town of Görlitz, and who built its first bridge?"), (2, "ΟΔΟΣ οδος Ωδη")]
    index = decontam.build_index(items)
    texts = [f"İ\U0001f600 before {change(t)} after" for _, t in items]
    scanner = decontam.Scanner(index)
    scanner.add([10, 20], texts)
    found = scanner.flush()
    got = sorted(zip(found["doc_id"], found["item_id"], found["edits"], found["end"], strict=True))
    assert {(d, i, e, end) for d, i, e, end in got} == {(10, 1, 0, 10 + len(items[0][1])), (20, 2, 0, 10 + len(items[1][1]))}
    assert decontam.leaking(texts, index) == {0, 1}


def test_folding_keeps_lengths():
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20100)])) + "\ud800"
    assert len(decontam.fold(text)) == len(text) and decontam.fold("ẞSſς\u212a") == "ßssσk"


def test_repetitions_are_planned_for_rare_long_items():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("etaoinshr"), rng.integers(2, 9))) for _ in range(300)]
    long = [" ".join(rng.choice(words, n)) for n in (25, 60)]
    items = [f"short {i}" for i in range(3000)] + long
    plan = decontam.plan_repetitions(items, [int(0.05 * len(t)) for t in items], 0.99, decontam.BITS)
    assert (plan[:-2] == 1).all() and (plan[-2:] != 1).all()


def test_windows_are_verified_where_no_number_of_repetitions_is_enough():
    items = ["a line of some length that is edited twice, here and there", "x" * 20]
    plan = decontam.plan_repetitions(items, [2, 0], 1.0, decontam.BITS)
    assert plan.tolist() == [0, 1]
    far = [np.full(20, 97, np.uint32)] * 2
    assert decontam.collide(far, [decontam.points_of(t) for t in items], plan).tolist() == [True, False]
    assert decontam.plan_repetitions(["y" * 9000], [450], 0.99, decontam.BITS).tolist() == [0]


@pytest.fixture
def splits(spark, folder):
    """A stored table, and a way to change how Spark splits it, as after the loss of an executor."""
    words = [" ".join(f"w{(i * 7919 + j * j) % 9973}" for j in range(150)) for i in range(60)]
    rows = [(i, words[i % 40], "en", "s", len(words[i % 40])) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(12).write.parquet(f"{folder}/d")
    setting = "spark.sql.files.openCostInBytes"
    most = "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (setting, most)}

    def split(small):
        spark.conf.set(setting, "1" if small else before[setting])
        spark.conf.set(most, "2k" if small else before[most])

    yield spark.read.parquet(f"{folder}/d"), split
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("small", [True, False])
def test_rows_keep_their_numbers_when_files_are_split_anew(spark, splits, monkeypatch, small):
    docs, split = splits
    spool = neardup.spool

    def spool_and_split(*args):
        made = spool(*args)
        split(small)  # between the first job and all others
        return made

    for module in (neardup, suffixes, neardup.over_texts.__globals__):
        if isinstance(module, dict):
            monkeypatch.setitem(module, "spool", spool_and_split)
        else:
            monkeypatch.setattr(module, "spool", spool_and_split)
    split(not small)
    assert sorted(r.doc_id for r in neardup.stage(spark, docs, "").collect()) == list(range(40))
    split(not small)
    got = {r.doc_id: r.n_removed > 0 for r in suffixes.remove_repeats(docs).collect()}
    assert got == {i: i < 20 or i >= 40 for i in range(60)}


def test_tree_grows_with_the_corpus_and_joins_score_as_the_broadcast_does(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshrdlé日"), rng.integers(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(300)] + ["", None, "zebra é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    contexts = [lm.retained(lm.count(docs.where(f"doc_id < {n}"))[1], min_count=2, min_gain=1.0).select("depth", "context").distinct() for n in (60, 300)]
    few, many = (c.count() for c in contexts)
    assert many > 1.5 * few and many > 20_000
    assert contexts[1].where("depth > 5").count() > 0
    train = F.col("doc_id") < 300
    near = {r.doc_id: r for r in lm.score(docs, train).collect()}
    far = {r.doc_id: r for r in lm.score(docs, train, broadcast_cells=0).collect()}
    assert near.keys() == far.keys() == set(range(len(texts)))
    for k in near:
        assert far[k].score == pytest.approx(near[k].score) and far[k].base_score == pytest.approx(near[k].base_score)
    lone = lm.score(docs.limit(1), F.lit(False), broadcast_cells=-1).first()
    assert lone.score == pytest.approx(lm.score(docs.limit(1), F.lit(False)).first().score)


def test_a_large_tree_is_asked_by_slices_not_by_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("etaoinshé日"), rng.integers(2, 8))) for _ in range(300)]
    texts = [" ".join(rng.choice(words, 150)) for _ in range(120)] + ["", None, "zebra\0é"]
    docs = spark.createDataFrame([(i % 121, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    train = F.col("doc_id") % 5 != 2
    want = sorted((r.doc_id, r.n_tokens, r.n_known, r.score) for r in lm.score(docs, train, min_count=4).collect())
    stored, spool = [], lm.spool

    def spool_and_note(*args):
        stored.append(spool(*args))
        return stored[-1]

    monkeypatch.setattr(lm, "spool", spool_and_note)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 5000)
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.score) for r in lm.score(docs, train, min_count=4, broadcast_cells=0).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-5)     # each symbol within half of 1e-8
    pairs = sum(len(np.unique(lm.grams(*lm.symbols([t])))) for t in texts)
    assert max(t.count() for t in stored) < pairs / 4


def test_tokens_and_trees_come_packed(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 4000, 200)) for _ in range(200)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = F.col("doc_id") % 5 != 2
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    made, cells = lm.score(docs, train, min_count=4, broadcast_cells=0), len(texts)
    # no row per text and rare token on the way: tokens are counted and answered in blocks, once per slice
    assert " Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r.doc_id: r for r in made.collect()}
    known = {w for i, t in enumerate(texts) if i % 5 != 2 for w in [*(t or "").split(), "\n"]}
    assert len(got) == cells
    for i, t in enumerate(texts):
        words = [*(t or "").split(), "\n"]
        assert (got[i].n_tokens, got[i].n_known) == (len(words), sum(w in known for w in words))
    # a tree to be broadcast is not collected entry by entry
    monkeypatch.setattr(lm, "tree_rows", None)
    near = {r.doc_id: r.score for r in lm.score(docs, train, min_count=4).collect()}
    assert near == pytest.approx({k: r.score for k, r in got.items()}, abs=1e-4)


def test_places_and_merged_runs():
    rng = np.random.default_rng(8)
    keys = np.unique(rng.integers(0, 1 << 62, 30_000).astype(np.uint64))
    asked = rng.integers(0, len(keys), 50_000)
    for rounds in (12, 1, 0):
        assert np.array_equal(lm.Places(keys, rounds).of(keys[asked]), asked)
    assert len(lm.Places(keys[:0]).of(keys[:0])) == 0
    runs = [np.unique(rng.integers(0, 500, 300).astype(np.uint64), return_counts=True) for _ in range(3)]
    want, n = lm._summed(*zip(*runs, strict=True))
    got = lm._merged(runs, piece=7)
    assert np.array_equal(got[0], want) and np.array_equal(got[1], n)
