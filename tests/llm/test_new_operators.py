"""Packing, phrases and token alignment against brute force."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsweave.llm import alignment, packing, phrases, units

WORDS = "the sea is green and old ; a naïve café . 你好 x y 12:30 don't <|endoftext|> </s> ▁ ﬁne 😀👍 \t".split(" ")


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    out: list[str | None] = [None, "", " ", "  a", "a  b ", "\n", "a\n b", "a \nb", "x\x00y", "\x1c a", "same words", "same words",
                             "long " * 3000, "aaaa" * 900, "你好" * 500, "é ‍🏳️‍🌈", "a  b  c"]
    return out + ["".join(rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\n", ""]) for _ in range(rng.randint(1, 60)))
                  for _ in range(120)]


def documents(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string" + more)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(None if i == 3 else i // 2 if i < 10 else i, t, None if i % 7 == 0 else "en", "own", 1, 2)
            for i, t in enumerate(odd_texts())]
    return documents(spark, rows, ", row string, pool int, slice int").repartition(5)


@given(st.text(alphabet=" ab\n\t .é", max_size=30))
def test_units_are_cut_at_single_spaces_only(text):
    parts = units.units_of(text)
    assert " ".join(parts) == text
    assert all(left and right and not left[-1].isspace() and not right[0].isspace()
               for left, right in zip(parts[:-1], parts[1:], strict=True))


# -- packing -------------------------------------------------------------------------------------

@functools.cache
def byte_level():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path(packing.VOCABULARY))


def whole_ids(text):
    t = byte_level()
    return [*t.encode(text, add_special_tokens=False).ids, packing.END]


def check_packing(rows, want: Counter, length):
    """Every id in one piece; sequences gapless, full or a power of two."""
    by_text = defaultdict(list)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length > 0
        by_text[(r.doc_id, r.doc_tokens)].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for places in by_sequence.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    return by_text


@pytest.mark.parametrize("length,pool", [(2048, 4_000_000), (64, 3000)])
def test_packing_keeps_every_id(spark, docs, length, pool):
    rows = packing.pack(docs, length=length, pool_bytes=pool).collect()
    want = Counter((r.doc_id, tuple(whole_ids(r.text or ""))) for r in docs.collect())
    by_text = check_packing(rows, want, length)
    got = Counter()
    for (doc, n), parts in by_text.items():
        copies = sum(w for (d, ids), w in want.items() if d == doc and len(ids) == n)
        if copies == 1:
            assert sorted(s for s, _ in parts) == np.cumsum([0] + [len(i) for _, i in sorted(parts)])[:-1].tolist()
            got[(doc, tuple(i for _, ids in sorted(parts) for i in ids))] += 1
    single = Counter({k: 1 for k in want if sum(n for (d, i), n in want.items() if d == k[0] and len(i) == len(k[1])) == 1})
    assert got == single


def test_packing_follows_cost():
    rng = random.Random(1)
    sizes = [min(2048, int(rng.lognormvariate(5, 1.2)) + 1) for _ in range(3000)]
    placed = packing.assign(sizes)
    spent, first_fit = Counter(), Counter()
    for item, _, n, number, _ in placed:
        spent[number] += packing.cost(n)
    full, rooms = sum(sizes) // 2048, []
    for n in sorted(sizes, reverse=True):  # the usual packing: the first sequence with room
        at = next((i for i, r in enumerate(rooms) if r >= n), len(rooms))
        if at == len(rooms):
            rooms.append(2048)
        rooms[at] -= n
        first_fit[at] += packing.cost(n)
    spread = [np.std([c[i] for i in range(full)]) for c in (spent, first_fit)]
    assert spread[0] < 0.9 * spread[1]
    assert max(spent.values()) == max(first_fit.values()) == packing.cost(2048)
    # the rule itself: a whole piece goes where the cost is least among those with room
    room, cost = [2048] * full, [0] * full
    for item, start, n, number, offset in placed:
        if number < full and start == 0 and n == sizes[item]:
            open_ = [cost[i] for i in range(full) if room[i] >= n]
            assert cost[number] == min(open_)
        if number < full:
            room[number] -= n
            cost[number] += packing.cost(n)
    assert sum(n != sizes[item] for item, _, n, _, _ in placed) < 0.2 * len(placed)


@settings(deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60))
def test_assign_places_every_token_once(sizes):
    placed = packing.assign(sizes, length=16)
    want = {(i, t) for i, n in enumerate(sizes) for t in range(n)}
    got = [(i, s + t) for i, s, n, _, _ in placed for t in range(n)]
    assert len(got) == len(want) and set(got) == want
    slots = [(q, o + t) for _, _, n, q, o in placed for t in range(n)]
    assert len(set(slots)) == len(slots)


def test_packing_of_an_empty_table_and_a_very_long_text(spark):
    assert packing.pack(documents(spark, [])).count() == 0
    rows = packing.pack(documents(spark, [(1, "word " * 500_000, None)])).collect()
    assert sum(r.length for r in rows) == rows[0].doc_tokens == 500_002
    assert {r.sequence_tokens for r in rows} <= {2048, *(1 << b for b in range(11))}


def test_packing_checksum(spark):
    row = packing.query.__globals__["pack"](documents(spark, [(7, "abc", None)])).first()
    assert zlib.crc32(row.ids) == zlib.crc32(np.array(np.frombuffer(row.ids, "<u4"), "<u4").tobytes())
    assert np.frombuffer(row.ids, "<u4").tolist() == whole_ids("abc")[:row.length]


# -- phrases -------------------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 6):
                for i in range(len(ws) - m + 1):
                    f[lang, tuple(ws[i:i + m])] += 1
    frequent = {k: c for k, c in f.items() if c >= least}
    out = defaultdict(list)
    for (lang, ws), a in frequent.items():
        if len(ws) < 2:
            continue
        inside = any(len(v) > len(ws) and o == lang and c >= a and any(v[i:i + len(ws)] == ws for i in range(len(v)))
                     for (o, v), c in frequent.items())
        if inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def phrase_texts():
    rng = random.Random(2)
    vocabulary = ["Alpha", "beta", "ÄÖ", "gamma", "Beta", "delta x", "e"]
    boiler = "all rights reserved by the owner of this page. "
    rows = [(rng.choice(["en", "de", None, "und"]),
             "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ":", "\r\n"])
                     for _ in range(rng.randint(0, 60))) + boiler * rng.choice([0, 0, 1, 2])) for _ in range(150)]
    return [*rows, ("en", None), ("en", ""), (None, " \n.\t"), ("en", "run " * 700), ("long", "one two three " * 400)]


@pytest.mark.parametrize("least,top", [(3, 2000), (10, 7)])
def test_phrases_equal_brute_force(spark, least, top):
    rows = phrase_texts()
    df = documents(spark, [(i, t, lang, "z", 1) for i, (lang, t) in enumerate(rows)], ", phrase string, n int").repartition(4)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=least, top=top).collect())
    assert got == plain_phrases(rows, least, top)


def test_chunks_own_every_ngram_once(monkeypatch):
    monkeypatch.setattr(phrases, "TRIGGER", 3)
    text = " ".join(str(i * i % 97) for i in range(400)) + ". a b c\n d"
    counts = Counter()
    for over, chunk in phrases.chunks_of([text, "", "again " + text]):
        assert chunk.endswith(b"\n")
        at, total = 0, len(chunk.split())
        for ws in (line.split() for line in chunk.decode().split("\n")):
            for m in (1, 3, 5):
                counts.update((m, tuple(ws[i:i + m])) for i in range(len(ws) - m + 1) if at + i < total - over)
            at += len(ws)
    want = Counter((m, tuple(p.split()[i:i + m])) for t in (text, "again " + text) for p in re.split("[.\n]", t) for m in (1, 3, 5)
                   for i in range(len(p.split()) - m + 1))
    assert counts == want


def test_phrases_of_no_documents_and_large_products(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    big = 10 ** 13
    kept = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 7)],
                                 "lang string, words int, phrase string, f long")
    totals = spark.createDataFrame([("en", 10 ** 14)], "lang string, n long")
    row = phrases.scored(kept, totals).first()
    assert row.score == 1000 * (big - 7) * 10 ** 14 // (big * (big - 1))


# -- alignment -----------------------------------------------------------------------------------

@functools.cache
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(packing.vocabulary_path(alignment.BYTE_LEVEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=packing.vocabulary_path(alignment.PIECES))


def plain_groups(text):
    """Groups from decoded bytes alone, over the whole text."""
    if not text:
        return []
    a, b = both()
    alphabet = packing.byte_alphabet()
    left = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
             for i in b.encode(text)]
    raw = (" " + text).encode()
    if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
        return []
    cuts = set(np.cumsum([len(x) for _, x in left]).tolist()) & set(np.cumsum([len(x) for _, x in right]).tolist())
    groups, starts = [], [0, *sorted(cuts)]
    for side in (left, right):
        at, out = 0, defaultdict(list)
        for i, x in side:
            at += len(x)
            out[int(np.searchsorted(starts, at))].append(i)
        groups.append(out)
    return [(groups[0][k], groups[1][k]) for k in sorted(groups[0])]


def test_alignment_equals_brute_force(spark, docs):
    got = sorted((tuple(r) for r in alignment.align(docs)[0].collect()), key=repr)
    rows = [(r.doc_id, plain_groups(r.text)) for r in docs.collect()]
    held = Counter()
    for _, groups in rows:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    want = []
    for doc, groups in rows:
        linked = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        want.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(linked),
                     sum(held[p] == best[p[0]] for p in linked), sum(held[p] for p in linked),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    assert got == sorted(want, key=repr)
    pairs = {(r.a, r.b): (r.n, r.best) for r in alignment.align(docs)[1].collect()}
    assert pairs == {p: (n, best[p[0]]) for p, n in held.items()}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=40))
def test_parts_align_like_the_whole(text):
    aligner = test_parts_align_like_the_whole.aligner
    parts = aligner.align_all(units.units_of(text)) if text else []
    got = [] if any(p is None for p in parts) else [g for p in parts for g in p]
    assert got == plain_groups(text)


test_parts_align_like_the_whole.aligner = alignment.Aligner(
    packing.vocabulary_path(alignment.BYTE_LEVEL), packing.vocabulary_path(alignment.PIECES))


def test_alignment_of_no_documents_and_a_very_long_text(spark):
    assert alignment.align(documents(spark, []))[0].count() == 0
    text = "Grüße an alle, " * 200_000
    row = alignment.align(documents(spark, [(1, text, None), (2, "", None)]))[0].where("doc_id = 1").first()
    once = plain_groups("Grüße an alle, " * 3)
    assert row.n_a > 200_000 and row.n_groups > 200_000 and len(once) < 40


def test_links_of_one_large_group():
    found = alignment.links([([1, 1, 2] * 1000, [5] * 2000)])
    assert found == {1 << alignment.SHIFT | 5: 2000 * 2000, 2 << alignment.SHIFT | 5: 1000 * 2000}


# -- the suffix tree, grown depth by depth -----------------------------------------------------------

def plain_tree(texts, min_count, min_gain):
    """Retained contexts and their counts by dictionaries."""
    from obsweave.llm import lm

    counts = defaultdict(Counter)
    syms, starts = lm.symbols(texts)
    for g in lm.grams(syms, starts).view(np.uint64).tolist():
        history, symbol = g >> 8, g & 255
        for d in range(lm.DEPTH + 1):
            if d == 0 or history >> (8 * (d - 1)):
                counts[d, history & ((1 << 8 * d) - 1)][symbol] += 1
    stays = {(0, 0)}
    for (d, c), own in counts.items():
        total = sum(own.values())
        if d and total >= min_count:
            parent = counts[d - 1, c & ((1 << 8 * (d - 1)) - 1)]
            gain = sum(n * np.log((n / total) / (parent[x] / sum(parent.values()))) for x, n in own.items())
            if gain >= min_gain:
                stays |= {(k, c & ((1 << 8 * k) - 1)) for k in range(1, d + 1)}
    return {(d, c, x, n) for d, c in stays for x, n in counts[d, c].items()}


def test_tree_equals_brute_force(spark, monkeypatch):
    from obsweave.llm import lm

    monkeypatch.setattr(lm, "BLOCK_BYTES", 700)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "there", "sea", "seal", "é日", "x\0y", "a"]) for _ in range(rng.randint(0, 40))) for _ in range(80)]
    df = documents(spark, [(i, t, None) for i, t in enumerate([*texts, None, ""])]).repartition(3)
    tokens, strings = lm.count(df)
    got = {(r.depth, r.context, r.next, r.n) for r in lm.retained(strings, 4, 2.0).collect()}
    assert got == plain_tree([*texts, None, ""], 4, 2.0)
    want = Counter(w for t in texts for w in t.split()) + Counter({"\n": 82})
    assert {r.token: r.n for r in tokens.collect()} == want


def test_nul_and_byte_one_are_different_tokens(spark):
    from pyspark.sql import functions as F

    from obsweave.llm import lm

    df = documents(spark, [(0, "a\0b", None), (1, "a\1b", None)])
    rows = {r.doc_id: r for r in lm.score(df, F.lit(True)).collect()}
    n, v = 4, 3
    want = np.log10(2 / (n + v + 1)) + np.log10(3 / (n + v + 1))
    assert [rows[i].base_score for i in (0, 1)] == pytest.approx([want, want])


# -- alignment of many parts: each token is read once, nothing is sorted ---------------------------


def test_parts_aligned_together_read_each_piece_once_and_sort_no_tokens(monkeypatch):
    aligner = alignment.Aligner(packing.vocabulary_path(alignment.BYTE_LEVEL), packing.vocabulary_path(alignment.PIECES))
    parts = ["zebra", "日本", "x1,y", "naïve", "a", "😀b"]
    want = [";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups).encode()
            for groups in aligner.align_all(parts)]
    rounds, encode = [], aligner.b.encode

    class Pieces(list):
        def __iter__(self):
            rounds.append(len(self))
            return super().__iter__()

    class Once:
        def __init__(self, pieces):
            self.pieces = Pieces(pieces)

    class Model:
        def encode(self, *args, **kw):
            return Once(encode(*args, **kw).pieces)

    monkeypatch.setattr(aligner, "b", Model())
    monkeypatch.setattr(np, "argsort", None)
    monkeypatch.setattr(np, "intersect1d", None)
    known = alignment._Table(aligner)
    assert known.add(parts) == list(range(len(parts))) and known.texts == want
    assert len(rounds) == 1


# -- alignment within a bounded memory ---------------------------------------------------------------

def one_task(spark, monkeypatch):
    """What a task does with a slice of rows."""
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(alignment, "over_texts", lambda *args, setup: setup()[0])
    return alignment._slices(documents(spark, []), packing.vocabulary_path(alignment.BYTE_LEVEL),
                             packing.vocabulary_path(alignment.PIECES), "doc_id", "text")


def test_a_task_keeps_the_parts_wanted_again_and_counts_all(spark, monkeypatch):
    made, add, rng = [], alignment._Table.add, random.Random(3)
    monkeypatch.setattr(alignment, "CACHE_CHARS", 2000)
    monkeypatch.setattr(alignment, "PARTS", 50, raising=False)
    monkeypatch.setattr(alignment._Table, "add", lambda self, units: made.extend(units) or add(self, units))
    each = one_task(spark, monkeypatch)
    common = [f"naïve{i}word" for i in range(60)]
    for k in range(12):
        words = common + [f"new{k}-{j}z" for j in range(40)]
        texts = [None, " ".join(rng.sample(words, 100)), "", " ".join(rng.choices(words, k=30)), " ".join(rng.choices(words, k=9))]
        out = {name: x[0] for name, x in each({"doc_id": [*range(5)], "text": texts}).items()}
        held, ends = Counter(), [0, *out["ends"]]
        for i, groups in enumerate(map(plain_groups, texts)):
            linked = Counter(x << alignment.SHIFT | y for a, b in groups for x in a for y in b)
            held.update(linked.keys())
            own = slice(ends[i], ends[i + 1])
            pairs = [out["keys"][p] for p in out["pair"][own]]
            assert len(pairs) == len(set(pairs)) and dict(zip(pairs, out["times"][own], strict=True)) == linked
            assert [out[c][i] for c in alignment.FIGURES] == [
                sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(linked.values())]
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            assert out["groups_sha256"][i] == (hashlib.sha256(text.encode()).hexdigest() if groups else "")
        assert dict(zip(out["keys"], out["docs"], strict=True)) == held and list(out["keys"]) == sorted(held)
    assert len(made) == len(set(made)) == 60 + 12 * 40


def test_memory_of_a_slice(spark, monkeypatch):
    each, rng = one_task(spark, monkeypatch), random.Random(3)
    words = [f"q{i}x;z{i}-j{i}" for i in range(50)]
    rows = {"doc_id": [*range(200)], "text": [" ".join(rng.choices(words, k=800)) for _ in range(200)]}
    each({"doc_id": [0], "text": [" ".join(words)]})
    tracemalloc.start()
    out = each(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(out["n_links"][0]) > 1_500_000
    assert peak < 60_000_000


def test_tasks_are_sent_a_few_slices_at_once(spark, monkeypatch):
    name, seen, spool = "spark.sql.execution.arrow.maxBytesPerBatch", {}, alignment.spool
    monkeypatch.setattr(alignment, "spool", lambda df, label, *args: (
        seen.setdefault(label, spark.conf.get(name)), spool(df, label, *args))[1])
    before = spark.conf.get(name)
    assert alignment.align(documents(spark, [(1, "a b", None)]))[0].count() == 1
    assert 2_000_000 <= int(seen["slices"].removesuffix("b")) < 10_000_000
    assert seen["pairs"] == spark.conf.get(name) == before


def test_stored_slices_are_written_and_read_a_few_at_once(spark, monkeypatch):
    made, spool = {}, alignment.spool
    monkeypatch.setattr(alignment, "spool", lambda df, label, *args: made.setdefault(label, spool(df, label, *args)))
    text = "internationalisation " * 50_000
    df = documents(spark, [(i, text, None) for i in range(10)]).coalesce(1)
    assert alignment.align(df)[0].where("doc_id is not null and n_a > 50000").count() == 10
    groups = [m.row_group(i).num_rows for f in made["slices"].inputFiles()
              for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert sum(groups) == 10 and max(groups) <= 8
