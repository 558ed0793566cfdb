"""The operators over documents against brute force, on whole small tables and on rows made to be awkward."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sessionloom.llm import attention, decontaminate, jaccard, lempel_ziv, lm_scoring, packing, quality, repeats, sharding, suffix, suffix_dedup, tokens
from sessionloom.llm.common import QUERIES

SF = "/root/testdata/sf0.001"
LOW = {c: c + 32 for c in range(65, 91)}
CLASH = ", row string, key string, w long, fp long, label int, score double, spans string, node string"


def awkward():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    base = " ".join(word() for _ in range(160))
    near = base.split()
    near[70] = "other"
    texts = [None, "", " \t\n", "One", "one", "Two words", base, base, " ".join(near), base[:350], "x" * 1300, "ab " * 400, base + "\n" + base, "\x0bé " * 30, "\x00 nul \x00 byte", " ".join(word() for _ in range(9000))]
    texts += [" ".join(word() for _ in range(draw.randint(1, 60))) for _ in range(12)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(6, base), (None, base), (None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    more = (None, None, 1, None, 2, 0.5, None, None)
    return spark.createDataFrame([(*r, *more) for r in rows], "doc_id long, text string" + CLASH).repartition(3)


def small(spark):
    got = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in got]


def key(x):
    return tuple((v is None, str(type(v)), v) for v in x)


def same(got, want):
    got, want = sorted((tuple(g) for g in got), key=repr), sorted(want, key=repr)
    assert got == want


# ------------------------------------------------------------------ decontamination


def words1(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))


def hits(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words1(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if w else ():
            windows[tuple(w[s : s + n])].add("" if i is None else str(i))
    sizes = {len(x) for x in windows}
    for d, t in docs:
        w, on, its = words1(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s : s + n])) in windows:
                    on |= set(range(s, s + n))
                    its |= windows[g]
        yield d, len(w), len(on), sorted(its)


ITEMS = "item_id long, text string"


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_decontamination(spark, docs, rows, block):
    base = rows[6][1].split()
    items = [(1, " ".join(base[20:45])), (2, "TWO, words"), (3, None), (4, ""), (None, " ".join(base[40:52])), (5, " ".join(base[20:45])), (5, " ".join(base[20:45])), (6, "absent here entirely")]
    table = spark.createDataFrame(items, ITEMS)
    found = decontaminate.find_items(docs, table, block_bytes=block).select("row.doc_id", "n_words", F.coalesce(decontaminate.hit_words(), F.lit(0)), F.array_join("items", ","))
    same(found.collect(), [(d, n, h, ",".join(i)) for d, n, h, i in hits(rows, items)])
    left = decontaminate.remove_contaminated(docs, table, block_bytes=block)
    assert left.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(d) for d, _, h, _ in hits(rows, items) if not h)


def test_longest_matches(spark, docs, rows):
    base = rows[6][1].split()
    got = decontaminate.longest_matches(docs, spark.createDataFrame([(1, " ".join(["zz"] + base[20:45]))], ITEMS)).collect()
    by = {r.item_start: r for r in got}
    assert by[1].n_words == 25 and 1 + 24 - 9 in by and 0 not in by
    text = dict((d, t) for d, t in rows if d is not None)[by[1].doc_id]
    assert words1(text)[by[1].doc_start :][:25] == base[20:45]


def test_no_items_and_no_documents(spark, docs):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.find_items(docs, none).where(F.size("spans") > 0).count() == 0
    assert decontaminate.find_items(docs.limit(0), none).count() == 0


# ------------------------------------------------------------------ suffix arrays


def test_induced_sorting():
    draw = np.random.default_rng(1)
    for _ in range(150):
        s = np.append(draw.integers(1, draw.integers(2, 6), draw.integers(1, 80)), 0).astype(np.uint16)
        assert suffix.suffix_array(s, int(s.max()) + 1, len(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_common_prefixes():
    draw = np.random.default_rng(2)
    s = np.append(np.tile(draw.integers(1, 4, 30), 4), 0).astype(np.uint16)
    sa = suffix.suffix_array(s, 5, len(s))
    equal = lambda i, j, n: np.array([s[a : a + m].tolist() == s[b : b + m].tolist() for a, b, m in zip(i, j, n)], bool)
    got = suffix.common_prefixes(s, sa, np.array([0]), 5, len(s), equal)
    for a, b in zip(sa[:-1], sa[1:]):
        n = next(k for k in range(len(s)) if max(a, b) + k >= len(s) or s[a + k] != s[b + k])
        assert got[b] == n if n >= 5 else got[b] < 5


def repeated_bytes(rows, window):
    count = Counter()
    raw = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raw:
        count.update(b[i : i + window] for i in range(len(b) - window + 1))
    for d, b in raw:
        on = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                on[i : i + window] = b"\1" * window
        kept = bytes(x for x, o in zip(b, on) if not o)
        spans = sum(1 for i, o in enumerate(on) if o and (i == 0 or not on[i - 1]))
        yield d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_dedup(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = suffix_dedup.cut_repeats(docs)
    same(got.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), repeated_bytes(rows, 400))
    assert got.select("row.*").columns == docs.columns
    assert suffix_dedup.cut_repeats(docs.limit(0)).count() == 0


def test_suffix_dedup_query(spark):
    same(QUERIES["op2_suffix_array_dedup"](spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect(), repeated_bytes(small(spark), 400))


# ------------------------------------------------------------------ Lempel-Ziv


def earlier_words(rows, window=20):
    seen = set()
    raw = [(d, (t or "").encode()) for d, t in rows]
    # null ids first, then by text hash
    for d, b in sorted(raw, key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(x[1]).digest())):
        w = b.split()
        on = [False] * len(w)
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if g in seen:
                on[i : i + window] = [True] * window
            seen.add(g)
        yield d, len(w), sum(on), hashlib.sha256(b" ".join(x for x, o in zip(w, on) if not o)).hexdigest()


@pytest.mark.parametrize("hot", [20_000, 1])
def test_substring_dedup(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", hot)
    got = lempel_ziv.cut_repeats(docs)
    same(got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), earlier_words(rows))
    assert lempel_ziv.cut_repeats(docs.limit(0)).count() == 0


def test_substring_dedup_query(spark):
    same(QUERIES["op8_substring_dedup"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), earlier_words(small(spark)))


def bounded(solve, bound):
    """`solve`, which fails when a group of a shard has more than `bound` rows."""

    def run(rows, *more):
        assert max(Counter(rows["shard_key"].to_pylist()).values(), default=0) <= bound
        return solve(rows, *more)

    return run


def test_no_shard_holds_a_hot_passage(spark, monkeypatch):
    """A passage longer than a window that many texts hold between words of their own."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(8))
    passage = " ".join(word() for _ in range(50))
    rows = [(d, " ".join([*(word() for _ in range(30)), passage, *(word() for _ in range(30))])) for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(repeats, "HOT", 10)
    monkeypatch.setattr(lempel_ziv, "solve_shard", bounded(lempel_ziv.solve_shard, 10))
    monkeypatch.setattr(suffix_dedup, "solve_shard", bounded(suffix_dedup.solve_shard, 10))
    same(lempel_ziv.cut_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), earlier_words(rows))
    got = suffix_dedup.cut_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    same(got.collect(), repeated_bytes(rows, 400))


# ------------------------------------------------------------------ Jaccard


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets if d is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    named = [(d, s) for d, s in sets if d is not None and s]
    for n, (a, x) in enumerate(named):
        for b, y in named[:n]:
            if 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((top(a), top(b)))
                up[q] = p
    for d, s in sets:
        yield d, len(s), d if d is None or not s else top(d)


def test_jaccard(docs, rows):
    same(jaccard.jaccard_components(docs).collect(), linked(rows))
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_jaccard_finds_links_across_a_group(spark):
    """Copies that differ too much from each other and meet only through others."""
    draw = random.Random(3)
    base = [f"w{n}" for n in range(200)]
    rows = []
    for n in range(60):
        w = list(base)
        for _ in range(draw.randint(0, 9)):
            w[draw.randrange(200)] = f"e{draw.randrange(10**6)}"
        rows.append((n, " ".join(w)))
    same(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect(), linked(rows))


def test_jaccard_counters_keep_their_order(spark):
    total = np.zeros(jaccard.BLOCK, np.uint32)
    total[:5] = 5, 65535, 70_000, 80_000, 4_000_000_000
    counted = spark.createDataFrame([(0, bytearray(zlib.compress(total.tobytes())))], "block int, counts binary")
    assert (np.diff(jaccard.merge_counts(counted, jaccard.BLOCK)[:5].astype(int)) > 0).all()


def test_crossings_make_no_pairs_within_a_component():
    n = 40_000
    node = np.arange(n)
    rows = pa.table({"gram": np.zeros(n, int), "node": node, "meta": np.full(n, 100 << 40), "comp": np.where(node == 7, 7, 0), "pivot": np.zeros(n, int), "side": np.zeros(n, int)})
    start = time.process_time()
    got = jaccard.crossings(rows)
    assert time.process_time() - start < 5
    assert got.num_rows == n - 2 and all(7 in (r["a"], r["b"]) for r in got.slice(0, 50).to_pylist())


def test_jaccard_deals_wide_columns_into_blocks(spark, docs, rows, monkeypatch):
    """A rare order of n-grams puts shared ones in front; groups of two blocks stay small."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(8))
    base = [word() for _ in range(60)]
    texts = []
    for d in range(120):
        own = list(base)
        for at in draw.sample(range(60), draw.randint(1, 3)):
            own[at] = word()
        texts.append((d, " ".join(own)))

    def small(solve):
        def run(rows, *more):
            assert max(Counter(rows["gram"].to_pylist()).values(), default=0) <= 60
            return solve(rows, *more)

        return run

    monkeypatch.setattr(jaccard, "WIDE", 12)
    monkeypatch.setattr(jaccard, "with_pivot", small(jaccard.with_pivot))
    monkeypatch.setattr(jaccard, "crossings", small(jaccard.crossings))
    blocks = jaccard.blocks_of
    made = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    same(jaccard.jaccard_components(made).collect(), linked(texts))
    monkeypatch.setattr(jaccard, "blocks_of", lambda code, most: blocks(code, most) + 2)
    same(jaccard.jaccard_components(docs).collect(), linked(rows))


def test_jaccard_query(spark):
    same(QUERIES["op10_ngram_jaccard"](spark, SF).select("doc_id", "n_shingles", "component_id").collect(), linked(small(spark)))


# ------------------------------------------------------------------ packing and sharding


def test_same_ids_as_the_other_library(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for t in ["", "  two  blanks\n\n", "<|endoftext|> isn't x", *[t for _, t in rows + small(spark)[:60] if t]]:
        assert tokens.encode(t).tolist() == other.encode(t, add_special_tokens=False).ids


def check_packing(got, rows, limit=2048):
    whole = defaultdict(list)
    for d, t in rows:
        whole[d].append(np.append(tokens.encode(t or ""), np.uint32(0)))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    for d, own in whole.items():
        want = []
        for ids in own:
            cuts = [0, *range(len(ids) % limit or limit, len(ids) + 1, limit)]
            want += [(n, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(pieces[d]) == sorted(want)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    total = sum(len(i) for own in whole.values() for i in own)
    assert len(sequences) <= math.ceil(total / limit) * 1.02 + 2


def test_packing(spark, docs, rows):
    cut = packing.pieces(docs)
    check_packing(packing.pack(cut.withColumn("ids_crc32", F.crc32("ids").cast("long")), group=16).collect(), rows)
    check_packing(QUERIES["op4_best_fit_packing"](spark, SF).collect(), small(spark))
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


@pytest.mark.parametrize("by", ["residual", "dot"])
def test_packing_holds_every_capacity(by):
    length = np.random.default_rng(0).integers(1, 90, 400)
    bins, offset = packing.best_fit(length, (100, 5, 6000), by=by)
    for b in np.unique(bins):
        own = length[bins == b]
        assert own.sum() <= 100 and len(own) <= 5 and ((own**2).sum() <= 6000 or len(own) == 1)


def check_shards(got, rows, shards=24, slack=None):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    slots, size = defaultdict(list), Counter()
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    aim, largest = sum(size.values()) / shards, max(r.size for r in got)
    assert all(abs(size[s] - aim) <= 2 * largest + 0.01 * aim for s in range(shards))


def test_sharding(spark, docs, rows):
    check_shards(sharding.shard_by_bytes(docs).collect(), rows)
    check_shards(QUERIES["op9_sharding"](spark, SF).collect(), small(spark))
    assert sharding.shard_by_bytes(docs.limit(0)).count() == 0


def test_sharding_splits_a_hot_group(spark):
    rows = [(n, "same text" * 20) for n in range(3000)] + [(n, f"text {n}" * 10) for n in range(3000, 4000)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check_shards(got, rows)


# ------------------------------------------------------------------ classifier and language model


def test_quality(spark, docs, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    got = quality.score(docs, model)
    assert got.count() == len(rows) and got.where("score BETWEEN 0 AND 1").count() == len(rows)
    assert got.select("row.*").columns == docs.columns
    empty = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, empty).select("score").collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def check_scores(got, rows):
    w = [(d, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + [None]) for d, t in rows]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(x for d, own in w if not held(d) for x in own)
    n, v = sum(c.values()), len(c)
    want = sorted((repr(d), held(d), len(own), sum(c[x] > 0 for x in own), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in own), 5)) for d, own in w)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("head", [1 << 20, 3])
def test_lm_scoring(docs, rows, head, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    check_scores(lm_scoring.score(docs).collect(), rows)


def test_lm_query(spark):
    check_scores(QUERIES["op7_lm_scoring"](spark, SF).collect(), small(spark))


def test_lm_learns_from_every_training_document(spark):
    """An id moves its row of the embedding when it is read; every document has ids of its own."""
    enc = tokens.encoding(tokens.VOCABULARY)
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    rows = [(d, "".join(enc.decode([i]) for i in range(1000 + 20 * d, 1020 + 20 * d))) for d in range(60)]
    prepared = lm_scoring.prepare(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text", tokens.VOCABULARY)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u2") for r in prepared.where("bucket IS NULL").select("doc_id", "ids").collect()}
    know = attention.Ids(lm_scoring._total(prepared.where("bucket = -1").select("body"), "body", "<i8"))
    new, old = lm_scoring.fit(prepared, know)["emb"], attention.start()["emb"]
    moved = (new != old).any(axis=1)
    taught = {i for d, own in ids.items() if not held(d) for i in own.tolist()}
    assert len(ids) == 60 and all(moved[know.slot[list(taught)]])
    others = {i for own in ids.values() for i in own.tolist()} - taught
    assert others and not moved[know.slot[list(others)]].any()


def test_training_lays_out_windows_in_parts(monkeypatch):
    ids, first = np.random.default_rng(0).integers(0, 59, 4000).astype("<u2"), np.array([0, 900, 900, 4000])
    know = attention.Ids(np.arange(60)[::-1])
    whole, n = attention.train(attention.start(), know, ids, first, 59)
    monkeypatch.setattr(attention, "HELD", 48)
    parts, m = attention.train(attention.start(), know, ids, first, 59)
    assert n == m == 38 + 1 + 130 and all((whole[k] == parts[k]).all() for k in whole)


def test_lm_empty(docs):
    assert lm_scoring.score(docs.limit(0)).count() == 0


def test_attention_gradients():
    """Numeric differences of the loss, and windows that score each id once."""
    from sessionloom.llm import attention as A

    know = A.Ids(np.arange(60)[::-1])
    ids, first = np.random.default_rng(0).integers(0, 59, 70), np.array([0, 40, 40, 70])
    slots, pad, target, valid, own = A.windows(ids, first, know, 59)
    assert np.bincount(own, valid.sum(1), minlength=3).tolist() == [41, 1, 31]
    p = {k: v.astype(np.float64) for k, v in A.start(1).items()}
    t, on = know.cls[target].reshape(-1), valid.reshape(-1)

    def loss(p):
        z = A.forward(p, slots, pad)[-1]
        return -((z - np.log(np.exp(z).sum(1, keepdims=True)))[np.arange(len(t)), t] * on).sum() / on.sum()

    g, _ = A.gradients(p, slots, pad, t, on)
    for name in g:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        assert abs((loss(up) - loss(down)) / 2e-4 - g[name][at]) < 1e-3 * max(1, abs(g[name][at]))
    assert np.allclose(A.infer(A.start(1), slots, pad), A.forward(A.start(1), slots, pad)[-1], atol=1e-4)
    # probabilities of all next ids sum to one
    total = np.exp(know.inside + 0.0)
    assert np.allclose(np.bincount(know.cls, total, minlength=A.CLASSES)[np.unique(know.cls)], 1, atol=1e-4)


def test_lm_words_in_parts(docs, rows, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HELD_WORDS", 7)
    check_scores(lm_scoring.score(docs).collect(), rows)


def test_training_step_is_plain_adam():
    """Training, one flat array a step, against a loop over the parameters by name; gradients fill the arrays they are given, also from logits far from 0."""
    draw = np.random.default_rng(3)
    ids, first = draw.integers(0, 59, 700).astype("<u2"), np.array([0, 300, 300, 700])
    know = attention.Ids(np.arange(60)[::-1])
    got, n = attention.train(attention.start(), know, ids, first, 59, batch=4)
    slots, pad, target, valid, _ = attention.windows(ids, first, know, 59)
    order = np.random.default_rng(0).permutation(n)
    p = attention.start()
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    steps = -(-n // 4)
    for step in range(steps):
        at = order[4 * step : 4 * step + 4]
        given = {k: np.full_like(v, np.nan) for k, v in p.items() if k != "emb"}
        g, dx = attention.gradients(p, slots[at], pad[at], know.cls[target[at]].reshape(-1), valid[at].reshape(-1), given)
        assert g is given and all(np.isfinite(x).all() for x in g.values())
        now = 0.01 * (1 - step / steps) + 0.01 / 50
        for k, d in g.items():
            mean[k] = 0.9 * mean[k] + 0.1 * d
            square[k] = 0.99 * square[k] + 0.01 * d * d
            p[k] -= now * (mean[k] / (1 - 0.9 ** (step + 1))) / (np.sqrt(square[k] / (1 - 0.99 ** (step + 1))) + 1e-6)
        d = np.zeros_like(p["emb"])
        np.add.at(d, slots[at], dx)
        square["emb"] += d * d
        p["emb"] -= now * 5 * d / (np.sqrt(square["emb"]) + 1e-6)
    assert n == 13 + 1 + 17 and all(np.allclose(got[k], p[k], atol=2e-3) for k in p)
    z = draw.normal(size=(5, 64)).astype(np.float32) * 100
    want = np.exp(z.astype(np.float64) - z.max(1, keepdims=True))
    e, sums = attention.softmax(z)
    assert np.allclose(e / sums[:, None], want / want.sum(1, keepdims=True), atol=1e-4)
