"""Spelling variants, reply trees and centroid clustering against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sessionloom.llm import centroids, reply_trees, spelling
from sessionloom.llm.common import settle


def same(got, want):
    assert sorted((tuple(g) for g in got), key=repr) == sorted(want, key=repr)


# ---------------------------------------------------------------- spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def forms_of(count, ratio=spelling.RATIO):
    out, form = {}, {}
    for w, n in count.items():
        around = sorted((-count[v], v) for v in count if near(w, v))
        form[w] = around[0][1] if around and -around[0][0] >= ratio * n else None
        out[w] = [n, len(around), form[w], count.get(form[w])]
    for w in count:
        at = w
        while form[at]:
            at = form[at]
        out[w].append(at)
    return [(w, *x) for w, x in out.items()]


def vocabulary(seed, size=120):
    draw = random.Random(seed)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(3, 9))) for _ in range(size)}
    words |= {"a" * n for n in range(3, 12)} | {"b" * 60, "b" * 61, "b" * 59 + "a", "é" + "b" * 60, "b" * 30 + "é" + "b" * 30, "b" * 40, "b" * 41, "b" * 39 + "a", "b" * 42}
    return {w: draw.choice([1, 1, 2, 5, 30, 200]) for w in words}


@pytest.mark.parametrize("levels", [1, 5, 12])
def test_every_pair_one_edit_apart_is_found_once(spark, levels):
    count = vocabulary(levels)
    words = settle(spark.createDataFrame(list(count.items()), "word string, n long"))
    got = [tuple(sorted(r)) for r in spelling.near_pairs(words, levels).select("a", "b").collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in count for b in count if a < b and near(a, b)}
    same(spelling.variants(words, levels=levels).select("word", "n", "n_near", "form", "form_n", "root").collect(), forms_of(count))


def test_words_of_awkward_documents(spark):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("ABcdéÀ÷×Éü") for _ in range(draw.randint(5, 8)))
    some = [word() for _ in range(30)]
    texts = [None, "", "12 . \n", "x" * 3000, " ".join("y" * 50 for _ in range(9)), " ".join(draw.choice(some) for _ in range(20_000))]
    texts += [" ".join(draw.choice(some) for _ in range(40)) for _ in range(60)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(7, texts[6])] * 4 + [(None, " ".join(some))] * 6
    docs = spark.createDataFrame([(*r, 1, "w", 2) for r in rows], "doc_id long, text string, n long, word string, depth int").repartition(3)
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            count[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    assert any(len(w) > 40 for w in count)
    same(spelling.variants(spelling.word_counts(docs)).select("word", "n", "n_near", "form", "form_n", "root").collect(), forms_of(count))


def test_no_words(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.word_counts(none)).collect() == []


def test_a_very_long_word_stays_small(spark):
    long = "".join(random.Random(1).choices("abcdef", k=100_000))
    words = settle(spark.createDataFrame([(long, 5), (long[:777] + long[778:], 50), (long[:50_000] + "z" + long[50_001:], 5), (long[::-1], 9)], "word string, n long"))
    got = {r["word"]: (r["n_near"], r["root"]) for r in spelling.variants(words).collect()}
    assert {n for n, _ in got.values()} == {0, 1, 2}
    assert got[long] == (2, long[:777] + long[778:]) and got[long[::-1]] == (0, long[::-1])


# ---------------------------------------------------------------- reply trees


def brute_paths(rows, top):
    """rows: tree -> node -> (parent, score)."""
    out = []
    for tree, nodes in rows.items():
        inner = {p for p, _ in nodes.values() if p in nodes}
        found = []
        for leaf in nodes:
            if leaf in inner:
                continue
            way, at = [leaf], leaf
            while nodes[at][0] in nodes and len(way) <= len(nodes):
                at = nodes[at][0]
                way.append(at)
            if len(way) <= len(nodes):
                found.append((tree, leaf, at, sum(nodes[x][1] or 0 for x in way), way[::-1]))
        for root in {f[2] for f in found}:
            best = sorted((f for f in found if f[2] == root), key=lambda f: (-f[3], f[1]))
            out += best[:top] if top else best
    return out


@pytest.fixture(scope="module")
def replies(spark):
    draw = random.Random(8)
    rows = {}
    for tree in (1, 2, None):
        nodes = {}
        for n in range(60):
            parent = draw.choice([None, 999]) if n < 3 else draw.randrange(max(0, n - 6), n)
            nodes[n] = (parent, draw.choice([None, 1.0, 2.0, -1.0]))
        nodes |= {100: (101, 1.0), 101: (102, 1.0), 102: (100, 1.0), 103: (102, 5.0)}  # a cycle, and a leaf below it
        rows[tree] = nodes
    flat = [(t, n, p, s, draw.choice(["user", "assistant", None, "tool [TURN]"]), f"{t}/{n}", 1, 2, "x", "y") for t, nodes in rows.items() for n, (p, s) in nodes.items()]
    df = spark.createDataFrame(flat, "thread long, id long, reply_to long, stars double, role string, text string, t int, n int, up string, tree string")
    return rows, settle(df.repartition(5))


@pytest.mark.parametrize("top", [1, 3, None])
def test_paths_of_reply_trees(spark, replies, top):
    rows, df = replies
    want = brute_paths(rows, top)
    made = reply_trees.format_trees(df, "thread", "id", "reply_to", score="stars", top=top).withColumn("turns", reply_trees.read_turns(F.col("formatted")))
    got = [(r["tree"], r["leaf"], r["root"], r["score"], [int(t["text"].split("/")[1]) for t in r["turns"]]) for r in made.collect()]
    same(got, want)
    assert max(len(w[4]) for w in want) > 10


def test_deep_path(spark):
    rows = spark.range(5000).select(F.lit(1).alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    made = reply_trees.digests(reply_trees.format_trees(rows, "tree", "node", "parent")).first()
    told = "".join(map(str, range(5000)))
    assert made["n_turns"] == 5000 and made["loss_sha256"] == hashlib.sha256(told.encode()).hexdigest()


def test_template_is_reversible(spark):
    draw = random.Random(2)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[TURN]", "[/TURN]", "\\", "<", "[", "/", "s>", "INST]", "\n", " ", "é", "𝄞", "$1", "text"]
    mess = lambda: "".join(draw.choice(bits) for _ in range(draw.randint(0, 9)))
    rows = [(c, turn, draw.choice(["user", "assistant", "system", None, "", "tool", mess()]), draw.choice([None, "", mess(), mess(), mess() + "\\" * 3])) for c in range(60) for turn in range(draw.randint(1, 7))]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (3, 2, "user", "twice"), (3, 2, "user", "twice"), (5, 0, "assistant", "x" * 2_000_000 + "<s>" * 1000)]
    df = spark.createDataFrame([(*r, "p", 1, "q") for r in rows], "conv_id long, turn long, role string, text string, formatted string, node int, tree string").repartition(4)
    made = reply_trees.format_trees(reply_trees.turns_as_tree(df), "tree", "node", "parent", top=None)
    made = made.select("tree", "formatted", "mask", reply_trees.read_turns(F.col("formatted")).alias("turns"), reply_trees.under_loss(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in r[:2]) + ((r[2] is not None, r[2] or ""), r[3] or "")
    for r in made:
        want = [(x[2], x[3] or "") for x in sorted((x for x in rows if x[0] == r["tree"]), key=order)]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["loss"] == [t for role, t in want if role == "assistant"]
        assert sum(a + b + c for a, b, c in r["mask"]) == len(r["formatted"])
    assert len(made) == 61


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert reply_trees.digests(reply_trees.format_trees(reply_trees.turns_as_tree(none), "tree", "node", "parent")).collect() == []


# ---------------------------------------------------------------- centroids


def brute_clusters(rows, k, rounds, dims, scale=1024):
    ok = lambda v: v is not None and len(v) == dims and all(c is not None and math.isfinite(c) and abs(c) <= centroids.LARGEST / scale for c in v)
    points = [(i, [math.floor(c * scale) for c in v]) for i, v in rows if ok(v)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    middle = [v for _, v in sorted((sha(f"3:{'' if i is None else i}"), v) for i, v in points)[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda: [min(range(len(middle)), key=lambda c: (away(v, middle[c]), c)) for _, v in points]
    for _ in range(rounds):
        own = nearest()
        for c in range(len(middle)):
            mine = [v for (_, v), o in zip(points, own) if o == c]
            if mine:
                middle[c] = [sum(x) // len(mine) for x in zip(*mine)]
    own = nearest()
    far = [away(v, middle[o]) for (_, v), o in zip(points, own)]
    each = [sum(d for d, o in zip(far, own) if o == c) for c in range(len(middle))]
    return [(i, o, d, each[o], sum(far), middle[o], sha(",".join(map(str, middle[o])))) for (i, _), o, d in zip(points, own, far)]


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 2), (50, 3), (1, 1)])
def test_clusters(spark, k, rounds):
    draw = random.Random(k)
    rows = [(n, [draw.choice([-1.5, 0.0, 0.25, 1.0]) + draw.choice([0, draw.random()]) for _ in range(3)]) for n in range(200)]
    rows += [(n, [float(n % 3), 0.0, 0.0]) for n in range(300, 340)] + [rows[0]] * 5 + [(0, [9.0, 9.0, 9.0])]
    rows += [(400, None), (401, []), (402, [1.0, None, 2.0]), (403, [1.0, math.nan, 2.0]), (404, [math.inf, 0.0, 0.0]), (405, [1.0, 2.0]), (406, [1e30, 0.0, 0.0])]
    rows += [(407, [131072.0, -131072.0, 131072.0]), (408, [-131072.0, 131072.0, -131072.0]), (None, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster int, x string, id int").repartition(4)
    got = centroids.cluster(df, k=k, rounds=rounds, dims=3)
    same(got.collect(), brute_clusters(rows, k, rounds, 3))


def test_no_vectors(spark):
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert centroids.cluster(none).collect() == []
    assert centroids.cluster(none.limit(0)).collect() == []
