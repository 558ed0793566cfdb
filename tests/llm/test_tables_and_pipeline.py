"""URL rules and models, vector search, the pipeline's stages, and SQL beside the queries that have it."""

from __future__ import annotations

import math
import random
import tracemalloc

import numpy as np
import oracle
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import decontaminate, jaccard, knn, quality, url_filter
from sessionloom.llm.catalogue import ORACLE, QUERIES
from sessionloom.llm.common import texts

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    problem, n = oracle.compare(spark, oracle.duck(SF), QUERIES[name], ORACLE[name], SF)
    assert problem is None and n > 0


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[at:]
    end = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return rest[:at].translate({c: c + 32 for c in range(65, 91)}), path[:end]


def rule(host, path):
    fits = [(h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = [None, "", "no scheme", "http://", "http://NET/", "http://net", "https://a.Example.NET/en/x?y#z", "http://example.net/fr/", "http://xnet/", "x://y://example.com/de/1", "http://example.com?/de/", "http://É.org/fr/\n1", "http://b.org/fr/", "http://other.io/" + "a" * 5000, "http://b.org/fr/"]


def test_urls(spark):
    rows = [(n, u, "clash", 1.0) for n, u in enumerate(URLS)] + [(4, URLS[4], "clash", 2.0), (None, URLS[5], None, None)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, host string, score double")).collect()
    want = []
    for i, u, *_ in rows:
        r, v = rule(*parts(u))
        want.append((i, *parts(u), r, v))
    assert sorted(((g.page_id, g.host, g.path, g.rule, g.verdict if g.rule else None) for g in got), key=repr) == sorted(want, key=repr)
    assert all(g.verdict in ("allow", "block") for g in got)


def test_urls_learn(spark):
    """URLs that no rule decides follow the ruled ones that they look like; nothing learned, nothing blocked."""
    draw = random.Random(0)
    good, bad = (lambda: "".join(draw.choice("garden") for _ in range(8))), (lambda: "".join(draw.choice("pilz0") for _ in range(8)))
    rows = [(n, f"http://{good()}.org/fr/{good()}") for n in range(300)] + [(n, f"http://{bad()}.net/{bad()}") for n in range(300, 600)]
    rows += [(n, f"http://{good()}.io/fr/{good()}") for n in range(600, 650)] + [(n, f"http://{bad()}.io/{bad()}") for n in range(650, 700)]
    table = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(table).collect()}
    assert all(got[n] == "allow" for n in range(600, 650)) and all(got[n] == "block" for n in range(650, 700))
    alone = url_filter.filter_urls(table.where("page_id >= 600")).collect()
    assert len(alone) == 100 and {r.verdict for r in alone} == {"allow"} and {r.score for r in alone} == {0.0}
    assert url_filter.filter_urls(table.limit(0)).count() == 0


def test_url_model_is_a_distribution(spark):
    known = spark.createDataFrame([(True, "^^^abab"), (True, "^^^ba"), (False, "^^^aa")], "accepted boolean, s string")
    seen = spark.createDataFrame([(c + x,) for c in ("^^^", "aba", "zzz") for x in url_filter.SYMBOLS], "g string")
    # the ratio of two distributions, weighted by the second, sums to one
    got = {r.g: r.llr for r in url_filter.fit(known, seen).collect()}
    flat = {r.g: r.llr for r in url_filter.fit(known.where("accepted"), seen).collect()}
    for c in ("^^^", "aba", "zzz"):
        # without rejected URLs the second is uniform
        assert math.isclose(sum(math.exp(flat[c + x]) for x in url_filter.SYMBOLS) / len(url_filter.SYMBOLS), 1, rel_tol=1e-9)
    assert got["^^^b"] > 0 > got["aaaa"] if "aaaa" in got else got["^^^b"] > 0


def top(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ok = sorted({(i, tuple(v)) for i, v in ok})
    for q, v in ok:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
            yield from ((q, n + 1, i, -x) for n, (x, i) in enumerate(s))


@pytest.mark.parametrize("shape", ["spread", "hot", "large", "few"])
def test_vectors(spark, shape, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 40)
    monkeypatch.setattr(knn, "QUERIES_A_GROUP", 2)
    draw = random.Random(1)
    scale = 1e5 if shape == "large" else 1.0
    rows = [(n, [draw.gauss(n % 7, 0.3) * scale for _ in range(6)]) for n in range(3 if shape == "few" else 400)]
    if shape == "hot":
        rows += [(n, [0.5] * 6) for n in range(400, 700)]
    rows += [(1000, None), (1001, []), (1002, [None] * 6), (1003, [float("nan")] * 6), (1050, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), rows[0], rows[-1]]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, id int, cell string")
    got = knn.voronoi_top_k(table, F.col("id") % 50 == 0, pivots=8)
    assert sorted(map(tuple, got.collect())) == sorted(top(rows))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.voronoi_top_k(none, F.col("id") % 50 == 0).count() == 0
    assert knn.voronoi_top_k(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>"), F.col("id") % 50 == 0).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        seen.append((name, before, docs))
    for _, before, after in seen[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [{r.doc_id for r in a.select("doc_id").collect()} for _, _, a in seen]
    first = {r.doc_id for r in seen[0][1].select("doc_id").collect()}
    good = [d for d in first if labels.get(d) == 1]
    assert sum(d in ids[0] for d in good) >= 0.95 * len(good)
    bad = [d for d in first if labels.get(d) == 0]
    assert sum(d in ids[0] for d in bad) <= 0.1 * len(bad)
    parts_ = jaccard.jaccard_components(seen[1][1]).collect()
    assert ids[1] == {r.component_id for r in parts_}
    assert ids[2] == ids[1]
    assert all(r.n_chars == len(r.text) for r in seen[2][2].collect())
    found = decontaminate.find_items(seen[3][1], spark.read.parquet(f"{SF}/benchmark.parquet")).where(F.size("spans") == 0)
    assert ids[3] == {r.doc_id for r in found.select("row.doc_id").collect()}
    assert ids[4] == ids[3]
    assert corpus_pipeline.run(spark, SF).count() == seen[4][2].count()


def test_stages_bear_repeated_rows_and_nulls(spark):
    base = " ".join(f"w{n}" for n in range(150))
    rows = [(1, base, "en", "s", 5), (1, base, "en", "s", 5), (2, base + " x", None, None, None), (None, base, "en", "s", 1), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, None], key=repr)
    cut = corpus_pipeline.cut_repeats(spark, docs, SF).collect()
    assert len(cut) == len(rows) and {r.n_chars for r in cut if r.doc_id == 3} == {None}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_passes_over_text_are_small():
    """What numpy holds at once doesn't grow with the batch; before, it was some 100 bytes for each of 2^20 bytes of text."""
    draw = np.random.default_rng(0)
    column = pa.array([draw.integers(97, 123, 2000, dtype=np.uint8).tobytes().decode() for _ in range(2000)])
    model = quality.Model(draw.normal(size=quality.BUCKETS), 0.0)
    for one in (model.score, jaccard.grams):
        one(next(texts(column)))  # tables that are kept
        tracemalloc.start()
        n = sum(len(t) for t in texts(column) if one(t) is not None)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == 2000 and peak < 16 << 20


def test_batches_of_the_pipeline_are_small(spark):
    spark = spark.newSession()  # what a stage sets doesn't outlast the test
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat(cast(id AS string), 4000)").alias("text"))
    corpus_pipeline.drop_near_duplicates(spark, docs.where("doc_id < 3"), SF)

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"]) for b in batches)

    got = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 8 << 20
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    corpus_pipeline.pack(spark, docs.limit(1), SF)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
