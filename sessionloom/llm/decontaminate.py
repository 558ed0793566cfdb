"""Benchmark decontamination: suffix arrays of training shards, in which every test suffix is looked up by binary search.

A shard is a slice of documents inside a task. Its words become numbers of the benchmark's vocabulary; stretches of words that
all occur in the benchmark, and are as long as the shortest window, are the only places where a window can stand, and the shard's
suffix array holds their suffixes. All test suffixes search it at once, step by step: each finds its longest verbatim match and
where that is; windows that match in full find the run of suffixes that start with them. The words under those are hit, and
affected documents can be removed.

The benchmark reaches the tasks in blocks of at most `BLOCK_BYTES` of text, a size that is checked; a benchmark of more blocks is
looked up block after block, each adding to the spans found so far, so no block is ever joined with all others.

Defined cases: null and empty texts have no words and no hits; items without words have no windows; an item without id counts
under the id "". Repeated rows of documents each give a row, repeated items count once for each id. No items: nothing is hit.
Columns of the input travel in one struct, so their names can't clash with those added here.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, WORD_BYTE, Texts, owner, prefix_sums, query, settle, stretch_hash, table, texts, words

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: Bytes of documents whose suffix array every test suffix is looked up in; a block's suffixes cost as much in a small shard.
SHARD_BYTES = 1 << 20
#: Blocks that one stage looks up; more are cut by a written table.
BLOCKS_A_STAGE = 4


def _word_hashes(t: Texts):
    low = Texts(LOWER[t.data], t.at, t.first)
    start, stop, first = words(low, WORD_BYTE)
    return stretch_hash(prefix_sums(low.data), start, stop), first


class TestIndex:
    """A block of items: vocabulary, suffixes and windows as arrays. Small enough to be sent to every task."""

    def __init__(self, ids: list[str], bodies: list[str], window: int):
        column = pa.array(bodies, pa.string())
        hashes, first = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
        for t in texts(column):
            h, f = _word_hashes(t)
            hashes.append(h)
            first.append(f[1:] + first[-1][-1])
        self.words, self.first = np.concatenate(hashes), np.concatenate(first)
        self.vocabulary = np.unique(self.words)
        self.number = np.searchsorted(self.vocabulary, self.words) + 1
        size = np.diff(self.first)
        self.item_ids = np.array(ids, dtype=object)
        # a window for each start; a short item is one window
        span = np.minimum(size, window)
        count = np.where(size > 0, size - span + 1, 0)
        item = np.repeat(np.arange(len(size)), count)
        nth = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        start = self.first[:-1][item] + nth
        length = span[item]
        sums = prefix_sums(self.words)
        # equal windows are looked up once; `of_first`, `of` list the items of each
        _, head, same = np.unique(stretch_hash(sums, start, start + length), return_index=True, return_inverse=True)
        self.start, self.length = start[head], length[head]
        pair = np.unique(same.astype(np.int64) * len(size) + item) if len(item) else np.empty(0, np.int64)
        self.of = pair % max(len(size), 1)
        self.of_first = np.searchsorted(pair // max(len(size), 1), np.arange(len(head) + 1))
        self.rest = self.first[1:][owner(self.first)] - np.arange(len(self.words))  # words left in the item
        self.shortest = int(length.min()) if len(length) else 0


class ShardArray:
    """Suffix array of the stretches of a shard that can hold a window."""

    def __init__(self, number: np.ndarray, place: np.ndarray, rest: np.ndarray, depth: int):
        # number: word numbers, 0 ends a stretch; rest: words left in the stretch; place: where in the shard
        self.number, self.place, self.rest = number, place, rest
        rank = number.astype(np.int64)
        step = 1
        while step < depth:
            after = np.zeros(len(rank), np.int64)
            after[:-step] = rank[step:]
            after[rest <= step] = 0
            _, new = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)
            rank, step = new.astype(np.int64), step * 2
            if len(rank) == 0 or rank.max() == len(rank) - 1:
                break
        order = np.argsort(rank, kind="stable")
        self.order = order[rest[order] > 0]


def common_words(sums, i, j, most):
    """Length of the common start of the stretches at i and j, up to `most`; by halving on hashes."""
    lo, hi = np.zeros(len(i), np.int64), most.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi + 1) >> 1
        same = stretch_hash(sums, i, i + mid) == stretch_hash(sums, j, j + mid)
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)


def binary_search(shard: ShardArray, z: np.ndarray, sums, pattern: np.ndarray, length: np.ndarray, after: bool) -> np.ndarray:
    """First place in the suffix array not below the pattern (`after`: above all suffixes that start with it). Patterns start in z."""
    lo, hi = np.zeros(len(pattern), np.int64), np.full(len(pattern), len(shard.order), np.int64)
    while True:
        live = np.flatnonzero(lo < hi)
        if len(live) == 0:
            return lo
        mid = (lo[live] + hi[live]) >> 1
        i, j, n = shard.order[mid], pattern[live], length[live]
        most = np.minimum(n, shard.rest[i])
        l = common_words(sums, i, j, most)
        ended = l == n
        # the suffix is smaller if it ends first or its next word is smaller
        suffix_next = np.where(l < shard.rest[i], z[np.minimum(i + l, len(z) - 1)], 0)
        pattern_next = z[np.minimum(j + l, len(z) - 1)]
        smaller = np.where(ended, after, suffix_next < pattern_next)
        lo[live] = np.where(smaller, mid + 1, lo[live])
        hi[live] = np.where(smaller, hi[live], mid)


def look_up(t: Texts, index: TestIndex):
    """Hits of a shard: (words of each text, first word of each text, starts and lengths of matched windows, their number, longest).

    longest: (test suffix, shard word, words) of each test suffix's longest match of at least the shortest window.
    """
    hashes, first = _word_hashes(t)
    none = np.empty(0, np.int64)
    nothing = (first, none, none, none, (none, none, none))
    if len(hashes) == 0 or index.shortest == 0:
        return nothing
    at = np.searchsorted(index.vocabulary, hashes)
    at[at == len(index.vocabulary)] = 0
    known = index.vocabulary[at] == hashes
    # stretches of known words within a document
    begin, end = known.copy(), known.copy()
    begin[1:] &= ~known[:-1]
    end[:-1] &= ~known[1:]
    cut = first[1:-1]
    cut = cut[(cut > 0) & (cut < len(known))]
    begin[cut] = known[cut]
    end[cut - 1] = known[cut - 1]
    head, tail = np.flatnonzero(begin), np.flatnonzero(end) + 1
    keep = tail - head >= index.shortest
    head, tail = head[keep], tail[keep]
    if len(head) == 0:
        return nothing
    size = tail - head + 1  # one place more, for the end mark
    new = np.cumsum(size) - size
    nth = np.arange(size.sum()) - np.repeat(new, size)
    place = np.repeat(head, size) + nth
    rest = np.repeat(size - 1, size) - nth
    number = np.where(rest > 0, at[np.minimum(place, len(at) - 1)] + 1, 0)
    shard = ShardArray(number, place, rest, int(index.rest.max()))
    z = np.concatenate([number, index.number])
    sums = prefix_sums(z.astype(np.uint64))
    base = len(number)
    suffix = np.arange(len(index.number)) + base
    low = binary_search(shard, z, sums, suffix, index.rest, after=False)
    best, best_at = np.zeros(len(suffix), np.int64), np.zeros(len(suffix), np.int64)
    for side in (low - 1, low):
        ok = (side >= 0) & (side < len(shard.order))
        i = shard.order[np.clip(side, 0, len(shard.order) - 1)]
        l = common_words(sums, i, suffix, np.where(ok, np.minimum(index.rest, shard.rest[i]), 0))
        better = l > best
        best, best_at = np.where(better, l, best), np.where(better, shard.place[i], best_at)
    long = np.flatnonzero(best >= index.shortest)
    hit = np.flatnonzero(best[index.start] >= index.length)
    pattern, length = index.start[hit] + base, index.length[hit]
    lo = binary_search(shard, z, sums, pattern, length, after=False)
    hi = binary_search(shard, z, sums, pattern, length, after=True)
    n = hi - lo
    which = np.repeat(np.arange(len(hit)), n)
    found = shard.order[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    return first, shard.place[found], length[which], hit[which], (long, best_at[long], best[long])


def _spans(first, start, length, old: list) -> tuple[np.ndarray, np.ndarray]:
    """Maximal hit stretches of each text as (start, stop) pairs counted from its first word, flat; with those already known."""
    n = int(first[-1])
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    for k, pairs in enumerate(old):
        if pairs is not None and len(pairs):
            pairs = np.asarray(pairs) + first[k]
            np.add.at(step, pairs[::2], 1)
            np.add.at(step, pairs[1::2], -1)
    on = np.cumsum(step)[:n] > 0
    begin, end = on.copy(), on.copy()
    begin[1:] &= ~on[:-1]
    end[:-1] &= ~on[1:]
    cut = first[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begin[cut], end[cut - 1] = on[cut], on[cut - 1]
    begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
    own = np.searchsorted(first, begin, side="right") - 1
    flat = np.column_stack([begin - first[own], end - first[own]]).reshape(-1)
    return flat, 2 * np.searchsorted(begin, first)


def _pass(index, row_type: pa.DataType | None = None):
    """One block looked up in every batch of (row, text, n_words, spans, items)."""

    def run(batches):
        own = index.value
        for batch in batches:
            text = batch.column(1)
            old_spans, old_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            counts, spans, items = [], [], []
            for t in texts(text, SHARD_BYTES):
                first, start, length, window, _ = look_up(t, own)
                rows = range(t.first, t.first + len(t))
                flat, cut = _spans(first, start, length, [old_spans[r] for r in rows])
                counts.append(np.diff(first))
                doc = np.searchsorted(first, start, side="right") - 1
                pair = np.unique(doc * len(own.start) + window) if len(doc) else np.empty(0, np.int64)
                doc, window = pair // max(len(own.start), 1), pair % max(len(own.start), 1)
                at = np.searchsorted(doc, np.arange(len(t) + 1))
                for k, r in enumerate(rows):
                    spans.append(flat[cut[k] : cut[k + 1]].tolist())
                    got = set(old_items[r] or ())
                    for w in window[at[k] : at[k + 1]]:
                        got.update(own.item_ids[own.of[own.of_first[w] : own.of_first[w + 1]]])
                    items.append(sorted(got))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), text, pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                names=["row", "text", "n_words", "spans", "items"],
            )

    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES):
    """The items, block by block on the driver; the number of blocks follows from the checked size."""
    body = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    size = body.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        yield body.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct().collect()


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, n_words, spans, items) of every document; row: struct of the columns `keep`, all by default; spans: flat starts and stops."""
    spark = docs.sparkSession
    out = docs.select(
        F.struct(*[F.col(c) for c in keep or docs.columns]).alias("row"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast("array<bigint>").alias("spans"), F.lit(None).cast("array<string>").alias("items"),
    )
    for b, block in enumerate(item_blocks(items, item_id, item_text, block_bytes)):
        index = spark.sparkContext.broadcast(TestIndex([r["id"] for r in block], [r["text"] for r in block], window))
        out = out.mapInArrow(_pass(index), out.schema)
        if b % BLOCKS_A_STAGE == BLOCKS_A_STAGE - 1:
            out = settle(out, "hits")
    return out.drop("text")


def hit_words():
    """Words under the spans: stops less starts."""
    signed = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)


def longest_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim match of every test suffix across all shards: item, its first word, words, and one document with its first word."""
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    parts = []
    for block in item_blocks(items, item_id, item_text, block_bytes):
        index = spark.sparkContext.broadcast(TestIndex([r["id"] for r in block], [r["text"] for r in block], window))

        def run(batches, index=index):
            own = index.value
            for batch in batches:
                for t in texts(batch.column(1), SHARD_BYTES):
                    first, *_, (suffix, at, n) = look_up(t, own)
                    item = np.searchsorted(own.first, suffix, side="right") - 1
                    doc = np.searchsorted(first, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.item_ids[item], pa.string()), pa.array(suffix - own.first[item]), pa.array(n), batch.column(0).take(pa.array(doc + t.first)), pa.array(at - first[doc])],
                        names=["item_id", "item_start", "n_words", "doc_id", "doc_start"],
                    )

        rows = docs.select(id_col, text_col).mapInArrow(run, f"item_id string, item_start long, n_words long, doc_id {kind}, doc_start long")
        parts.append(rows.groupBy("item_id", "item_start").agg(F.max_by(F.struct("n_words", "doc_id", "doc_start"), "n_words").alias("m")).select("item_id", "item_start", "m.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, **names) -> DataFrame:
    """The documents without a hit, with all their columns."""
    return find_items(docs, items, window, **names).where(F.size("spans") == 0).select("row.*")


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
p AS (SELECT item_id, w, least(len(w), 10) AS l, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS g FROM p),
spots AS (SELECT doc_id, l, unnest(range(1, len(w) - l + 2)) AS s, w FROM d, (SELECT DISTINCT l FROM win)),
occ AS (SELECT doc_id, l, s, item_id FROM (SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS g FROM spots) JOIN win USING (l, g)),
hit AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(s, s + l)) FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op1_benchmark_decontamination", SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", F.coalesce(hit_words(), F.lit(0)).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.coalesce(hit_words(), F.lit(0)) > 0).alias("contaminated"),
    )
