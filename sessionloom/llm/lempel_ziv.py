"""Substring dedup by relative Lempel-Ziv parsing: documents are factored greedily against indexed reference blocks; long factors, and the
windows at their boundaries, become duplicate spans.

`repeats` routes equal windows of words to one shard. A shard's regions, in the order of the corpus, are its reference block; its index
maps every window to the first place it stands at. Each region is factored from left to right: where the window at hand starts earlier in
the block, the factor goes on as long as block and region agree; all windows inside it start earlier too. A window across the end
of a factor may start earlier elsewhere, so each of those is looked up. A word that begins no long factor is a literal.

The first place is by document id (null before all others), then, for rows that share an id, by text hash; copies of one text
under one id are ordered at will. Every row but the first of a group of equal texts is removed whole if it has a window.

Defined cases: null and empty texts have no words; texts of fewer words than a window lose nothing. Columns of the input travel in one
struct, so their names can't clash with those added here.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_BLANK, prefix_sums, query, stretch_hash, table, texts, words
from .repeats import bundled, distinct_regions, find_regions, finer, meet, place, region_symbols, repeated, shards, split_hot, text_classes, text_key
from .suffix_dedup import covered, runs

WINDOW = 20
GRAM = 5
SHARD_BYTES = 8 << 20


def word_symbols(column):
    for t in texts(column):
        start, stop, first = words(t, NOT_BLANK)
        yield t.first, stretch_hash(prefix_sums(t.data), start, stop), first


def factor(symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, many: np.ndarray, window: int) -> np.ndarray:
    """For each place of a reference block: is it a window that starts earlier in the block? Region i is symbols[begin[i]:][:size[i]], its
    first `many[i]` places are windows; regions stand in the order of the corpus."""
    sums = prefix_sums(symbols)
    place = np.arange(int(many.sum())) + np.repeat(begin - (np.cumsum(many) - many), many)
    gram = stretch_hash(sums, place, place + window)
    order = np.argsort(gram, kind="stable")
    head = np.concatenate([[True], gram[order][1:] != gram[order][:-1]]) if len(order) else np.empty(0, bool)
    first = np.empty(len(symbols) + 1, np.int64)  # the index: of each window the first place
    first[place[order]] = place[order][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    stop = begin + size
    last = begin + many  # past the last window
    region = np.zeros(len(symbols) + 1, np.int64)
    region[: len(symbols)] = np.repeat(np.arange(len(size)), size)
    mark = np.zeros(len(symbols) + 1, np.int64)
    at = begin.copy()
    live = np.flatnonzero(at < last)
    while len(live):
        p = at[live]
        source = first[p]
        hit = source < p
        at[live[~hit]] += 1  # a literal
        f, p, source = live[hit], p[hit], source[hit]
        # the factor's length: by halving, at least a window
        low = np.full(len(f), window, np.int64)
        high = np.minimum(stop[f] - p, stop[region[source]] - source)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            mid = (low[open_] + high[open_] + 1) >> 1
            same = stretch_hash(sums, p[open_], p[open_] + mid) == stretch_hash(sums, source[open_], source[open_] + mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1
            open_ = open_[low[open_] < high[open_]]
        np.add.at(mark, p, 1)
        np.add.at(mark, p + low - window + 1, -1)
        # windows across the factor's end
        n = np.minimum(p + low, last[f]) - (p + low - window + 1)
        n = np.maximum(n, 0)
        edge = np.arange(int(n.sum())) + np.repeat(p + low - window + 1 - (np.cumsum(n) - n), n)
        edge = edge[first[edge] < edge]
        np.add.at(mark, edge, 1)
        np.add.at(mark, edge + 1, -1)
        at[f] = p + low
        live = live[at[live] < last[live]]
    return np.cumsum(mark)[: len(symbols)][place] > 0


def solve_shard(rows: pa.Table, window: int = WINDOW) -> pa.Table:
    """(key, a, b): stretches of windows of each region's first place that start earlier."""
    rows = rows.combine_chunks()
    rep = rows["rep"].combine_chunks()
    order = pa.table({"lead": rep.field("lead"), "key": rep.field("key"), "at": place(rep.field("w").to_numpy())[0]})
    rows = rows.take(pa.compute.sort_indices(order, sort_keys=[("lead", "ascending"), ("key", "ascending"), ("at", "ascending")], null_placement="at_start"))
    rep = rows["rep"].combine_chunks()
    body = rows["body"].to_pylist()
    size = np.array([len(b) // 8 for b in body], np.int64)
    many = rows["many"].to_numpy().astype(np.int64)
    begin = np.cumsum(size) - size
    on = factor(np.frombuffer(b"".join(body), np.uint64), begin, size, many, window)
    owner = np.repeat(np.arange(len(many)), many)
    a, b = runs(on, owner)
    own = owner[a] if len(a) else np.empty(0, np.int64)
    base = place(rep.field("w").to_numpy())[0][own] - (np.cumsum(many) - many)[own]
    return pa.table({"key": rep.field("key").take(pa.array(own)), "a": pa.array(a + base, pa.int32()), "b": pa.array(b + base, pa.int32())})


def earlier_regions(classes: DataFrame, members: DataFrame, window: int, subs: tuple[int, ...]) -> DataFrame:
    """(key, a, b): stretches of windows that start earlier in another region of `members` or in the same. Groups too large for a shard are dealt on into regions of
    `subs[0]` windows, and so on."""
    distinct = distinct_regions(members, ["lead", "key", "w"])
    cold, hot = split_hot(distinct)
    first = shards(region_symbols(classes, cold, word_symbols, window, "u8"), lambda rows: solve_shard(rows, window), "key binary, a int, b int", SHARD_BYTES)
    # a region that equals one before it starts earlier in all its windows
    rep = distinct.where("rows > 1").select("fp", "r", "rows", F.col("rep.key").alias("rep_key"), F.col("rep.w").alias("rep_w"))
    lo, many, _ = place(F.col("w"))
    each = meet(bundled(members), rep, ["fp", "r"], "rows").select("rep_key", "rep_w", F.inline("items"))
    later = each.where("key <> rep_key OR w <> rep_w").select("key", lo.cast("int").alias("a"), (lo + many).cast("int").alias("b"))
    found = first.unionByName(later)
    if hot is None or not subs:
        return found
    smaller = finer(classes, hot, word_symbols, window, subs[0])
    return found.unionByName(earlier_regions(classes, repeated(smaller), window, subs[1:]))


def earlier_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"):
    """(classes, spans): all distinct texts, and for each key its stretches (a, b) of windows that start earlier, for the first row of the text."""
    classes = text_classes(docs, id_col, text_col, 0)
    members = repeated(find_regions(classes, word_symbols, window, gram))
    found = earlier_regions(classes, members, window, (1,))
    return classes, found.groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def cut_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row; kept words are joined by one blank."""
    classes, spans = earlier_spans(docs, window, gram, id_col, text_col)

    def cut(batches):
        for batch in batches:
            out = {n: [] for n in ("words", "removed", "sha", "text")}
            list_ = batch.column(2)
            if list_.null_count:
                list_ = list_.fill_null([])
            at = list_.offsets.to_numpy() - list_.offsets[0].as_py()
            a, b = (list_.flatten().field(c).to_numpy() for c in ("a", "b"))
            for t in texts(batch.column(1)):
                for i in range(len(t)):
                    row = t.first + i
                    kept = t.raw(i).split()
                    n = len(kept)
                    if at[row] < at[row + 1]:
                        begin, end = covered(n, a[at[row] : at[row + 1]], b[at[row] : at[row + 1]], window)
                        edges = np.concatenate([[0], np.column_stack([begin, end]).reshape(-1), [n]]).tolist()
                        kept = [w for x, y in zip(edges[::2], edges[1::2]) for w in kept[x:y]]
                    joined = b" ".join(kept)
                    out["words"].append(n)
                    out["removed"].append(n - len(kept))
                    out["sha"].append(hashlib.sha256(joined).hexdigest())
                    out["text"].append(joined.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["words"], pa.int64()), pa.array(out["removed"], pa.int64()), pa.array(out["sha"], pa.string()), pa.array(out["text"], pa.string()), batch.column(3)],
                names=["key", "n_words", "n_removed", "sha", "kept", "lead"],
            )

    kind = classes.schema["lead"].dataType.simpleString()
    done = classes.join(spans, "key", "left").select("key", "text", "spans", "lead").mapInArrow(cut, f"key binary, n_words long, n_removed long, sha string, kept string, lead {kind}")
    # rows that share id and text: the first of them may be the first of its text, all others come later
    rows = docs.groupBy(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key")).agg(F.count("*").alias("copies"))
    rows = rows.select("doc_id", "key", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("nth"))
    leads = F.col("doc_id").eqNullSafe(F.col("lead")) & (F.col("nth") == 1)
    whole = ~leads & (F.col("n_words") >= window)
    return rows.join(done, "key").select(
        "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        *([F.when(whole, "").otherwise(F.col("kept")).alias("kept_text")] if with_text else []),
    )


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
hit AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op8_substring_dedup", SQL)
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"), with_text=False)
