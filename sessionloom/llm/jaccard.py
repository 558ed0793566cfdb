"""N-gram Jaccard join: a blocked sparse matrix product of documents by n-grams, cut by bounds that follow from set sizes.

A document's n-grams are ordered from rare to frequent. Two sets of sizes n and m with a Jaccard index of t or more share at least
o = ceil(t / (1 + t) * (n + m)) n-grams, so they share one among the first n - ceil(t n) + 1 of the larger; only these columns of
the incidence matrix are multiplied, in blocks dealt by n-gram, and a product whose places leave room for fewer than o common n-grams
is discarded at once. Counts of what is left are accumulated over blocks, and survivors are settled by their whole sets.

The order needs no exact counts to be right, any order gives whole results; it comes from counters of bounded number over all n-grams
of all documents. Rare first means that what a copy has of its own stands before what it shares, so copies that differ
too much never meet.

No column is multiplied in full. First every member of a column meets the member with the most frequent n-grams, the likely
original of a group of copies; links found so join components. Then only pairs of different components are made. This loses no link between
components, and links within one add nothing to it, so components are exact. A column that may have more than `WIDE` members is dealt into
blocks by document: each has its own pivot, and every two blocks meet in a group of their own.

Copies of a text are one row from the start. Defined cases: a null, empty or blank text has no n-grams, size 0, and is linked with nothing,
not with its like; with fewer words than n the whole sequence is the one n-gram. Rows that share an id are one document, linked
as all of them are. A null id can't name a component: such rows are linked with nothing and their component is null.
Only `id_col` and `text_col` are read, so other columns can't clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, NOT_BLANK, Texts, mix, owner, prefix_sums, query, settle, stretch_hash, table, texts, words
from .repeats import shards, text_classes, text_key

N = 5
PERCENT = 80
#: n-grams for each counter, and the least and most counters: the most bounds what is sent to every task (2 bytes each).
PER_COUNTER = 64
COUNTERS = (1 << 16, 1 << 26)
BLOCK = 1 << 16
#: Different counters that a task holds before it sends them off, and rows that one call adds up.
HELD = 1 << 22
FAN_IN = 256
#: Pairs that one numpy pass looks at.
PAIRS = 1 << 20
#: Members of a column, or of a block of a wider one.
WIDE = 1 << 13
#: Bytes of a block of columns.
MATRIX_BYTES = 4 << 20


def grams(t: Texts, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct n-grams of each text, sorted by hash within it."""
    low = Texts(LOWER[t.data], t.at, t.first)
    start, stop, first = words(low, NOT_BLANK)
    word = stretch_hash(prefix_sums(low.data), start, stop)
    size = np.diff(first)
    count = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    own = np.repeat(np.arange(len(size)), count)
    at = np.arange(len(own)) + np.repeat(first[:-1] - (np.cumsum(count) - count), count)
    h = stretch_hash(prefix_sums(word), at, at + np.minimum(size, n)[own])
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])]) if len(h) else np.empty(0, bool)
    h, own = h[new], own[new]
    return h, np.searchsorted(own, np.arange(len(size) + 1))


def need(n, m, percent: int = PERCENT):
    """The least number of common n-grams: 100 x >= percent * (n + m - x)."""
    return -(-percent * (n + m) // (100 + percent))


def _summed(slot: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots with their summed counts."""
    order = np.argsort(slot, kind="stable")
    slot, count = slot[order], count[order]
    head = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
    return slot[head], np.add.reduceat(count, head)


def _body(slot: np.ndarray, count: np.ndarray) -> bytes:
    """Slots (2 bytes) and counts (4 bytes) of a block, or all its counts where that is shorter."""
    if 6 * len(slot) < 4 * BLOCK:
        return slot.astype("<u2").tobytes() + count.astype("<u4").tobytes()
    all_ = np.zeros(BLOCK, "<u4")
    all_[slot] = count
    return all_.tobytes()


def count_grams(classes: DataFrame, n: int, counters: int) -> DataFrame:
    """Rows (key, size) for each class, and rows (block, counts) of what a task has counted, as pairs of slot and count; written. Memory goes with the
    n-grams of a part of the task, not with the number of counters."""

    def run(batches):
        held, waiting = [], 0

        def flush():
            slot, count = _summed(np.concatenate([s for s, _ in held]), np.concatenate([c for _, c in held]))
            blocks, first = np.unique(slot >> 16, return_index=True)
            cut = list(zip(first, np.append(first[1:], len(slot))))
            body = [zlib.compress(_body(slot[a:b] & (BLOCK - 1), count[a:b]), 1) for a, b in cut]
            return pa.RecordBatch.from_arrays([pa.nulls(len(blocks), pa.binary()), pa.nulls(len(blocks), pa.int64()), pa.array(blocks, pa.int32()), pa.array(body, pa.binary())], names=["key", "size", "block", "counts"])

        for batch in batches:
            sizes = []
            for t in texts(batch.column(0)):
                h, first = grams(t, n)
                sizes.append(np.diff(first))
                if len(h):
                    slot = (h & np.uint64(counters - 1)).astype(np.int32)
                    held.append(_summed(slot, np.ones(len(slot), np.uint32)))
                    waiting += len(held[-1][0])
                if waiting > HELD:
                    yield flush()
                    held.clear()
                    waiting = 0
            if sizes:
                size = np.concatenate(sizes)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(size, pa.int64()), pa.nulls(len(size), pa.int32()), pa.nulls(len(size), pa.binary())], names=["key", "size", "block", "counts"])
        if held:
            yield flush()

    return settle(classes.select("text", "key").mapInArrow(run, "key binary, size long, block int, counts binary"), "gram-counts")


def packed(count: np.ndarray) -> np.ndarray:
    """Counts in 16 bits that keep their order: exact below 2^15, by thousandths of an octave above."""
    over = 32768 + 1000 * (np.log2(np.maximum(count, 32768)) - 15)
    return np.where(count < 32768, count, np.minimum(over, 65535)).astype("<u2")


def blocks_of(code: np.ndarray, most: int) -> np.ndarray:
    """The number of blocks of about `most` members for a column whose n-gram has this packed counter."""
    count = np.where(code < 32768, code, 2.0 ** ((code - 32768) / 1000 + 15))
    return np.maximum(np.ceil(count / most), 1).astype(np.int64)


def merge_counts(counted: DataFrame, counters: int) -> np.ndarray:
    """All tasks' counters, packed; a fixed number of rows comes to the driver."""

    def total(rows: pa.Table) -> np.ndarray:
        out = np.zeros(BLOCK, np.int64)
        for c in rows["counts"].to_pylist():
            body = zlib.decompress(c)
            if len(body) in (4 * BLOCK, 8 * BLOCK):  # all counts, or a sum
                out += np.frombuffer(body, "<u4" if len(body) == 4 * BLOCK else "<i8")
                continue
            k = len(body) // 6
            out[np.frombuffer(body, "<u2", k)] += np.frombuffer(body, "<u4", k, 2 * k)
        return out

    def add(rows: pa.Table) -> pa.Table:
        return pa.table({"block": rows["block"][:1].cast(pa.int32()), "counts": pa.array([zlib.compress(total(rows).tobytes(), 1)], pa.binary())})

    def finish(rows: pa.Table) -> pa.Table:
        return pa.table({"block": rows["block"][:1].cast(pa.int32()), "counts": pa.array([packed(total(rows)).tobytes()], pa.binary())})

    part = counted.where("block IS NOT NULL").select("block", "counts")
    # steps of `FAN_IN` rows a group, so that no task adds up more than a share of what all tasks have counted
    many = part.groupBy("block").count().agg(F.max("count")).first()[0] or 0
    while many > FAN_IN:
        many = -(-many // FAN_IN)
        part = settle(part.groupBy("block", F.pmod(F.xxhash64("counts"), F.lit(many))).applyInArrow(add, "block int, counts binary"), "gram-sums")
    out = np.zeros(counters, np.uint16)
    for r in part.groupBy("block").applyInArrow(finish, "block int, counts binary").toLocalIterator():
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], "<u2")
    return out


def leading_grams(classes: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """(gram, node, meta, wide, part): the n-grams of each class among which a partner must show. meta packs size, place and how frequent its n-grams
    are. In a wide column `gram` is that of the block, `wide` the column's own, and part packs the number of blocks and the block; else both are 0."""
    shared = classes.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        count = shared.value
        mask = np.uint64(len(count) - 1)
        for batch in batches:
            for t in texts(batch.column(0)):
                h, first = grams(t, n)
                size = np.diff(first)
                own = owner(first)
                often = count[(h & mask).astype(np.int64)].astype(np.int64)
                order = np.lexsort((h, often, own))
                place = np.arange(len(h)) - first[:-1][own]
                keep = place < (size - (-(-percent * size // 100)) + 1)[own]
                at = order[keep]  # rank `place` of text own
                row, place = own[keep], place[keep]
                # how frequent the middle one of the leading n-grams is: highest for what copies were made from
                lead = np.flatnonzero(np.diff(row, prepend=-1))
                width = np.diff(np.append(lead, len(row)))
                central = np.repeat(np.minimum(often[at][lead + width // 2], 65535), width)
                # a size beyond its 23 bits is the largest there is, and its places count as first: bounds get weaker, never wrong
                large = size[row] >= (1 << 23) - 1
                meta = (np.minimum(size[row], (1 << 23) - 1) << 40) | (np.where(large, 0, np.minimum(place, (1 << 24) - 1)) << 16) | central
                node = batch.column(1).take(pa.array(row + t.first))
                blocks, gram = blocks_of(often[at], WIDE), h[at]
                part = np.where(blocks > 1, (blocks << 32) | (mix(node.to_numpy().view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64), 0)
                wide = np.where(part > 0, gram, np.uint64(0))
                gram = np.where(part > 0, mix(gram + mix(part.view(np.uint64))), gram)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), node, pa.array(meta, pa.int64()), pa.array(wide.view(np.int64)), pa.array(part, pa.int64())], names=["gram", "node", "meta", "wide", "part"])

    return classes.where("lead IS NOT NULL").select("text", "lead").mapInArrow(run, "gram long, node long, meta long, wide long, part long")


def unpack(meta: np.ndarray):
    return meta >> 40, (meta >> 16) & ((1 << 24) - 1), meta & 65535


def with_pivot(rows: pa.Table) -> pa.Table:
    """Columns and blocks with two members or more, or of a wide column, and for each row its pivot: the member with the most frequent n-grams."""
    gram, node, meta, wide, part = (rows[c].to_numpy() for c in ("gram", "node", "meta", "wide", "part"))
    order = np.lexsort((node, -(meta & 65535), gram))
    gram, node, meta, wide, part = gram[order], node[order], meta[order], wide[order], part[order]
    head = np.concatenate([[True], gram[1:] != gram[:-1]])
    at = np.flatnonzero(head)
    width = np.diff(np.append(at, len(gram)))
    keep = np.repeat(width > 1, width) | (part > 0)
    first = np.repeat(at, width)[keep]
    return pa.table({"gram": gram[keep], "node": node[keep], "meta": meta[keep], "pivot": node[first], "pivot_meta": meta[first], "wide": wide[keep], "part": part[keep]})


def possible(meta_a, meta_b, percent: int = PERCENT):
    """Sizes near enough, and room for the common n-grams from these places on."""
    (n, i, _), (m, j, _) = unpack(meta_a), unpack(meta_b)
    small, large = np.minimum(n, m), np.maximum(n, m)
    return (100 * small >= percent * large) & (1 + np.minimum(n - i, m - j) - 1 >= need(n, m, percent))


def stars(rows: pa.Table, percent: int = PERCENT) -> pa.Table:
    node, meta, pivot, pivot_meta = (rows[c].to_numpy() for c in ("node", "meta", "pivot", "pivot_meta"))
    ok = (node != pivot) & possible(meta, pivot_meta, percent)
    pair, count = np.unique(np.column_stack([np.minimum(node, pivot)[ok], np.maximum(node, pivot)[ok]]), axis=0, return_counts=True)
    return pa.table({"a": pa.array(pair[:, 0], pa.int64()), "b": pa.array(pair[:, 1], pa.int64()), "shared": pa.array(count, pa.int64())})


def meetings(rows: DataFrame) -> DataFrame:
    """(gram, node, meta, comp, pivot, side): the groups for `crossings`. A narrow column is one, with side 0; of a wide column that has more than one
    component each block is one, with side 0, and every two blocks are one, with sides 1 and 2."""
    kept = ["node", "meta", "comp", "pivot"]
    narrow = rows.where("part = 0").select("gram", *kept, F.lit(0).cast("long").alias("side"))
    broad = rows.where("part <> 0")
    mixed = broad.groupBy("wide").agg((F.min("comp") < F.max("comp")).alias("mixed")).where("mixed").select("wide")
    block, blocks = F.col("part").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("part", 32)
    each = broad.join(mixed, "wide").select("wide", *kept, block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    cell = F.xxhash64("wide", F.least("block", "other"), F.greatest("block", "other"))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).cast("long")
    return narrow.unionByName(each.select(cell.alias("gram"), *kept, side.alias("side")))


def crossings(rows: pa.Table, percent: int = PERCENT) -> pa.Table:
    """Pairs of different components in a group of `meetings`, and no others: components are numbered, and two of them part at one bit of their
    numbers, the highest that differs. Pairs with the pivot were settled before."""
    gram, node, meta, comp, pivot, side = (rows[c].to_numpy() for c in ("gram", "node", "meta", "comp", "pivot", "side"))
    order = np.lexsort((comp, gram))
    gram, comp = gram[order], comp[order]
    column = np.cumsum(np.diff(gram, prepend=gram[:1]) != 0)
    rank = np.cumsum((np.diff(comp, prepend=comp[:1]) != 0) | (np.diff(column, prepend=0) != 0))
    head = np.flatnonzero(np.diff(column, prepend=-1))
    width = np.diff(np.append(head, len(gram)))
    rank = rank - np.repeat(rank[head], width)
    top = np.repeat(rank[head + width - 1], width)
    # columns of one component have nothing to tell
    order, column, rank, top = order[top > 0], column[top > 0], rank[top > 0], top[top > 0]
    node, meta, pivot, side = node[order], meta[order], pivot[order], side[order]
    size, other = meta >> 40, np.array([0, 2, 1])[side]
    out: list[np.ndarray] = []
    for bit in range(int(top.max(initial=0)).bit_length()):
        live = np.flatnonzero(top >> bit)
        group = np.cumsum((np.diff(column[live], prepend=-1) != 0) | (np.diff(rank[live] >> (bit + 1), prepend=0) != 0))
        high = (rank[live] >> bit) & 1 == 1
        partner = ((group * 3 + side[live]) << 32 | size[live])[high]
        by = np.argsort(partner)
        partner, right = partner[by], live[high][by]
        left = live[~high]
        base, n = (group[~high] * 3 + other[left]) << 32, size[left]
        # sizes between which equal n-grams are enough
        lo = np.searchsorted(partner, base | -(-percent * n // 100))
        width = np.maximum(np.searchsorted(partner, base | (100 * n // percent), side="right") - lo, 0)
        at, run = 0, np.concatenate([[0], np.cumsum(width)])
        while at < len(left):
            stop = max(at + 1, int(np.searchsorted(run, run[at] + PAIRS, side="right")) - 1)
            w = width[at:stop]
            x = np.repeat(left[at:stop], w)
            y = right[np.arange(len(x)) + np.repeat(lo[at:stop] - (np.cumsum(w) - w), w)]
            at = stop
            ok = (side[x] > 0) | ((node[x] != pivot[x]) & (node[y] != pivot[y]))
            x, y = x[ok], y[ok]
            ok = possible(meta[x], meta[y], percent)
            out.append(np.column_stack([np.minimum(node[x], node[y])[ok], np.maximum(node[x], node[y])[ok]]))
            if sum(map(len, out)) > PAIRS:
                out = [np.unique(np.concatenate(out), axis=0)]
    pair, count = np.unique(np.concatenate(out), axis=0, return_counts=True) if out else (np.empty((0, 2), np.int64), np.empty(0, np.int64))
    return pa.table({"a": pa.array(pair[:, 0], pa.int64()), "b": pa.array(pair[:, 1], pa.int64()), "shared": pa.array(count, pa.int64())})


def links_of(pairs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of the pairs whose whole sets are similar enough; written."""
    ids = classes.select("lead", "key")
    pairs = pairs.join(ids.select(F.col("lead").alias("a"), F.col("key").alias("ka")), "a").join(ids.select(F.col("lead").alias("b"), F.col("key").alias("kb")), "b")
    left = classes.select(F.col("key").alias("ka"), F.col("text").alias("ta"))
    right = classes.select(F.col("key").alias("kb"), F.col("text").alias("tb"))
    both = pairs.select("a", "b", "ka", "kb").join(right, "kb").join(left, "ka").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            sets = []
            for col in (2, 3):
                own = []
                for t in texts(batch.column(col)):
                    h, first = grams(t, n)
                    own += [h[first[i] : first[i + 1]] for i in range(len(t))]
                sets.append(own)
            ok = []
            for x, y in zip(*sets):
                common = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) else 0
                ok.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in (batch.column(0), batch.column(1))], names=["a", "b"])

    return settle(both.mapInArrow(run, "a long, b long").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of a link; comp is the smallest node reachable. Labels fall by neighbours and by their own labels."""
    edges = settle(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    label = settle(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = edges.join(label.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        jump = label.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = label.join(near, "node").join(jump, "comp").select("node", F.least("near", "up").alias("comp"), F.col("comp").alias("old"))
        new = settle(new, "labels")
        changed = new.where("comp < old").limit(1).count()
        label = new.select("node", "comp")
        if not changed:
            return label


def jaccard_components(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    classes = text_classes(own, "doc_id", "text", 0, null_leads=False)
    bytes_ = classes.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counters = COUNTERS[0]
    while counters < COUNTERS[1] and counters * PER_COUNTER * 6 < bytes_:
        counters *= 2
    counted = count_grams(classes, n, counters)
    leading = leading_grams(classes, merge_counts(counted, counters), n, percent)
    kept = settle(shards(leading, with_pivot, "gram long, node long, meta long, pivot long, pivot_meta long, wide long, part long", MATRIX_BYTES, "gram"), "columns")
    star = kept.mapInArrow(lambda batches: (b for x in batches for b in stars(pa.Table.from_batches([x]), percent).to_batches()), "a long, b long, shared long")
    first = links_of(star.groupBy("a", "b").agg(F.sum("shared").alias("shared")), classes, n, percent)
    label = components(first)
    rows = kept.join(label, "node", "left").select("gram", "node", "meta", "pivot", "wide", "part", F.coalesce("comp", "node").alias("comp"))
    cross = shards(meetings(rows), lambda t: crossings(t, percent), "a long, b long, shared long", MATRIX_BYTES, "gram")
    second = links_of(cross.groupBy("a", "b").agg(F.sum("shared").alias("shared")), classes, n, percent)
    label = components(settle(first.unionByName(second), "links"))
    size = counted.where("block IS NULL").select("key", "size")
    named = classes.select("key", "lead").join(size, "key").join(label.select(F.col("node").alias("lead"), "comp"), "lead", "left")
    sized = own.select("doc_id", text_key(F.col("text")).alias("key")).join(named, "key")
    return sized.select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "lead"))).otherwise(F.col("doc_id")).alias("component_id"),
    )


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 80 * (na.n + nb.n - x)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON r.doc_id = e.a)
SELECT doc_id, coalesce(max(n.n), 0) AS n_shingles, coalesce(min(r.c), doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY doc_id
"""


@query("op10_ngram_jaccard", SQL)
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
