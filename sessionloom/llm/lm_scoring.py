"""Language-model scoring: every text's log-probability under a causal self-attention model over subword ids, beside a unigram yardstick.

One pass turns all texts into subword ids and counts words and ids of the training documents. Word counts, however many words there are, stay
in a table: the `HEAD` most frequent words are sent to every task, a bounded number, and the rare rest is joined by word. The attention
model is trained by tasks on all training documents, each in one of `ROUNDS` rounds; after each round the tasks' parameters are
averaged, weighted by their windows.

Defined cases: a null or empty text is the end token alone. Rows that repeat are scored each and teach each. The fold is decided by the id; a null
id counts as the text "" there. Without training documents the model is its random start and all words are unknown. Only id and text
are read, so other columns can't clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention
from .common import LOWER, NOT_BLANK, Texts, owner, prefix_sums, query, settle, stretch_hash, table, texts, words
from .tokens import VOCABULARY, encode

FOLDS, HELD_OUT = 7, 2
HEAD = 1 << 20
ROUNDS = 2
BUCKETS = 256
#: Distinct words that a task holds before it hands them on.
HELD_WORDS = 1 << 21
IDS = 50_258
END = IDS - 1


def word_hashes(t: Texts):
    low = Texts(LOWER[t.data], t.at, t.first)
    start, stop, first = words(low, NOT_BLANK)
    return stretch_hash(prefix_sums(low.data), start, stop), first


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[head], np.add.reduceat(n, head) if len(head) else n


def prepare(docs: DataFrame, id_col: str, text_col: str, vocabulary: str) -> DataFrame:
    """Written rows of three kinds: documents (doc_id, train, text, ids), counted words (bucket, body), and counts of ids (bucket -1, body)."""

    def run(batches):
        count = np.zeros(IDS, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        empty = lambda n: [pa.nulls(n, kind), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary())]
        names = ["doc_id", "train", "text", "ids", "bucket", "body"]

        def flush():
            key, n = _summed(np.concatenate([k for k, _ in held]), np.concatenate([m for _, m in held]))
            cut = np.searchsorted(key >> np.uint64(56), np.arange(BUCKETS + 1).astype(np.uint64))
            body = [key[a:b].astype("<u8").tobytes() + n[a:b].astype("<i8").tobytes() for a, b in zip(cut[:-1], cut[1:])]
            return pa.RecordBatch.from_arrays([*empty(BUCKETS), pa.array(range(BUCKETS), pa.int32()), pa.array(body, pa.binary())], names=names)

        for batch in batches:
            kind = batch.column(0).type
            train = batch.column(2).to_numpy(zero_copy_only=False)
            for t in texts(batch.column(1)):
                rows = slice(t.first, t.first + len(t))
                h, first = word_hashes(t)
                teach = train[rows]
                h = h[teach[owner(first)]]
                if len(h):
                    held.append(_summed(h, np.ones(len(h), np.int64)))
                    size += len(held[-1][0])
                if size > HELD_WORDS:
                    # slices share words; what is few once they are added up stays
                    held = [_summed(np.concatenate([k for k, _ in held]), np.concatenate([m for _, m in held]))]
                    size = len(held[0][0])
                    if size > HELD_WORDS // 2:
                        yield flush()
                        held, size = [], 0
                ids = [encode(t.raw(i).decode(), vocabulary).astype("<u2") for i in range(len(t))]
                for own, ok in zip(ids, teach):
                    if ok:
                        count += np.bincount(own, minlength=IDS)
                        count[END] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[rows], batch.column(2)[rows], batch.column(1)[rows].fill_null(""), pa.array([x.tobytes() for x in ids], pa.binary()), pa.nulls(len(t), pa.int32()), pa.nulls(len(t), pa.binary())],
                    names=names,
                )
        if held:
            yield flush()
        if count.any():
            yield pa.RecordBatch.from_arrays([*empty(1), pa.array([-1], pa.int32()), pa.array([zlib.compress(count.astype("<i8").tobytes(), 1)], pa.binary())], names=names)

    key = F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (key % FOLDS != HELD_OUT).alias("train"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return settle(rows.mapInArrow(run, f"doc_id {kind}, train boolean, text string, ids binary, bucket int, body binary"), "lm-docs")


def word_counts(prepared: DataFrame) -> DataFrame:
    """(word, n): hashes of all training words with their counts; written."""

    def add(rows: pa.Table) -> pa.Table:
        parts = [np.frombuffer(b, "<u8") for b in rows["body"].to_pylist()]
        half = [len(p) // 2 for p in parts]
        key, n = _summed(np.concatenate([p[:h] for p, h in zip(parts, half)]), np.concatenate([p[h:].view("<i8") for p, h in zip(parts, half)]))
        return pa.table({"word": pa.array(key.view(np.int64)), "n": pa.array(n)})

    return settle(prepared.where("bucket >= 0").select("bucket", "body").groupBy("bucket").applyInArrow(add, "word long, n long"), "lm-words")


def _total(rows: DataFrame, column: str, kind: str, key: str = "part"):
    """The sum of packed arrays over all rows, in two steps, so that neither a task nor the driver holds all of them."""

    def add(t: pa.Table) -> pa.Table:
        out = 0
        for b in t[column].to_pylist():
            out = out + np.frombuffer(zlib.decompress(b), kind)
        return pa.table({column: pa.array([zlib.compress(out.tobytes(), 1)], pa.binary())})

    spread = rows.select(F.pmod(F.xxhash64(column), F.lit(64)).alias(key), column)
    got = spread.groupBy(key).applyInArrow(add, f"{column} binary").collect()
    return sum(np.frombuffer(zlib.decompress(r[column]), kind) for r in got) if got else None


def fit(prepared: DataFrame, know: attention.Ids, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Parameters after `rounds` rounds, which deal all training documents among them; a round's tasks train in parallel from the same start."""
    spark = prepared.sparkSession
    p = attention.start()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(rounds))
    for n in range(rounds):
        rows = prepared.where(F.col("bucket").isNull() & F.col("train") & (draw == n)).select("ids")
        shared = spark.sparkContext.broadcast((p, know))

        def run(batches, shared=shared, n=n):
            p, know = shared.value
            # two bytes an id are held, the windows are not
            ids = [(np.frombuffer(t.data.tobytes(), "<u2"), np.diff(t.at) // 2) for batch in batches for t in texts(batch.column(0))]
            if ids:
                flat, first = np.concatenate([x for x, _ in ids]), np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in ids]))])
                new, weight = attention.train(p, know, flat, first, END, seed=n)
                body = np.append(np.frombuffer(attention.pack(new), "<f4") * np.float64(weight), weight)
                yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(body.astype("<f8").tobytes(), 1)], pa.binary())], names=["body"])

        total = _total(rows.mapInArrow(run, "body binary"), "body", "<f8")
        if total is not None:
            p = attention.unpack((total[:-1] / total[-1]).astype("<f4").tobytes())
    return p


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    prepared = prepare(docs, id_col, text_col, vocabulary)
    counted = _total(prepared.where("bucket = -1").select("body"), "body", "<i8")
    know = attention.Ids(counted if counted is not None else np.zeros(IDS, np.int64))
    ends = int(counted[END]) if counted is not None else 0
    model = fit(prepared, know)
    words_ = word_counts(prepared)
    sums = words_.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = sums["n"] + ends, sums["v"] + (ends > 0)
    # the most frequent words: all above a level of counts; there are some hundred levels
    level = F.floor(F.log2(F.col("n")) * 8).cast("int")
    levels = words_.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    cut, size = None, 0
    for r in levels:
        size += r["count"]
        if size > HEAD:
            break
        cut = r["level"]
    is_head = level >= cut if cut is not None else F.lit(False)
    head = words_.where(is_head).toArrow()
    head_word, head_n = head["word"].to_numpy().view(np.uint64), head["n"].to_numpy()
    order = np.argsort(head_word)
    head_word, head_n = head_word[order], head_n[order]
    low = float(n + v + 1)
    head_log = np.log10((head_n + 1) / low)
    end_log = float(np.log10((ends + 1) / low))
    shared = spark.sparkContext.broadcast((model, know, head_word, head_log, end_log, ends))

    def run(batches):
        model, know, head_word, head_log, end_log, ends = shared.value
        base, seen = TaskContext.get().partitionId() << 40, 0
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "word", "times"]
        for batch in batches:
            for t in texts(batch.column(1)):
                rows = slice(t.first, t.first + len(t))
                number = base + seen + np.arange(len(t))
                seen += len(t)
                h, first = word_hashes(t)
                at = np.searchsorted(head_word, h)
                at[at == len(head_word)] = 0
                known = head_word[at] == h if len(head_word) else np.zeros(len(h), bool)
                own = owner(first)
                count = np.bincount(own[known], minlength=len(t)) + (ends > 0)
                logs = np.bincount(own[known], head_log[at[known]], minlength=len(t)) + end_log
                ids = [np.frombuffer(b, "<u2") for b in batch.column(2)[rows].to_pylist()]
                cut = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                got = attention.log_probabilities(model, know, np.concatenate(ids).astype(np.int32) if len(ids) else np.empty(0, np.int32), cut, END) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), batch.column(0)[rows], pa.compute.invert(batch.column(3)[rows]), pa.array(np.diff(first) + 1), pa.array(count.astype(np.int64)), pa.array(logs), pa.array(got), pa.nulls(len(t), pa.int64()), pa.nulls(len(t), pa.int64())],
                    names=names,
                )
                rare, who = h[~known], own[~known]
                if len(rare):
                    o = np.lexsort((rare, who))
                    rare, who = rare[o], who[o]
                    first_ = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (who[1:] != who[:-1])]))
                    m = len(first_)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number[who[first_]]), pa.nulls(m, batch.column(0).type), pa.nulls(m, pa.bool_()), *[pa.nulls(m, pa.int64())] * 2, *[pa.nulls(m, pa.float64())] * 2, pa.array(rare[first_].view(np.int64)), pa.array(np.diff(np.append(first_, len(rare))).astype(np.int64))],
                        names=names,
                    )

    kind = prepared.schema["doc_id"].dataType.simpleString()
    made = prepared.where("bucket IS NULL").select("doc_id", "text", "ids", "train").mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, word long, times long"
    )
    # rows are numbered by the task that writes them, so both kinds come from one written table
    made = settle(made, "lm-scores")
    rare = made.where("word IS NOT NULL").select("row", "word", "times").join(words_.where(~is_head), "word", "left")
    tail = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(low))).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    docs_ = made.where("word IS NULL").join(tail, "row", "left")
    return docs_.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )


@query("op7_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
