"""Spelling variants: words one edit apart, found by a frontier of states that descends a relational trie level by level.

The trie is a table with one row for each node (a prefix of a word) and the symbols of its edges. A state is (word, position, node, edits): the word read
up to `position` stands at `node` after so many edits. One round joins the states of a level with the edges of that level and moves every
state one level down: by the word's next symbol, and once in a path by a larger symbol instead of it (a replacement) or by the symbol
after it (a deletion). A state that ends with one edit at a node that is a word has found a neighbour. Being near is symmetric, so larger symbols and
deletions are enough: the other half of the pairs are these ones turned round. Of a run of equal symbols only the last is deleted, so every pair is found once.

A node has at most as many edges as the alphabet has symbols, so a join never makes more rows than it has states. Edges of a level are written
apart, with their size known: Spark broadcasts a small level, so the words that all start at the root are not shuffled to it, and joins a large one by
node, where adaptive execution splits a node that many states share. Every level is written to the shared folder.

Words of more than `LEVELS` symbols would make as many rounds. For pairs with such a word, the hashes of a word with one symbol left out (all of them, computed
from prefix sums inside tasks) are rows that meet by hash and position, and the pair's words are compared in full.

Defined cases: null and empty texts have no words. A null id counts as an empty string before the colon. Repeated rows and copies count as often as they stand.
Ties of count go to the word that is smaller in code-point order. An empty table has no words. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, mix, query, settle, shared_folder, table

#: What a word is made of after lower-casing A-Z, and its parameters (fixed values of the contract).
RUN = "[a-zÀ-ÿ]+"
ONE_IN = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: Longest words of the trie, and rounds at most.
LEVELS = 40
#: Prefixes that a file of edges holds, about.
FILE_ROWS = 1_000_000


def word_counts(docs: DataFrame, one_in: int = ONE_IN, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n), written: the words long and frequent enough. Where the hash of id and run is a multiple of `one_in`, the run loses one symbol."""
    runs = docs.select(
        F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":")).alias("id"),
        F.explode(F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(RUN), F.lit(0))).alias("run"),
    )
    # a run one symbol too short is no word, whatever is done to it
    runs = runs.where(F.length("run") >= least_length).withColumn("h", F.crc32(F.concat("id", "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return settle(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count), "words")


def trie(words: DataFrame) -> tuple[str, str, int]:
    """Writes the edges, a folder for each level; returns the path, the schema and the number of levels.

    A row is a node, with its edges' symbols and whether they end a word."""
    spark = words.sparkSession
    size = words.agg(F.max(F.length("word")).alias("most"), F.sum(F.length("word")).alias("all")).first()
    files = 1 + (size["all"] or 0) // FILE_ROWS
    steps = words.select("word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("depth"))
    edge = steps.select("depth", F.expr("substring(word, 1, depth)").alias("node"), F.expr("substring(word, depth + 1, 1)").alias("c"), (F.length("word") == F.col("depth") + 1).alias("ends"))
    edges = edge.groupBy("depth", "node", "c").agg(F.max("ends").alias("ends")).groupBy("depth", "node").agg(F.collect_list(F.struct("c", "ends")).alias("kids"))
    path = f"{shared_folder(spark)}/trie-{uuid.uuid4().hex}"
    edges.repartition(F.col("depth"), F.pmod(F.xxhash64("node"), F.lit(files))).write.partitionBy("depth").option("compression", "zstd").parquet(path)
    return path, "node string, kids array<struct<c: string, ends: boolean>>", size["most"] or 0


def _moves() -> str:
    """The states that follow from (word, pos, node, edits, ends) and the node's edges."""
    now, then = "substring(word, pos + 1, 1)", "substring(word, pos + 2, 1)"

    def down(test, by, edits):
        return f"transform(filter(kids, k -> k.c {test}), k -> struct(pos + {by} AS pos, concat(node, k.c) AS node, {edits} AS edits, k.ends AS ends))"

    none = "CAST(array() AS array<struct<pos: int, node: string, edits: int, ends: boolean>>)"
    last = f"IF(pos + 1 = length(word) AND ends, array(struct(pos + 1 AS pos, node AS node, 1 AS edits, true AS ends)), {none})"
    skip = f"IF({now} <> {then}, {down('= ' + then, 2, 1)}, {none})"
    same = down("= " + now, 1, "edits")
    return f"IF(edits = 1, {same}, concat({same}, {down('> ' + now, 1, 1)}, {skip}, {last}))"


def near_pairs(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(a, b): every unordered pair of words one edit apart, once; `words` has distinct words and should be written."""
    spark = words.sparkSession
    path, schema, deep = trie(words.where(F.length("word") <= levels))
    at = words.where(F.length("word") <= levels).select("word", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(0).alias("edits"), F.lit(False).alias("ends"))
    found = long_pairs(words, levels)
    for depth in range(deep):
        edges = spark.read.schema(schema).parquet(f"{path}/depth={depth}")
        moved = at.join(edges, "node").select("word", F.explode(F.expr(_moves())).alias("x")).select("word", "x.*")
        ended = F.col("pos") >= F.length("word")
        at = settle(moved.where(~ended | ((F.col("edits") == 1) & F.col("ends"))), "frontier")
        found = found.unionByName(at.where(ended).select(F.col("word").alias("a"), F.col("node").alias("b")))
        at = at.where(~ended)
    return found


# ---------------------------------------------------------------- long words

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def left_out(word: str) -> np.ndarray:
    """Hashes of the word without its symbol i, for every i, and of the whole word last."""
    s = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = len(s)
    power = np.ones(n + 1, np.uint64)
    power[1:] = np.multiply.accumulate(np.full(n, _BASE, np.uint64))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(s * power[:n], out=sums[1:])
    low = np.zeros(n + 1, np.uint64)  # the symbols one place lower
    np.cumsum(s[1:] * power[: n - 1], out=low[2:])
    return mix(np.append(sums[:n] + (low[n] - low[1:]), sums[n]))


def long_pairs(words: DataFrame, levels: int) -> DataFrame:
    """(a, b) for the pairs of which one word has more than `levels` symbols. A group of rows that meet is small: its words differ at one place, by one of
    the alphabet's symbols. Words travel as hashes; only those of candidates are looked up, and compared."""
    long = words.where(F.length("word") >= levels).select(F.xxhash64("word").alias("id"), "word")

    def run(batches):
        for batch in batches:
            for id_, word in zip(batch.column(0).to_pylist(), batch.column(1)):
                h = left_out(word.as_py()).view(np.int64)
                n = len(h) - 1
                # a whole word meets deletions from words one longer; two deletions at one place are a replacement
                at, rest = np.append(np.arange(n), -1), np.append(np.full(n, n - 1), n)
                for lo in range(0, n + 1, 1 << 16):
                    s = slice(lo, lo + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h[s]), id_)), pa.array(at[s]), pa.array(h[s]), pa.array(rest[s])], names=["id", "at", "h", "rest"])

    rows = settle(long.mapInArrow(run, "id long, at long, h long, rest long"), "left-out")
    one, two = rows.select(F.col("id").alias("a"), "at", "h", "rest"), rows.select(F.col("id").alias("b"), F.col("at").alias("at_b"), "h", "rest")
    replaced = one.where("at >= 0").join(two.where("at_b >= 0").withColumnRenamed("at_b", "at"), ["h", "rest", "at"]).where(F.col("a") < F.col("b"))
    deleted = one.where("at >= 0").join(two.where("at_b < 0"), ["h", "rest"]).groupBy("a", "b").agg(F.min("at").alias("at"))
    maybe = replaced.select("a", "b", "at", F.lit(True).alias("both")).unionByName(deleted.select("a", "b", "at", F.lit(False).alias("both")))
    for side in ("a", "b"):
        maybe = maybe.join(long.select(F.col("id").alias(side), F.col("word").alias("word_" + side)), side)
    without = lambda c: F.concat(F.expr(f"substring({c}, 1, int(at))"), F.expr(f"substring({c}, int(at) + 2)"))
    wide = (F.length("word_a") > levels) | (F.length("word_b") > levels)
    sure = maybe.where(wide & (without("word_a") == F.when(F.col("both"), without("word_b")).otherwise(F.col("word_b"))))
    return sure.select(F.col("word_a").alias("a"), F.col("word_b").alias("b"))


# ---------------------------------------------------------------- forms


def variants(words: DataFrame, ratio: int = RATIO, levels: int = LEVELS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of `words` (word, n)."""
    pairs = settle(near_pairs(words, levels), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    near = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("top"))
    rows = words.join(near, "word", "left")
    fits = -F.col("top.m") >= ratio * F.col("n")
    rows = settle(rows.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("top.b")).alias("form"), F.when(fits, -F.col("top.m")).alias("form_n")), "forms")
    # counts grow by the ratio along a chain, so its length is a logarithm of the largest count, and the rounds are a logarithm of that
    at = settle(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        on = settle(at.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = on.drop("moved")
        if on.where("moved").limit(1).count() == 0:
            break
    return rows.join(at, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


WORDS_SQL = f"""
WITH bits AS (SELECT range(256) r),
crc AS MATERIALIZED (SELECT list_transform(r, lambda v: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, v)) t FROM bits),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
told AS MATERIALIZED (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc_id, run),
bytes AS MATERIALIZED (
    SELECT doc_id, run, k, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::INTEGER::BIGINT) AS b FROM told),
hashed AS MATERIALIZED (
    SELECT run, k, xor(list_reduce(b, lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc),
counts AS (
    SELECT CASE WHEN h % {ONE_IN} = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, sum(k)::BIGINT AS n FROM hashed GROUP BY 1),
words AS MATERIALIZED (SELECT word, n FROM counts WHERE length(word) >= {LEAST_LENGTH} AND n >= {LEAST_COUNT}),
dels AS MATERIALIZED (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
    SELECT DISTINCT a, b FROM (
        SELECT x.word AS a, y.word AS b FROM dels x JOIN dels y ON x.d = y.d AND x.i = y.i AND x.word <> y.word
        UNION ALL SELECT x.word, w.word FROM dels x JOIN words w ON x.d = w.word
        UNION ALL SELECT w.word, x.word FROM dels x JOIN words w ON x.d = w.word)),
near AS (
    SELECT a AS word, count(*) AS n_near, arg_min(b, (-m, encode(b))) AS top, max(m) AS m FROM (SELECT p.a, p.b, w.n AS m FROM pairs p JOIN words w ON w.word = p.b) GROUP BY a),
forms AS MATERIALIZED (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * n THEN top END AS form, CASE WHEN m >= {RATIO} * n THEN m END AS form_n FROM words LEFT JOIN near USING (word)),
walk AS (
    WITH RECURSIVE w AS (
        SELECT word, word AS here, 0 AS s FROM forms UNION ALL SELECT w.word, f.form, s + 1 FROM w JOIN forms f ON f.word = w.here AND f.form IS NOT NULL)
    SELECT word, arg_max(here, s) AS root FROM w GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN walk USING (word)
"""


@query("op11_spelling_variants", WORDS_SQL)
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents"))).select("word", "form", "root", "n", "n_near", "form_n")
