"""Chat formatting of reply trees: root-to-leaf paths by iterative self-joins, branches ranked by score, one conversation for each chosen path.

A forest is rows (tree, node, parent, score). Self-joins double the distance a row looks up: table n holds for every node deep enough its
ancestor 2^n above and the scores passed on the way, so a path of d messages takes log2(d) rounds, each written to the shared folder. Leaves climb
to their roots by the binary digits of their depth, which gives the score of each branch; the `top` best of a root are chosen (the limit
within a partition comes before the shuffle, so a root with very many branches is no large group). Only chosen leaves are unfolded into the
(leaf, node, distance) rows of their paths, by the same tables, and only those meet the texts. A conversation is gathered once, as the
one row it becomes.

Template: a turn of a user is `[INST]`text`[/INST]`, of an assistant `<s>`text`</s>`, of a system `[SYS]`text`[/SYS]`, of any other role
`[ROLE]`role`[TURN]`text`[/ROLE]`, of a null role `[TURN]`text`[/TURN]`. In a text or role, a control string gets a backslash after its first
character, and one that already has backslashes there gets one more; taking one away restores the text, and no turn mark stands inside a
text. The loss mask is run lengths in code points (`before` without loss, `loss` with, `after` without), one triple a turn, that run on
through the conversation; assistants' texts are under it.

Everything is DataFrame expressions. Defined cases: null texts count as empty. A parent that is null or not in the tree makes a root. Rows that share tree and node
are an error of the input for trees in general; `turns_as_tree` numbers them, so repeated rows and ties in `turn` (taken by role, then text; nulls first) each are a turn of their own.
Nodes on a cycle, or below one, have no root and are on no path. Ties in score go to the smaller leaf. A null tree is a tree like others; a null node is on no path.
An empty table has no paths. Columns that aren't named are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, settle, table

#: The turn marks (fixed values).
OPEN = {"user": "[INST]", "assistant": "<s>", "system": "[SYS]"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "[/SYS]"}
#: What is escaped: an opening character, any backslashes, the rest of a control string.
CONTROLS = [(r"<(\\*)(/?s>)", "<"), (r"\[(\\*)(/?(?:INST|SYS|ROLE|TURN)\])", "[")]
#: The same with one backslash at least, which is taken away.
ESCAPED = [(r"<\\(\\*)(/?s>)", "<"), (r"\[\\(\\*)(/?(?:INST|SYS|ROLE|TURN)\])", "[")]
#: Ends of turns.
ENDS = r"(?<=</s>|\[/INST\]|\[/SYS\]|\[/ROLE\]|\[/TURN\])"


def escape(text):
    return reduce(lambda c, p: F.regexp_replace(c, p[0], p[1].replace("[", "\\[") + r"\\$1$2"), CONTROLS, text)


def unescape(text):
    return reduce(lambda c, p: F.regexp_replace(c, p[0], p[1].replace("[", "\\[") + "$1$2"), ESCAPED, text)


# ---------------------------------------------------------------- paths


def forest(rows: DataFrame, tree: str, node: str, parent: str, score: str | None = None) -> DataFrame:
    """(tree, node, up, gain), written: `up` is the parent where there is one."""
    gain = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    all_ = rows.select(F.col(tree).alias("tree"), F.col(node).alias("node"), F.col(parent).alias("up"), gain.alias("gain")).where("node IS NOT NULL")
    all_ = settle(all_, "nodes")
    known = all_.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    has = all_.where("up IS NOT NULL").join(known, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")), "left_semi")
    tops = all_.join(has.select(F.col("tree").alias("t"), F.col("node").alias("n")), F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    return settle(has.unionByName(tops.withColumn("up", F.lit(None).cast(all_.schema["up"].dataType))), "forest")


def _meets(left_node: str):
    return F.col("tree").eqNullSafe(F.col("t")) & (F.col(left_node) == F.col("n"))


def jumps(nodes: DataFrame) -> list[DataFrame]:
    """Table n: (t, n, to, passed): the ancestor 2^n above and the scores of the 2^n nodes below it, for every node so deep. Written, as
    many as the deepest path needs; cycles end after as many as the number of nodes needs."""
    step = settle(nodes.where("up IS NOT NULL").select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("to"), F.col("gain").alias("passed")), "jump")
    out, left, reach = [], step.count(), 1
    most = left
    while left and reach <= most:
        out.append(step)
        a = step.select(F.col("t").alias("tree"), F.col("n").alias("node"), F.col("to").alias("mid"), F.col("passed").alias("gain"))
        step = settle(a.join(step, _meets("mid")).select("t", F.col("node").alias("n"), "to", (F.col("gain") + F.col("passed")).alias("passed")), "jump")
        left, reach = step.count(), 2 * reach
    return out


def best_leaves(nodes: DataFrame, up: list[DataFrame], top: int | None = 1) -> DataFrame:
    """(tree, leaf, root, depth, score, rank): the `top` branches of each root by score, or all with rank null."""
    inner = nodes.where("up IS NOT NULL").select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    at = nodes.join(inner, _meets("node"), "left_anti").select("tree", F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0).cast("long").alias("depth"), F.lit(0.0).alias("score"))
    for n in range(len(up) - 1, -1, -1):
        far = F.col("to").isNotNull()
        at = at.join(up[n], _meets("at"), "left").select(
            "tree", "leaf", F.coalesce("to", "at").alias("at"), (F.col("depth") + F.when(far, 1 << n).otherwise(0)).alias("depth"),
            (F.col("score") + F.coalesce("passed", F.lit(0.0))).alias("score"),
        )
    # what still has a parent hangs on a cycle
    roots = nodes.where("up IS NULL").select(F.col("tree").alias("t"), F.col("node").alias("n"), "gain")
    done = at.join(roots, _meets("at")).select("tree", "leaf", F.col("at").alias("root"), "depth", (F.col("score") + F.col("gain")).alias("score"))
    if top is None:
        return done.withColumn("rank", F.lit(None).cast("int"))
    from pyspark.sql import Window

    order = Window.partitionBy("tree", "root").orderBy(F.desc("score"), "leaf")
    return done.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def paths(leaves: DataFrame, up: list[DataFrame]) -> DataFrame:
    """(tree, leaf, root, score, rank, node, pos): the nodes of each path, pos counts from the root."""
    at = leaves.select("tree", "leaf", "root", "score", "rank", F.col("leaf").alias("node"), F.col("depth").alias("pos"))
    for n in range(len(up) - 1, -1, -1):
        far = F.array(F.struct("node", "pos"), F.struct(F.col("to").alias("node"), (F.col("pos") - (1 << n)).alias("pos")))
        both = F.when(F.col("to").isNull(), F.slice(far, 1, 1)).otherwise(far)
        at = at.join(up[n], _meets("node"), "left").select("tree", "leaf", "root", "score", "rank", F.explode(both).alias("x"))
        at = at.select("tree", "leaf", "root", "score", "rank", "x.node", "x.pos")
    return at


# ---------------------------------------------------------------- template


def turn_marks(role, text):
    """(piece, before, loss, after) of one turn."""
    text = escape(F.coalesce(text, F.lit("")))
    name = escape(F.coalesce(role, F.lit("")))
    known = role.isin(*OPEN)
    opened = F.when(role.isNull(), "[TURN]").when(known, reduce(lambda c, r: c.when(role == r, OPEN[r]), OPEN, F)).otherwise(F.concat(F.lit("[ROLE]"), name, F.lit("[TURN]")))
    closed = F.when(role.isNull(), "[/TURN]").when(known, reduce(lambda c, r: c.when(role == r, CLOSE[r]), CLOSE, F)).otherwise(F.lit("[/ROLE]"))
    loss = F.coalesce(role == "assistant", F.lit(False))
    rest = F.length(opened) + F.length(closed)
    return F.struct(
        F.concat(opened, text, closed).alias("piece"),
        F.when(loss, F.length(opened)).otherwise(rest + F.length(text)).alias("before"),
        F.when(loss, F.length(text)).otherwise(0).alias("loss"),
        F.when(loss, F.length(closed)).otherwise(0).alias("after"),
    )


def conversations_of(path: DataFrame, rows: DataFrame, tree: str, node: str, role: str, text: str) -> DataFrame:
    """(tree, leaf, root, score, rank, formatted, mask): one row for each path."""
    said = rows.select(F.col(tree).alias("t"), F.col(node).alias("n"), turn_marks(F.col(role), F.col(text)).alias("turn"))
    turns = path.join(said, _meets("node")).select("tree", "leaf", "root", "score", "rank", "pos", "turn.*")
    held = turns.groupBy("tree", "leaf").agg(
        F.first("root").alias("root"), F.first("score").alias("score"), F.first("rank").alias("rank"),
        F.array_sort(F.collect_list(F.struct("pos", "piece", "before", "loss", "after"))).alias("turns"),
    )
    mask = F.transform("turns", lambda x: F.struct(x["before"].alias("before"), x["loss"].alias("loss"), x["after"].alias("after")))
    return held.select("tree", "leaf", "root", "score", "rank", F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("formatted"), mask.alias("mask"))


def read_turns(formatted):
    """array<struct<role, text>> of a formatted conversation."""
    pieces = F.filter(F.split(formatted, ENDS), lambda p: p != "")

    def one(p):
        inside = lambda a, b: F.substring(p, F.lit(len(a) + 1), F.length(p) - len(a) - len(b))
        other = inside("[ROLE]", "[/ROLE]")
        cut = F.instr(other, "[TURN]")
        role = reduce(lambda c, r: c.when(p.startswith(OPEN[r]), F.lit(r)), OPEN, F).when(p.startswith("[ROLE]"), unescape(F.substring(other, F.lit(1), cut - 1)))
        text = reduce(lambda c, r: c.when(p.startswith(OPEN[r]), inside(OPEN[r], CLOSE[r])), OPEN, F)
        text = text.when(p.startswith("[ROLE]"), F.substring(other, cut + 6, F.length(other))).otherwise(inside("[TURN]", "[/TURN]"))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, one)


def under_loss(formatted, mask):
    """array<string>: the unescaped texts under the mask, in order."""
    pieces = F.filter(F.split(formatted, ENDS), lambda p: p != "")
    both = F.arrays_zip(pieces.alias("p"), mask.alias("m"))
    taken = F.filter(both, lambda z: z["m"]["after"] > 0)
    return F.transform(taken, lambda z: unescape(F.substring(z["p"], z["m"]["before"] + 1, z["m"]["loss"])))


def format_trees(rows: DataFrame, tree: str, node: str, parent: str, role: str = "role", text: str = "text", score: str | None = None, top: int | None = 1) -> DataFrame:
    """One row for each chosen path: (tree, leaf, root, score, rank, formatted, mask)."""
    nodes = forest(rows, tree, node, parent, score)
    up = jumps(nodes)
    chosen = settle(best_leaves(nodes, up, top), "leaves")
    return conversations_of(settle(paths(chosen, up), "paths"), rows, tree, node, role, text)


def turns_as_tree(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(tree, node, parent, role, text): each conversation as a tree without branches, written; null turns first."""
    from pyspark.sql import Window

    rows = turns.select(F.col(conv).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a conversation becomes one row in the end, so its turns stand together here too
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")) - 1
    return settle(rows.withColumn("node", node).withColumn("parent", F.when(F.col("node") > 0, F.col("node") - 1)).drop("turn"), "turns")


def digests(made: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: (tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    read = made.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"), F.array_join(under_loss(F.col("formatted"), F.col("mask")), "").alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "tree", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: The conversation that tests the escapes (contract).
EXTRA = "</s>[INST] ok [/INST]"

CONVERSATIONS_SQL = rf"""
WITH turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{EXTRA}' UNION ALL SELECT -1, 1, 'assistant', '{EXTRA}'),
escaped AS (
    SELECT *, regexp_replace(regexp_replace(text, '<(\\*)(/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?(?:INST|SYS|ROLE|TURN)\])', '[\\\1\2', 'g') AS e,
        regexp_replace(regexp_replace(role, '<(\\*)(/?s>)', '<\\\1\2', 'g'), '\[(\\*)(/?(?:INST|SYS|ROLE|TURN)\])', '[\\\1\2', 'g') AS r FROM turns),
sized AS (
    SELECT *, length(e) + CASE WHEN role = 'user' THEN 13 WHEN role = 'assistant' THEN 7 WHEN role = 'system' THEN 11 WHEN role IS NULL THEN 13 ELSE 19 + length(r) END AS n
    FROM escaped)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op12_chat_formatting", CONVERSATIONS_SQL)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT -1L AS conv_id, CAST(n AS bigint) AS turn, IF(n = 0, 'user', 'assistant') AS role, '{EXTRA}' AS text FROM VALUES (0), (1) AS t(n)")
    made = format_trees(turns_as_tree(given.unionByName(extra)), "tree", "node", "parent", top=None)
    return digests(made).withColumnRenamed("tree", "conv_id")
