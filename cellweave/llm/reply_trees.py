"""Chat formatting of reply trees, with DataFrame functions only.

A node is one message with at most one parent. Pointer doubling, an iterative self-join on the
parent, gives every node its root, its depth and the score of its path in log2(depth) rounds;
leaves are ranked by that score, and the kept leaves' paths are enumerated by walking the saved
jump pointers from the longest to the shortest. Rows of a round never exceed nodes or path steps.

Template: a turn is ``<s>role[INST]text[/INST]``, and after a text under the loss ``</s>``
stands for ``[/INST]``. In roles and texts every ``<``, ``[`` and backslash is followed by an
added backslash, so that no control string can occur in them, and unescaping removes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

START, MIDDLE, END, LOSS_END = "<s>", "[INST]", "[/INST]", "</s>"
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def chain_nodes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Nodes of conversations whose rows follow one another by turn; equal turns by role, then text.

    Null role and text count as empty; a null turn comes first; rows of a null conversation form
    one conversation of their own.
    """
    tree = F.coalesce(F.col(conv).cast("string"), F.lit("null"))
    rows = turns.select(
        tree.alias("tree"),
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(ordered).cast("long")).select(
        "tree", "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def root_to_leaf(nodes: DataFrame, best: int = 1) -> DataFrame:
    """Steps of each tree's ``best`` branches: tree, leaf, branch (rank from 1), node, depth (from 1).

    nodes: tree string, node long, parent long or null, score double. A branch's score is the sum
    over its path, null as 0; ties go to the smaller leaf. A node whose parent is missing is a
    root; nodes on a cycle reach no root and form no branch.
    """
    links = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")).dropDuplicates(["tree", "node"])
    links = written(links, "links")
    there = links.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    now = links.join(there, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total")
    )
    leaves = links.join(links.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti").select("tree", "node")
    jumps, ended, most = [], None, links.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for k in range(int(most).bit_length() + 1):  # a round moves only the nodes that haven't reached their root
        now = written(now, f"jump{k}")
        there = now.where("up is null").drop("up")
        ended = there if ended is None else ended.unionByName(there)
        jumps.append(now.where("up is not null").select("tree", "node", "up"))
        if not jumps[-1].take(1):
            jumps.pop()
            break
        over = now.where("up is not null").unionByName(ended.withColumn("up", F.lit(None).cast("long")))
        over = over.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("sum"))
        now = now.where("up is not null").join(over, ["tree", "up"]).select("tree", "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("sum")).alias("total"))
    ranked = ended.join(leaves, ["tree", "node"]).withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "node")))
    steps = written(ranked.where(F.col("branch") <= best).select("tree", F.col("node").alias("leaf"), "branch", "node", "depth"), "leaves")
    for k, jump in reversed(list(enumerate(jumps))):
        more = steps.join(jump, ["tree", "node"]).select("tree", "leaf", "branch", F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth"))
        steps = written(steps.unionByName(more), f"steps{k}")
    return steps


def format_paths(nodes: DataFrame, best: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per chosen path: tree, conv_id, branch, formatted string, loss array of code-point spans (end exclusive).

    One formatted conversation is one string and has to fit a task's memory, as any training example does.
    """
    path = root_to_leaf(nodes, best).join(nodes.select("tree", "conv_id", "node", "role", "text"), ["tree", "node"])
    under = F.col("role").isin(*loss_roles)
    body = escape(F.col("text"))
    lead = F.concat(F.lit(START), escape(F.col("role")), F.lit(MIDDLE))
    turn = F.struct("depth", F.length(lead).cast("long").alias("lead"), F.length(body).cast("long").alias("body"), under.alias("under"), F.concat(lead, body, F.when(under, F.lit(LOSS_END)).otherwise(F.lit(END))).alias("turn"))
    grouped = path.groupBy("tree", "branch").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(turn)).alias("turns"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["lead"]
        span = F.array(F.struct(start.alias("start"), (start + x["body"]).alias("end")))
        return F.struct((state["at"] + F.length(x["turn"])).alias("at"), F.when(x["under"], F.concat(state["loss"], span)).otherwise(state["loss"]).alias("loss"))

    spans = F.aggregate("turns", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("loss")), step)
    return grouped.select("tree", "conv_id", "branch", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"), spans["loss"].alias("loss"))


def parse_formatted(formatted: Column) -> Column:
    """Turns as array of struct(role, text), from a formatted conversation."""
    ended = F.regexp_replace(formatted, r"(</s>|\[/INST\])(<s>|$)", "[/INST]$2")
    turns = F.filter(F.split(ended, r"\[/INST\]"), lambda x: x != "")
    return F.transform(
        turns,
        lambda x: F.struct(
            unescape(F.substring_index(F.substr(x, F.lit(len(START) + 1)), MIDDLE, 1)).alias("role"),
            unescape(F.substring_index(x, MIDDLE, -1)).alias("text"),
        ),
    )


def formatted_digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from formatted and loss alone."""
    read = formatted.withColumn("turns", parse_formatted(F.col("formatted"))).withColumn(
        "under", F.array_join(F.transform("loss", lambda x: unescape(F.substr(F.col("formatted"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))), "")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"),
        F.sha2(F.col("under").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
