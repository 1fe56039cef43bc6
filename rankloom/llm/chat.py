"""Reply trees to conversations.

A forest of messages (each knows its parent) becomes one text per chosen
root-to-leaf path.  Paths are enumerated by iterative self-joins: joining the
table of 2^k-th ancestors with itself gives the 2^(k+1)-th ones, and going from
the longest jump to the shortest, each path gains its missing messages.  A tree
of depth d takes log2(d) rounds, and the rows handled are proportional to the
messages on the paths, however deep a thread is.

Only DataFrame functions are used.  Texts are not carried through the rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.session import materialize

# The template: "### role: text</turn>\n" for every turn.
TURN_OPEN, ROLE_END, TURN_CLOSE = "### ", ": ", "</turn>\n"
# A backslash goes in front of the rest of a control string, so that none is left whole.
_CONTROL = r"\\|(?<=#)#|(?<=<)/turn>"
_ROLE_CONTROL = _CONTROL + "|(?<=:) "


def escape(text: Column) -> Column:
    """Text in which no control string of the template occurs."""
    return F.regexp_replace(text, _CONTROL, r"\\$0")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, _ROLE_CONTROL, r"\\$0")


def unescape(text: Column) -> Column:
    """Inverse of both."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def threads(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as messages: every turn answers the one before it.

    Rows with the same turn follow each other by role and text.  Rows whose
    conversation is NULL form one conversation with that id.
    """
    from pyspark.sql import Window

    cols = [F.col(f"`{c}`").alias(a) for c, a in ((conv_col, "conv_id"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))]
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select(*cols).withColumn("node_id", F.row_number().over(order).cast("bigint"))
    parent = F.when(F.col("node_id") > 1, F.col("node_id") - 1)
    return numbered.select("conv_id", "node_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def reply_paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """``conv_id, path_id, branch, depth, node_id``: the messages of every chosen path, depth 0 at the root.

    ``messages``: conv_id, node_id, parent_id, role, text, score; other columns
    are not read.  A message that nobody answers is a leaf and names the path;
    one whose parent is missing is a root.  The paths of a conversation are
    ranked by the sum of their scores (NULL counts 0), then by leaf;
    ``branches`` keeps the best ones, None keeps all.  If a node id repeats
    within a conversation, its smallest row (parent, score, role, text) counts.
    Messages with a NULL node id are left out, as nothing can refer to them, and
    so are those behind a circle of replies, which has no root.  Empty in, empty out.
    """
    nodes = materialize(
        messages.filter(F.col("node_id").isNotNull())
        .groupBy("conv_id", "node_id")
        .agg(F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m"))
        .select("conv_id", "node_id", "m.parent_id", "m.score")
    )
    ids = nodes.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"))
    links = nodes.filter(F.col("parent_id").isNotNull()).select("conv_id", "node_id", F.col("parent_id").alias("up"))
    links = materialize(links.join(ids, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n")), "left_semi"))
    parents = links.select(F.col("conv_id").alias("c"), F.col("up").alias("n")).distinct()
    leaves = nodes.join(parents, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("n")), "left_anti")

    total = nodes.count()
    jumps = [links]
    while not jumps[-1].isEmpty() and 2 ** (len(jumps) - 1) < total:
        last = jumps[-1]
        onward = last.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), F.col("up").alias("further"))
        joined = last.join(onward, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n")))
        jumps.append(materialize(joined.select("conv_id", "node_id", F.col("further").alias("up"))))
    endless = jumps.pop()  # empty unless replies go in a circle

    path = leaves.select("conv_id", F.col("node_id").alias("path_id"), "node_id", F.lit(0).cast("bigint").alias("back"))
    path = path.join(
        endless.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n")),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("path_id") == F.col("n")),
        "left_anti",
    )
    for k in reversed(range(len(jumps))):
        up = jumps[k].select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "up")
        found = path.join(up, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("n")), "left")
        here = F.struct("node_id", "back")
        there = F.struct(F.col("up").alias("node_id"), (F.col("back") + 2**k).alias("back"))
        step = F.explode(F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, there)))
        path = found.select("conv_id", "path_id", step.alias("s")).select("conv_id", "path_id", "s.node_id", "s.back")
    path = materialize(path)

    scores = nodes.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "score")
    scored = path.join(scores, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("n")))
    sums = scored.groupBy("conv_id", "path_id").agg(F.sum("score").alias("total"), F.max("back").alias("deepest"))
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("total").desc(), "path_id"))
    chosen = sums.withColumn("branch", rank)
    if branches is not None:
        chosen = chosen.filter(F.col("branch") <= branches)
    chosen = chosen.select(F.col("conv_id").alias("c"), F.col("path_id").alias("p"), "branch", "deepest")
    done = path.join(chosen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("path_id") == F.col("p")))
    return done.select("conv_id", "path_id", "branch", (F.col("deepest") - F.col("back")).alias("depth"), "node_id")


def format_paths(messages: DataFrame, paths: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, path_id, branch, formatted, mask``: one conversation per path.

    ``mask`` is the loss mask in runs, one per turn: ``chars`` code points in
    all, of which ``take`` behind the first ``skip`` are trained on (the text of
    the trained role).  NULL role and text count as empty.
    """
    texts = messages.filter(F.col("node_id").isNotNull()).groupBy("conv_id", "node_id").agg(
        F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)).alias("score"), "role", "text")).alias("m")
    )
    texts = texts.select(F.col("conv_id").alias("c"), F.col("node_id").alias("n"), "m.role", "m.text")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = paths.join(texts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node_id") == F.col("n"))).select(
        "conv_id",
        "path_id",
        "branch",
        "depth",
        F.concat(F.lit(TURN_OPEN), escape_role(role), F.lit(ROLE_END)).alias("head"),
        escape(text).alias("body"),
        (role == trained_role).alias("trained"),
    )
    rows = rows.withColumn("skip", F.length("head")).withColumn("take", F.length("body"))
    run = F.struct(
        (F.col("skip") + F.col("take") + len(TURN_CLOSE)).cast("bigint").alias("chars"),
        F.col("skip").cast("bigint").alias("skip"),
        F.when(F.col("trained"), F.col("take")).otherwise(0).cast("bigint").alias("take"),
    )
    turn = F.struct("depth", F.concat("head", "body", F.lit(TURN_CLOSE)).alias("turn"), run.alias("run"))
    whole = rows.groupBy("conv_id", "path_id", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id", "path_id", "branch", F.array_join(F.col("turns.turn"), "").alias("formatted"), F.col("turns.run").alias("mask")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns of a formatted text and what is under its mask: adds ``turns array<struct<role,text,loss>>``."""
    pieces = F.split("formatted", TURN_CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece, run):
        at = F.instr(piece, ROLE_END)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(TURN_OPEN) + 1), at - len(TURN_OPEN) - 1)).alias("role"),
            unescape(F.substring(piece, at + len(ROLE_END), F.length(piece))).alias("text"),
            unescape(F.substring(piece, (run["skip"] + 1).cast("int"), run["take"].cast("int"))).alias("loss"),
        )

    return formatted.withColumn("turns", F.zip_with(pieces, F.col("mask"), turn))
