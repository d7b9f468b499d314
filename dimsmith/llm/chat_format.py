"""Chat formatting: reply trees to training conversations.

Messages point at the message they answer.  `reply_paths` finds every leaf and
walks to its root by iterative self-joins with doubled steps (after round k a
message knows its ancestor 2^k up, so a thread of depth d takes log2 d rounds).
Branches are ranked by the mean score of their messages, the best ``n_best`` of
each tree are kept, and `format_paths` writes each as one conversation.

Template: ``### role: text</turn>`` and a line feed per turn.  Texts and roles
are escaped reversibly with plain replacements: ``\\`` to ``\\b``, ``###`` to
``\\h\\h\\h``, ``</turn>`` to ``\\l/turn>`` (in roles also ``:`` to ``\\c``), so
no control string occurs inside a text and `parse_turns` can split on them.
``loss_spans`` holds the (start, length) code-point spans of the texts of the
trained role.

DataFrame functions only.  Doubling shuffles narrow id columns; the texts move
once, when the turns of a chosen path meet in one row.  The best branches are
found per (tree, salt) first, so a tree with a third of all rows is spread over
many tasks.  One conversation is one string and so bounded by a row's size.

Defined results: null texts and roles are empty; a message whose parent is null
or does not exist is a root; messages on a cycle have no root and no leaf and
are reported by no path; null scores count as 0; equal scores are ranked by
leaf id; repeated ids in one tree are not allowed (`chain_messages` numbers
rows itself, so there repeated rows and equal turns are turns of their own, by
turn, role, text, nulls first); a null tree id is a tree like any other; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table

HEAD, SEP, END = "### ", ": ", "</turn>"


def escape(col: Column) -> Column:
    col = F.replace(F.coalesce(col, F.lit("")), F.lit("\\"), F.lit("\\b"))
    col = F.replace(col, F.lit("###"), F.lit("\\h\\h\\h"))
    return F.replace(col, F.lit(END), F.lit("\\l/turn>"))


def unescape(col: Column) -> Column:
    col = F.replace(F.replace(col, F.lit("\\l"), F.lit("<")), F.lit("\\h"), F.lit("#"))
    return F.replace(F.replace(col, F.lit("\\c"), F.lit(":")), F.lit("\\b"), F.lit("\\"))


def escape_role(col: Column) -> Column:
    return F.replace(escape(col), F.lit(":"), F.lit("\\c"))


def chain_messages(rows: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows by turn as a reply tree without branches: each answers the one before."""
    w = Window.partitionBy("tree_id").orderBy("turn", "role", "text")
    return (rows.select(F.col(tree).alias("tree_id"), F.col(turn).alias("turn"), "role", "text")
            .withColumn("msg_id", F.row_number().over(w).cast("long"))
            .select("tree_id", "msg_id",
                    F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
                    "role", "text", F.lit(0.0).alias("score")))


def reply_paths(messages: DataFrame, n_best: int = 1, salts: int = 64) -> DataFrame:
    """messages (tree_id, msg_id, parent_id, score) -> tree_id, leaf_id, path_rank, msg_id, depth.

    depth counts from 0 at the root.
    """
    spark = messages.sparkSession
    m = messages.select(F.coalesce(F.col("tree_id").cast("string"), F.lit("")).alias("_t"),
                        F.col("tree_id").isNull().alias("_null"), "tree_id", "msg_id", "parent_id",
                        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    key = ["_t", "_null"]
    ids = m.select(*key, F.col("msg_id").alias("parent_id")).distinct()
    m = m.join(ids.withColumn("_known", F.lit(True)), [*key, "parent_id"], "left")
    m = m.withColumn("parent_id", F.when(F.col("_known"), F.col("parent_id"))).drop("_known")
    m = materialise(m, "messages")

    leaves = m.select(*key, "tree_id", "msg_id").join(
        m.where("parent_id IS NOT NULL").select(*key, F.col("parent_id").alias("msg_id")).distinct(),
        [*key, "msg_id"], "left_anti")
    members = leaves.select(*key, "tree_id", F.col("msg_id").alias("leaf_id"), "msg_id",
                            F.lit(0).cast("long").alias("hop"))
    # up: message -> its ancestor 2^k above, sum of the scores on the way (itself included);
    # who has reached the root is done and takes no part in later rounds
    up = m.select(*key, "msg_id", F.col("parent_id").alias("anc"), F.col("score").alias("total"),
                  F.lit(1).cast("long").alias("steps"))
    done, up = up.where("anc IS NULL"), up.where("anc IS NOT NULL")
    step, left, jumps = 1, None, []
    while (above := up.count()) not in (0, left):       # unchanged: only messages on cycles are left
        jumps.append((step, up))
        there = done.unionByName(up).select(*key, F.col("msg_id").alias("anc"), F.col("anc").alias("_anc2"),
                                            F.col("total").alias("_total2"), F.col("steps").alias("_steps2"))
        far = materialise(up.join(there, [*key, "anc"]).select(
            *key, "msg_id", F.col("_anc2").alias("anc"), (F.col("total") + F.col("_total2")).alias("total"),
            (F.col("steps") + F.col("_steps2")).alias("steps")), "up")
        done, up = done.unionByName(far.where("anc IS NULL")), far.where("anc IS NOT NULL")
        step, left = step * 2, above

    scored = members.join(done.select(*key, "msg_id", "total", "steps"), [*key, "msg_id"])
    scored = scored.withColumn("_mean", F.col("total") / F.col("steps"))
    scored = scored.withColumn("_salt", F.pmod(F.xxhash64("leaf_id"), F.lit(salts)))
    order = [F.col("_mean").desc(), F.col("leaf_id")]
    first = F.row_number().over(Window.partitionBy(*key, "_salt").orderBy(*order))
    scored = scored.withColumn("_r", first).where(F.col("_r") <= n_best)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    best = scored.withColumn("path_rank", rank).where(F.col("path_rank") <= n_best)

    # enumerate the chosen paths: who is at hop h finds who is at hop h + 2^k
    path = materialise(best.select(*key, "tree_id", "leaf_id", "path_rank", "steps", "msg_id", "hop"), "leaves")
    for k, up in reversed(jumps):
        nxt = (path.join(up.select(*key, "msg_id", "anc"), [*key, "msg_id"])
               .select(*key, "tree_id", "leaf_id", "path_rank", "steps", F.col("anc").alias("msg_id"),
                       (F.col("hop") + k).alias("hop")))
        path = materialise(path.unionByName(nxt), "path")
    return path.select(*key, "tree_id", "leaf_id", "path_rank", "msg_id",
                       (F.col("steps") - 1 - F.col("hop")).alias("depth"))


def format_paths(messages: DataFrame, paths: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per chosen path: tree_id, leaf_id, path_rank, n_turns, formatted, loss_spans."""
    m = messages.select(F.coalesce(F.col("tree_id").cast("string"), F.lit("")).alias("_t"),
                        F.col("tree_id").isNull().alias("_null"), "msg_id",
                        F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(SEP)).alias("_head"),
                        escape(F.col("text")).alias("_body"),
                        F.coalesce(F.col("role") == trained, F.lit(False)).alias("_loss"))
    x = paths.join(m, ["_t", "_null", "msg_id"])
    key = ["_t", "_null", "tree_id", "leaf_id", "path_rank"]
    size = F.length("_head") + F.length("_body") + len(END) + 1
    before = Window.partitionBy(*key).orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("_head"))
    x = x.withColumn("_span", F.when(F.col("_loss"), F.struct(
        F.col("_at").cast("long").alias("start"), F.length("_body").cast("long").alias("length"))))
    turns = F.array_sort(F.collect_list(F.struct(
        "depth", F.concat("_head", "_body", F.lit(END + "\n")).alias("piece"), F.col("_span").alias("span"))))
    return (x.groupBy(*key).agg(turns.alias("_turns"))
            .select("tree_id", "leaf_id", "path_rank", F.size("_turns").cast("long").alias("n_turns"),
                    F.array_join(F.col("_turns.piece"), "").alias("formatted"),
                    F.filter(F.col("_turns.span"), lambda s: s.isNotNull()).alias("loss_spans")))


def format_reply_trees(messages: DataFrame, n_best: int = 1, trained: str = "assistant") -> DataFrame:
    """messages (tree_id, msg_id, parent_id, role, text, score) -> the best conversations."""
    messages = materialise(messages.select("tree_id", "msg_id", "parent_id", "role", "text", "score"), "tree")
    return format_paths(messages, reply_paths(messages, n_best), trained)


def parse_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(formatted, F.lit(END + "\n"))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)      # what follows the last mark is empty

    def turn(p: Column) -> Column:
        at = F.locate(SEP, p)
        return F.struct(unescape(F.substr(p, F.lit(len(HEAD) + 1), at - len(HEAD) - 1)).alias("role"),
                        unescape(F.substr(p, at + len(SEP))).alias("text"))
    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok', 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok', 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) AS k,
         length(replace(replace(replace(text, '\', '\b'), '###', '\h\h\h'), '</turn>', '\l/turn>'))
         + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h\h\h'), '</turn>', '\l/turn>'), ':', '\c'))
         + 4 + 2 + 7 + 1 AS size
  FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op1_chat_format", SQL)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 as chains; digests read back from the output."""
    text = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    done = format_reply_trees(chain_messages(rows.unionByName(planted)))
    turns = F.transform(parse_turns(F.col("formatted")),
                        lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    done = done.withColumn("_loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    return done.select(
        F.col("tree_id").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
