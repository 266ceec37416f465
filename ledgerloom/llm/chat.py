"""Chat formatting: reply trees to root-to-leaf paths to one training text per path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table

# The marks of a turn.  Texts never contain "<|" once escaped.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """Text in which ``<|`` cannot occur; ``unescape`` gives the text back."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape(text: Column) -> Column:
    lines = F.replace(text, F.lit("&#10;"), F.lit("\n"))
    return F.replace(F.replace(lines, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _steps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of the 1st, 2nd, 4th, ... ancestors, and depth and score of the way from each node to its root.

    Every self-join doubles the reach, so the joins grow with the logarithm of
    the deepest path.  A parent that is missing makes its child a root; nodes
    whose parents form a circle have no root and get no depth.
    """
    def up(rows: DataFrame, others: DataFrame, *more) -> DataFrame:
        """Left join of ``rows`` with the node they point at."""
        named = others.select(F.col("tree").alias("t"), F.col("node").alias("n"), *more)
        return rows.join(named, F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n")), "left")

    start = nodes.select("tree", "node", F.col("parent").alias("up"), F.col("score").alias("total"),
                         F.lit(1).cast("long").alias("depth"))
    state = cut_lineage(up(start, nodes).select("tree", "node", F.col("n").alias("up"), "total", "depth"))
    longest = state.count()
    done, climbing = [state.where("up IS NULL")], state.where("up IS NOT NULL")
    tables: list[DataFrame] = []
    # Only nodes whose root is not yet reached go on.
    while not climbing.isEmpty() and 2 ** len(tables) <= longest:
        tables.append(climbing.select("tree", "node", "up"))
        reached = climbing
        for part in done:
            reached = reached.unionByName(part)
        moved = cut_lineage(up(climbing, reached, F.col("up").alias("further"), F.col("total").alias("more"),
                               F.col("depth").alias("deeper")).select(
            "tree", "node", F.col("further").alias("up"),
            (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
            (F.col("depth") + F.coalesce("deeper", F.lit(0))).alias("depth")))
        done.append(moved.where("up IS NULL"))
        climbing = moved.where("up IS NOT NULL")
    ways = done[0]
    for part in done[1:]:
        ways = ways.unionByName(part)
    return tables, ways.select("tree", "node", "total", "depth")


def reply_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, rank, total, place, node) for the ``best`` root-to-leaf paths of every tree.

    ``messages`` has tree, node, parent and score.  A path's score is the mean
    of its nodes' (null counts as 0); ties go to the longer path, then to the
    smaller leaf.  ``place`` counts from 1 at the root.  Chosen paths are
    unfolded from the leaf by the ancestor tables, largest step first: one row
    per node of a chosen path and never a pair of nodes more.  A null tree is a
    tree of its own; (tree, node) has to be unique; an empty table gives none.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    tables, ways = _steps(nodes)
    parents = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).where("p IS NOT NULL")
    leaves = ways.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
    paths = (leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
             .select("tree", F.col("node").alias("leaf"), "rank", "total", F.col("depth").alias("place"), "node"))
    for power in range(len(tables) - 1, -1, -1):
        step = tables[power].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        paths = cut_lineage(paths.unionByName(
            paths.join(step, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select(
                "tree", "leaf", "rank", "total", (F.col("place") - 2 ** power).alias("place"), F.col("up").alias("node"))))
    return paths


def format_paths(paths: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, loss_spans) from rows of tree, leaf, place, role and text.

    A turn is ``<|im_start|>role``, a line end, the text and ``<|im_end|>`` with
    a line end; role and text are escaped, null counts as empty.
    ``loss_spans`` are the (start, end) code points of the assistant texts, end
    exclusive.  A conversation is one text by its nature; its offsets come from
    a running sum, so nothing else is gathered.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    turns = paths.select("tree", "leaf", "place", "role", head.alias("head"),
                         escape(F.coalesce("text", F.lit(""))).alias("body"))
    turns = turns.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    rows = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("place", "piece", span.alias("span")))).alias("turns"))
    return rows.select(
        "tree", "leaf", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, "\n", 1), len(OPEN) + 1, 2 ** 31 - 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.lit(2 ** 31 - 1))).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of a table of conv_id, turn, role and text.

    Each row replies to the row before it by turn (null first), then role and
    text, so a conversation is a tree of one path; repeated rows and turns are
    turns of their own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    messages = cut_lineage(rows.select(
        F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"), "role", "text"))
    links = messages.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                            F.lit(0.0).alias("score"))
    texts = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    paths = reply_paths(links).join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    return format_paths(paths).select(F.col("tree").alias("conv_id"), "formatted", "loss_spans")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    rows = rows.unionByName(spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text")))
    done = format_conversations(rows)
    done = done.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss", read_loss(F.col("formatted"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_ORACLE = """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), said AS (
  SELECT conv_id, turn, role AS own, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, own NULLS FIRST, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (own = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, own NULLS FIRST, text) FILTER (own = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;')) + 1
      + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + 11) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""

QUERIES = {"op5_chat_format": op5_chat_format}
ORACLES = {"op5_chat_format": _ORACLE}
