"""Chat formatting from reply trees: paths by iterated self-joins, ranked by score, one text each.

Jumps are doubled from round to round (a reply's parent, its parent's parent, ...), so a thread of n
turns takes about log2(n) joins. Nothing is collected by conversation: a path stays one row a turn.
"""

import re
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from pergamon.llm.graph import stored

#: The template: a turn's beginning, the end of its role, its end.
TURN, END = "<|turn|>", "<|end|>"

#: Strings that mean something to this or another template; inside texts they are broken up.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>")

#: Role whose text is trained on.
TRAINED = "assistant"

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_SEGMENT = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*)" + re.escape(END) + r"\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text):
    """The text without control strings; `unescape` gives it back."""
    text = text.replace("\\", "\\\\")
    while True:  # strings may overlap, as in <<|
        broken = _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)
        if broken == text:
            return text
        text = broken


def unescape(text):
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def segment(role, text):
    """(formatted turn, where the text under the loss mask begins and ends, or None)."""
    head = TURN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    out = head + body + END + "\n"
    return (out, len(head), len(head) + len(body)) if role == TRAINED else (out, None, None)


def read_segment(out):
    """(role, text) of a formatted turn."""
    m = _SEGMENT.fullmatch(out)
    return unescape(m[1]), unescape(m[2])


def threads(messages, conv_id="conv_id", turn="turn", role="role", text="text"):
    """Messages in order of turn as a reply tree: each answers the one before it in its conversation.

    Columns node_id, parent_id, conv_id, role, text, score. One range sort numbers all rows, so a
    conversation of any size is spread over tasks. Equal turns go by role, then text; null conv_id is one
    conversation, a null turn comes first, null role and text are empty.
    """
    rows = messages.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    ranged = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("part", F.spark_partition_id())
                    .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "turns")
    before = ranged.groupBy("part").count()
    before = before.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    numbered = ranged.join(before, "part").withColumn("node_id", F.col("at") + F.col("before"))
    first = numbered.groupBy("conv_id").agg(F.min("node_id").alias("first")).withColumnRenamed("conv_id", "_c")
    numbered = numbered.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    parent = F.when(F.col("node_id") > F.col("first"), F.col("node_id") - 1)
    return numbered.select("node_id", parent.alias("parent_id"), "conv_id", "role", "text", F.lit(0.0).alias("score"))


def best_paths(nodes, branches=1):
    """(leaf, node_id, depth, rank): the root-to-leaf paths with the best mean score, `branches` a tree.

    `nodes` has node_id (unique), parent_id and score. A node whose parent isn't there is a root; ties go
    to the longer path, then the smaller leaf. Parents that go round in a circle raise ValueError.
    """
    links = nodes.select("node_id", "parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = links.select(F.col("node_id").alias("parent_id"))
    inner = links.join(known, "parent_id", "left_semi").select(
        "node_id", F.col("parent_id").alias("above"), F.lit(1).cast("long").alias("depth"), "score",
        F.lit(None).cast("long").alias("root"))
    roots = links.join(known, "parent_id", "left_anti").select(
        "node_id", F.lit(None).cast("long").alias("above"), F.lit(0).cast("long").alias("depth"), "score",
        F.col("node_id").alias("root"))
    rest, done = stored(inner, "jumps"), stored(roots, "jumps")
    every = rest.unionByName(done)
    leaves = every.select("node_id").join(
        rest.select(F.col("above").alias("node_id")), "node_id", "left_anti")
    jumps, most = [], None
    while not rest.isEmpty():  # only nodes that aren't at their root yet are joined again
        most = most or nodes.count()
        if 2 ** len(jumps) > most:
            raise ValueError("parent_id goes round in a circle")
        jumps.append(rest.select("node_id", "above"))
        next_on = rest.unionByName(done).select(
            F.col("node_id").alias("above"), F.col("above").alias("above2"), F.col("depth").alias("depth2"),
            F.col("score").alias("score2"), F.col("root").alias("root2"))
        went = stored(rest.join(next_on, "above").select(
            "node_id", F.col("above2").alias("above"), (F.col("depth") + F.col("depth2")).alias("depth"),
            (F.col("score") + F.col("score2")).alias("score"), F.col("root2").alias("root")), "jumps")
        rest, done = went.filter("above is not null"), done.unionByName(went.filter("above is null"))
    state = done
    ends = state.join(leaves, "node_id")
    mean = F.col("score") / (F.col("depth") + 1)
    rank = F.row_number().over(Window.partitionBy("root").orderBy(mean.desc(), F.col("depth").desc(), "node_id"))
    ends = ends.withColumn("rank", rank).filter(F.col("rank") <= branches)
    marked = stored(ends.select(F.col("node_id").alias("leaf"), "node_id", "rank"), "paths")
    for jump in jumps:
        up = marked.join(jump, "node_id").select("leaf", F.col("above").alias("node_id"), "rank")
        marked = stored(marked.union(up), "paths")
    return marked.join(state.select("node_id", "depth"), "node_id").select("leaf", "node_id", "depth", "rank")


def format_trees(nodes, branches=1):
    """Formatted conversations, one row a turn: leaf, conv_id, rank, depth, formatted, loss_start, loss_end.

    A path's text is its rows' `formatted` in order of depth; loss_start and loss_end bound what is
    trained on, in code points of the row, and are null elsewhere.
    """
    def work(batches):
        for batch in batches:
            made = [segment(r, t) for r, t in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())]
            columns = list(zip(*made)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int64())],
                ["leaf", "conv_id", "rank", "depth", "formatted", "loss_start", "loss_end"])

    rows = best_paths(nodes, branches).join(nodes, "node_id").select(
        "leaf", "conv_id", F.col("rank").cast("long"), "depth", "role", "text")
    return rows.mapInArrow(work, "leaf long, conv_id long, rank long, depth long, formatted string, "
                                 "loss_start long, loss_end long")


def _digests(batches):
    """One row a path from rows sorted by path and depth; a path's rows are read one by one."""
    now, out = None, []

    def end():
        out.append((now["conv_id"], now["n"], now["turns"].hexdigest(), now["loss"], now["text"].hexdigest(), now["all"]))

    def batch_of(rows):
        columns = list(zip(*rows)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for leaf, conv_id, formatted, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or now["leaf"] != leaf:
                if now is not None:
                    end()
                now = {"leaf": leaf, "conv_id": conv_id, "n": 0, "loss": 0, "all": 0, "turns": sha256(), "text": sha256()}
            role, text = read_segment(formatted)
            now["n"] += 1
            now["all"] += len(formatted)
            now["turns"].update(f"{role}\n{text}\n".encode())
            if start is not None:
                loss = unescape(formatted[start:stop])
                now["loss"] += len(loss)
                now["text"].update(loss.encode())
        if len(out) >= 1000:
            yield batch_of(out)
            out = []
    if now is not None:
        end()
    yield batch_of(out)


def read_back(formatted):
    """Per path: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    All of it is read from the formatted text. Hashes need a path's turns in order: they are sorted within
    partitions and streamed, so memory doesn't grow with a conversation.
    """
    rows = formatted.repartition("leaf").sortWithinPartitions("leaf", "depth")
    return rows.select("leaf", "conv_id", "formatted", "loss_start", "loss_end").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")
