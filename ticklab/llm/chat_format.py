"""Chat formatting from an event log (DataFrame functions only).

Events: conv_id, seq, kind, target, role, text. Kinds:

- ``message``: opens the message named by its own seq (target = seq), with a first text;
- ``delta``: appends its text to message ``target``;
- ``edit``: replaces the text of ``target`` as of then (later deltas append);
- ``regenerate``: like an edit, and discards the messages opened between ``target`` and itself.

The log is partitioned by conversation and sorted by seq; each message folds to the text of its last
message/edit/regenerate event followed by the deltas after it. The template writes a turn as

    ### <role>: <text></turn>\\n

In texts and roles ``\\`` becomes ``\\\\``, ``##`` becomes ``#\\#`` and ``</turn>`` becomes
``<\\/turn>`` (roles: also ``:`` to ``:\\``), so neither ``###`` nor ``</turn>`` occurs inside, and
removing single backslashes restores the original.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"


def escape(col):
    col = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(col, F.lit("##"), F.lit("#\\#")), F.lit("</turn>"), F.lit("<\\/turn>"))


def escape_role(col):
    return F.replace(escape(col), F.lit(":"), F.lit(":\\"))


def unescape(col):
    """Pairs of backslashes stand for one, single ones were inserted."""
    parts = F.split(col, r"\\\\")  # regex: two backslashes
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\"), F.lit(""))), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, target, role, text): the final messages of every conversation.

    Defined cases: null text is empty, null role is taken from the message's first event that has one,
    else empty; a message known only by deltas starts empty; events without target are ignored, and
    events that share a seq apply in the order of kind and text.
    """
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    log = (events.where("target is not null").groupBy("conv_id", "target")
           .agg(F.array_sort(F.collect_list(event)).alias("log")))
    resets = F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i + 1))
    begin = F.coalesce(F.array_max(resets), F.lit(1))
    text = F.array_join(F.transform(F.slice("log", begin, F.size("log")), lambda e: e["text"]), "")
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    regens = F.transform(F.filter("log", lambda e: e["kind"] == "regenerate"), lambda e: e["seq"])
    folded = log.select("conv_id", "target", F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"), text.alias("text"),
                        F.array_max(regens).alias("until"))
    # the last regeneration of any earlier message decides
    cut = F.max("until").over(Window.partitionBy("conv_id").orderBy("target").rowsBetween(Window.unboundedPreceding, -1))
    return folded.withColumn("cut", cut).where("cut is null or cut <= target").select("conv_id", "target", "role", "text")


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_spans): spans are (start, length) in code points, 0-based, and cover the
    escaped texts of ``loss_role``."""
    body = escape(F.col("text"))
    head = F.concat(F.lit("### "), escape_role(F.col("role")), F.lit(": "))
    turn = messages.select("conv_id", "target", "role", head.alias("head"), body.alias("body"))
    before = Window.partitionBy("conv_id").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    size = (F.length("head") + F.length("body") + len(END)).cast("long")
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")
    span = F.when(F.col("role") == loss_role, F.struct(start.alias("start"), F.length("body").cast("long").alias("length")))
    rows = turn.select("conv_id", F.struct("target", F.concat("head", "body", F.lit(END)).alias("turn"), span.alias("span")).alias("t"))
    return (rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
            .select("conv_id", F.array_join(F.transform("ts", lambda t: t["turn"]), "").alias("formatted"),
                    F.filter(F.transform("ts", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans")))


def turn_parts(turn):
    """(role, text, offset of the text) of one formatted turn, without its end."""
    cut = F.locate(": ", turn)
    return unescape(F.substring(turn, F.lit(5), cut - 5)), unescape(F.substring(turn, cut + 2, F.length(turn))), cut + 1


def parse(formatted):
    """Array of (role, text) read back from a formatted conversation."""
    def turn(t):
        role, text, _ = turn_parts(t)
        return F.struct(role.alias("role"), text.alias("text"))
    return F.transform(F.filter(F.split(formatted, END), lambda t: t != ""), turn)


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted_chars, turns) of ``render``'s rows: turns is an array of (i, role, text, loss) read from the
    formatted text, loss the unescaped text under the mask (null where nothing of the turn is masked).

    A conversation is split into its turns once; where they begin follows from their lengths, and a span meets its
    turn by an equi-join on the place where the turn's text begins, so the work is linear in the turns."""
    parts = rendered.select("conv_id", F.posexplode(F.split("formatted", END)).alias("i", "turn")).where("turn <> ''")
    before = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn") + len(END)).over(before), F.lit(0))
    role, text, offset = turn_parts(F.col("turn"))
    parts = parts.withColumn("at", (start + offset).cast("long")).alias("p")
    spans = rendered.select("conv_id", F.explode("loss_spans").alias("s")).select("conv_id", F.col("s.start").alias("at"), "s.length").alias("s")
    met = parts.join(spans, F.col("p.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("p.at") == F.col("s.at")), "left")
    loss = F.when(F.col("length").isNotNull(), unescape(F.substring("turn", (offset + 1).cast("int"), F.col("length").cast("int"))))
    cell = F.struct("i", role.alias("role"), text.alias("text"), loss.alias("loss"), (F.length("turn") + len(END)).cast("long").alias("chars"))
    out = met.select("p.conv_id", cell.alias("cell")).groupBy("conv_id").agg(F.array_sort(F.collect_list("cell")).alias("turns"), F.sum("cell.chars").alias("formatted_chars"))
    return out.select("conv_id", "formatted_chars", "turns")


def events_of_rows(rows: DataFrame, chunk: int = 512) -> DataFrame:
    """Event log of a (conv_id, turn, role, text) table: each row opens a message and streams its text
    in deltas of ``chunk`` code points. Rows are ordered by turn, then role and text; repeated rows are
    messages of their own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    seq = F.row_number().over(order).cast("long") * F.lit(1 << 31)
    rows = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    pieces = F.sequence(F.lit(0), F.ceil(F.length("text") / F.lit(chunk)).cast("int"))
    out = rows.withColumn("target", seq).withColumn("i", F.explode(pieces))
    first = F.col("i") == 0
    return out.select("conv_id", (F.col("target") + F.col("i")).alias("seq"), F.when(first, "message").otherwise("delta").alias("kind"), "target",
                      F.when(first, F.col("role")).alias("role"),
                      F.when(first, "").otherwise(F.substring("text", (F.col("i") - 1) * chunk + 1, F.lit(chunk))).alias("text"))
