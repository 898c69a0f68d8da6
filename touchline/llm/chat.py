"""Chat formatting with a grammar round trip (DataFrame functions only).

Grammar of the rendered text:

    conversation := turn*
    turn         := "<s>" role "[INST]" body "[/INST]</s>"

Roles and bodies are the source's text, with one escape: in a control string,
also one that was escaped before, a backslash goes in behind its first
character ("</s>" -> "<\\/s>" -> "<\\\\/s>"); unescaping takes one away. The
parser cuts at "</s>", then at the two INST marks, rejects anything else, and
always unescapes.

Formatting renders every turn as it is, parses it back and compares it with the
source; only turns that come back different are escaped. Then the whole
conversation is parsed and compared; if it still differs, all its turns are
escaped; a conversation that differs even then stops the job. The loss mask is
kept as code-point spans of the assistant bodies in the rendered text.

Defined results: null role or text is empty; turns are ordered by (turn, role,
text), nulls first, so ties and repeated rows have a fixed place and all stay;
rows of null conv_id form one conversation; an empty table gives no rows. Only
the four named columns are read. A conversation is one output value, so its
turns meet in one row; everything before is done by turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit("<s>"), role, F.lit("[INST]"), body, F.lit("[/INST]</s>"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a rendered conversation; null if the text
    isn't of the grammar."""
    pieces = F.split(formatted, "</s>", -1)
    turns = F.slice(pieces, 1, F.size(pieces) - 1)
    cut = F.transform(turns, lambda p: F.split(p, r"\[/?INST\]", -1))
    good = F.forall(cut, lambda c: (F.size(c) == 3) & (F.get(c, F.lit(2)) == "") & F.get(c, F.lit(0)).startswith("<s>") & ~F.substring(F.concat(F.get(c, F.lit(0)), F.get(c, F.lit(1))), 4, 1 << 30).contains("<s>"))
    # the kinds and order of marks, which cutting alone doesn't see
    good = good & F.forall(turns, lambda p: (F.instr(p, "[INST]") > 0) & p.endswith("[/INST]"))
    good = good & (F.element_at(pieces, -1) == "")
    got = F.transform(cut, lambda c: F.struct(unescape(F.substring(F.get(c, F.lit(0)), 4, 1 << 30)).alias("role"), unescape(F.get(c, F.lit(1))).alias("text")))
    return F.when(good, got)


def _same(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the columns, each evaluated once a row: the optimizer doesn't
    copy a generator's output into the expressions (and lambdas) that use it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn_role: str = "assistant") -> DataFrame:
    """(conv_id, n_turns, formatted, loss_spans array<struct<start, end>>)."""
    source = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    one = F.array(F.struct("role", "text"))
    raw = render_turn(F.col("role"), F.col("text"))
    turns = source.withColumn("clash", ~_same(parse(raw), one))
    turns = turns.select("conv_id", "turn", "role", "text", F.when(F.col("clash"), escape(F.col("role"))).otherwise(F.col("role")).alias("r"), F.when(F.col("clash"), escape(F.col("text"))).otherwise(F.col("text")).alias("b"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "r", "b"))).alias("t"))
    want = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    rendered = F.array_join(F.transform("t", lambda x: render_turn(x["r"], x["b"])), "")
    listed = _once(listed, want=want, rendered=rendered)
    listed = _once(listed, same=_same(parse(F.col("rendered")), F.col("want")))
    as_rendered = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["r"].alias("r"), x["b"].alias("b")))
    all_escaped = F.transform("t", lambda x: F.struct(x["role"].alias("role"), escape(x["role"]).alias("r"), escape(x["text"]).alias("b")))
    listed = _once(listed, parts=F.when(F.col("same"), as_rendered).otherwise(all_escaped)).select("conv_id", "want", "parts")
    listed = _once(listed, formatted=F.array_join(F.transform("parts", lambda x: render_turn(x["r"], x["b"])), ""))
    listed = _once(listed, same=F.when(_same(parse(F.col("formatted")), F.col("want")), F.lit(True)).otherwise(F.raise_error(F.lit("a conversation doesn't parse back")).cast("boolean")))
    listed = listed.where("same")
    # offsets by a running sum, linear in the turns
    at = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    spans = listed.select("conv_id", F.posexplode("parts").alias("i", "p")).select("conv_id", "i", F.length(render_turn(F.col("p.r"), F.col("p.b"))).alias("n"), F.length("p.r").alias("n_role"), F.length("p.b").alias("n_body"), (F.col("p.role") == learn_role).alias("learn"))
    spans = spans.withColumn("start", F.coalesce(F.sum("n").over(at), F.lit(0)) + len("<s>") + F.col("n_role") + len("[INST]"))
    spans = spans.where("learn").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("n_body")).alias("end")))).alias("loss_spans"))
    return (
        listed.alias("l")
        .join(spans.alias("s"), F.col("l.conv_id").eqNullSafe(F.col("s.conv_id")), "left")
        .select("l.conv_id", F.size("want").cast("long").alias("n_turns"), "formatted", F.coalesce("loss_spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("loss_spans"))
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests computed from the rendered text and the loss mask alone."""
    turns = parse(F.col("formatted"))
    learned = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    got = _once(formatted.select("conv_id", "formatted", "loss_spans"), turns=turns, learned=F.array_join(learned, ""))
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
