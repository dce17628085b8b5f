"""Chat formatting by a grammar round trip (operator 4), expressions only.

Grammar of a rendered conversation::

    conversation := turn*
    turn         := "### " role ": " text "</turn>\\n"

No role or text holds a raw ``###`` or ``</turn>``. A turn is rendered as it
is first; the parser reads it back, and where the recovered (role, text) is
not the source, the turn is escaped one step further and tried again:

* step 0: the text as it is;
* step 1: control strings replaced by escapes (``\\h``, ``\\e``);
* step 2: backslashes doubled first, so escapes in the source survive, and
  the separator in the role replaced (``\\c``).

The parser is the same whatever the step: cut at the end marker, take off the
header, reject control strings, undo escapes. Step 2 always reads back.

Defined cases: null text or role is empty; a null turn sorts first, ties sort
by role, then text; repeated rows are turns of their own; rows with a null
conversation id form one conversation; an empty table gives no rows. A
conversation is rendered whole, in one row: that is the operator's output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
HEADER, SEPARATOR, END = "### ", ": ", "</turn>\n"
MARK_HEAD, MARK_END, MARK_SEP = "###", "</turn>", ":"
ESC_HEAD, ESC_END, ESC_SEP = "\\h", "\\e", "\\c"
MASKED_ROLE = "assistant"


def _hide(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit(MARK_HEAD), F.lit(ESC_HEAD)),
                     F.lit(MARK_END), F.lit(ESC_END))


def _double(x: Column) -> Column:
    return F.replace(x, F.lit("\\"), F.lit("\\\\"))


def _undo(x: Column) -> Column:
    """Doubled backslashes are found from the left; between them the escapes
    stand alone."""
    part = lambda p: F.replace(F.replace(F.replace(
        p, F.lit(ESC_HEAD), F.lit(MARK_HEAD)), F.lit(ESC_END), F.lit(MARK_END)),
        F.lit(ESC_SEP), F.lit(MARK_SEP))
    return F.when(~F.contains(x, F.lit("\\")), x).otherwise(
        F.array_join(F.transform(F.split(x, r"\\\\"), part), "\\"))


def render_turn(role: Column, text: Column, step: int) -> Column:
    if step == 1:
        text = _hide(text)
    elif step == 2:
        text = _hide(_double(text))
        role = F.replace(_hide(_double(role)), F.lit(MARK_SEP), F.lit(ESC_SEP))
    return F.concat(F.lit(HEADER), role, F.lit(SEPARATOR), text, F.lit(END))


def parse(rendered: Column) -> Column:
    """array<struct<role, text, clean>> of a rendered conversation; ``clean``
    is false where the piece breaks the grammar."""
    pieces = F.split(rendered, END)
    turns = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        body = F.substring(p, len(HEADER) + 1, 2 ** 31 - 1)
        cut = F.locate(SEPARATOR, body)
        role = F.substring(body, F.lit(1), cut - 1)
        text = F.substring(body, cut + len(SEPARATOR), F.lit(2 ** 31 - 1))
        clean = (F.startswith(p, F.lit(HEADER)) & (cut > 0)
                 & ~F.contains(body, F.lit(MARK_HEAD)) & ~F.contains(body, F.lit(MARK_END)))
        return F.struct(_undo(role).alias("role"), _undo(text).alias("text"),
                        clean.alias("clean"))

    return F.transform(turns, turn)


def reads_back(rendered: Column, role: Column, text: Column) -> Column:
    return parse(rendered) == F.array(F.struct(role.alias("role"), text.alias("text"),
                                               F.lit(True).alias("clean")))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, same): the rendered conversation, the turns
    read back from it, and whether they equal the source."""
    r = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")
    steps = [render_turn(role, text, s) for s in (0, 1, 2)]
    rendered = F.when(reads_back(steps[0], role, text), steps[0]) \
        .when(reads_back(steps[1], role, text), steps[1]).otherwise(steps[2])
    turns = r.select("conv_id", F.struct("turn", "role", "text",
                                         rendered.alias("rendered")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    whole = whole.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("formatted"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"),
                                            F.lit(True).alias("clean"))).alias("source"))
    back = whole.withColumn("turns", parse(F.col("formatted")))
    return back.select("conv_id", "formatted", "turns",
                       (F.col("turns") == F.col("source")).alias("same"))


def loss_text(turns: Column, masked_role: str = MASKED_ROLE) -> Column:
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == masked_role),
                                    lambda t: t["text"]), "")


def op4_chat_format(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").cast("long").alias("turn"), "role", "text")
    probe = r"\### Assistant: </turn> ok"
    spark = rows.sparkSession
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(probe).alias("text"))
    out = format_conversations(rows.unionByName(extra))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return _digest(out, flat)


def _digest(out: DataFrame, flat: Column) -> DataFrame:
    out = out.withColumn("loss", loss_text(F.col("turns")))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "same")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _oracle() -> str:
    """DuckDB: the same rows from the source alone; what the escapes add is
    counted, not rendered."""
    hit = lambda x, subs: " OR ".join(f"contains({x}, {_sql_text(s)})" for s in subs)
    raw = (MARK_HEAD, MARK_END)
    esc = (ESC_HEAD, ESC_END, ESC_SEP, "\\\\")
    hide = lambda x: (f"replace(replace({x}, '###', '\\h'), '</turn>', '\\e')")
    dbl = lambda x: f"replace({x}, '\\', '\\\\')"
    return f"""
WITH src AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
steps AS (
  SELECT *, CASE
    WHEN {hit("role", raw + esc + (": ",))} THEN 2
    WHEN {hit("text", esc + ("\\###", "\\</turn>"))} THEN 2
    WHEN {hit("text", raw)} THEN 1 ELSE 0 END AS step FROM src),
lens AS (
  SELECT *, length('### : </turn>') + 1 + CASE step
    WHEN 0 THEN length(role) + length(text)
    WHEN 1 THEN length(role) + length({hide("text")})
    ELSE length(replace({hide(dbl("role"))}, ':', '\\c')) + length({hide(dbl("text"))}) END AS n
  FROM steps)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars, true AS same
FROM lens GROUP BY conv_id"""


ORACLE = _oracle()
