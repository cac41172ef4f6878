"""Chat formatting with typed content parts. Built-in functions only.

A turn's content is a list of parts (type, text, ref, amount). The visitor flattens them in order: text is escaped, an
image, audio clip or document becomes a numbered placeholder, and each attachment is recorded with its reference and the
number of tokens its placeholder expands to. The template frames turns with control strings; control strings inside texts
and roles are escaped with one more backslash, which ``unescape`` takes away again, so formatting can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, NEXT, END = "<|turn|>", "<|body|>", "<|part|>", "<|end|>"

#: What follows the first character of a control string; own template's and those of other chat templates.
_TAIL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"
#: Tokens per unit of amount and least tokens: images by pixels, audio by milliseconds, documents by pages.
EXPANSION = {"image": (1 / (28 * 28), 1), "audio": (1 / 40, 1), "document": (1024.0, 1)}

PART_TYPE = "array<struct<type:string,text:string,ref:string,amount:double>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2")


def text_part(text: Column) -> Column:
    """A content of one text part."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), none.alias("ref"), F.lit(None).cast("double").alias("amount")))


def attachments_of(parts: Column) -> Column:
    """The parts that are not text, in order, with expanded token counts; unknown types and null amounts count one token."""
    def tokens(p):
        out = F.lit(1).cast("long")
        for kind, (rate, least) in EXPANSION.items():
            out = F.when(p["type"] == kind, F.greatest(F.lit(least), F.ceil(F.coalesce(p["amount"], F.lit(0.0)) * rate)).cast("long")).otherwise(out)
        return out
    media = F.filter(F.coalesce(parts, F.array().cast(PART_TYPE)), lambda p: F.coalesce(p["type"], F.lit("text")) != "text")
    return F.transform(media, lambda p, i: F.struct(i.alias("index"), p["type"].alias("kind"), p["ref"].alias("ref"), tokens(p).alias("tokens")))


def flatten(parts: Column, before: Column) -> Column:
    """Parts as one string: escaped texts and placeholders numbered from ``before`` + 1, parted by a control string."""
    parts = F.coalesce(parts, F.array().cast(PART_TYPE))
    state = F.struct(F.array().cast("array<string>").alias("out"), before.cast("long").alias("n"))

    def visit(s, p):
        is_text = F.coalesce(p["type"], F.lit("text")) == "text"
        n = F.when(is_text, s["n"]).otherwise(s["n"] + 1)
        shown = F.when(is_text, escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<|"), escape(p["type"]), F.lit(":"), n.cast("string"), F.lit("|>")))
        return F.struct(F.concat(s["out"], F.array(shown)).alias("out"), n.alias("n"))
    return F.aggregate(parts, state, visit, lambda s: F.array_join(s["out"], NEXT))


def format_chats(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, parts): conv_id, formatted, loss, attachments.

    ``loss`` lists the spans (start, end), in code points of ``formatted``, of the bodies whose role is in ``trained``;
    ``attachments`` lists (turn, index, kind, ref, tokens) with index numbered through the conversation from 1.
    Turns are ordered by turn, then role and content, so ties and repeated rows give the same result on every run; null
    roles and contents are empty, null turns come first, null ids form one conversation. Other columns are ignored. A
    conversation is one result row and must fit one; nothing else is gathered by key.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", F.to_json("parts"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    base = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.col("parts").cast(PART_TYPE).alias("parts"))
            .withColumn("media", attachments_of(F.col("parts")))
            .withColumn("at", F.row_number().over(order))
            .withColumn("seen", F.coalesce(F.sum(F.size("media").cast("long")).over(before), F.lit(0))))
    shown = (base.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)))
             .withColumn("body", flatten(F.col("parts"), F.col("seen")))
             .withColumn("chars", (F.length("head") + F.length("body") + len(END)).cast("long"))
             .withColumn("start", F.coalesce(F.sum("chars").over(before), F.lit(0)) + F.length("head")))
    one = F.struct("at", F.concat("head", "body", F.lit(END)).alias("piece"), F.col("role").isin(*trained).alias("trained"),
                   F.col("start"), (F.col("start") + F.length("body")).alias("end"),
                   F.transform("media", lambda m: F.struct(F.col("turn").alias("turn"), (F.col("seen") + m["index"] + 1).alias("index"),
                                                           m["kind"].alias("kind"), m["ref"].alias("ref"), m["tokens"].alias("tokens"))).alias("media"))
    return (shown.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
            .select("conv_id", F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
                    F.transform(F.filter("all", lambda t: t["trained"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"),
                    F.flatten(F.transform("all", lambda t: t["media"])).alias("attachments")))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, body), unescaped; parts stay parted by their control string."""
    turns = F.filter(F.split(formatted, r"<\|end\|>"), lambda t: t != "")

    def one(t):
        role = F.substring_index(t, BODY, 1)
        body = t.substr(F.length(role) + F.lit(len(BODY) + 1), F.length(t))
        return F.struct(unescape(role.substr(F.lit(len(TURN) + 1), F.length(role))).alias("role"), unescape(body).alias("text"))
    return F.transform(turns, one)


def under_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss spans, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def digests(chats: DataFrame) -> DataFrame:
    """What reading ``format_chats`` back gives: counts and SHA-256 digests per conversation."""
    read = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (chats.withColumn("turns", read_back(F.col("formatted"))).withColumn("under", under_loss(F.col("formatted"), F.col("loss")))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(read, 256).alias("turns_sha256"),
                    F.length("under").cast("long").alias("loss_chars"), F.sha2("under", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


#: The conversation that quotes another template's control strings.
PROBE = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) as turns of one text part each, plus conversation -7."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
    return rows.select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))


#: DuckDB SQL for the digests: escaping adds one character per control string, framing a fixed number per turn.
SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
controls as (
  select *, [len(regexp_extract_all(x, '[<\[]\\*(\||/?s>|/?INST\])')) + len(regexp_extract_all(x, '[<\[]\\*</?SYS>>'))
             for x in [role, text]] as more
  from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(len(role) + len(text) + 23 + more[1] + more[2])::bigint as formatted_chars
from controls group by conv_id
"""
