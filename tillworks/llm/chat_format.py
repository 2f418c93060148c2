"""Chat formatting by a grammar round trip, in DataFrame functions only.

Turns are rendered between control strings, and the rendered text is parsed
again by a deterministic parser for the grammar

    conversation = { START role NEWLINE body END NEWLINE }

where no role holds a newline and neither role nor body holds START or END.  The
recovered turns are compared with the source.  Where they differ, the turns that
do not come back on their own are escaped, and the conversation is rendered,
parsed and compared again, until both are identical; turns that come back are
never touched.  Escaping puts one more backslash behind the first two characters
of every control string, with or without backslashes there, and writes a newline
in a role as a reserved control string; the parser takes one backslash off.  So an
escaped turn holds no control string and comes back: the second parse settles
every conversation, and one that differed still would raise an error.

The loss mask covers the bodies of the trained role, as runs of code points.

Turns are ordered by number, then role, then text, turns without a number last;
repeated rows stay repeated.  Null roles and texts are empty, rows without an id
form one conversation, as any rows that share an id; empty texts keep their
turn; an empty table gives no conversation; other columns are not read.  A
conversation is one output value and held whole by one row, whatever its
length; all steps are linear in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
NEWLINE = "<|im_line|>"
NAMES = "im_start|im_end|im_line"
TRAINED = "assistant"
# Parses after the first; the proof above needs one.
ROUNDS = 2


def _escape(c: Column) -> Column:
    return F.regexp_replace(c, rf"<\|(\\*+)({NAMES})\|>", r"<|\\$1$2|>")


def _unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"<\|\\(\\*+)({NAMES})\|>", r"<|$1$2|>")


def _escape_role(c: Column) -> Column:
    return F.replace(_escape(c), F.lit("\n"), F.lit(NEWLINE))


def _unescape_role(c: Column) -> Column:
    return _unescape(F.replace(c, F.lit(NEWLINE), F.lit("\n")))


def render(turns: Column) -> Column:
    """The text of ``turns``, an array of ``role, text`` as they are to stand there."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(f"{END}\n"))), "")


def parse(text: Column) -> Column:
    """The turns of a rendered text: an array of ``role, text, head, body``, the last two as they stand there.

    What is no turn of the grammar becomes a null, which equals no turn of a source.
    """
    pieces = F.split(text, f"\\Q{START}\\E", -1)

    def turn(piece: Column) -> Column:
        ends = F.split(piece, f"\\Q{END}\\E", -1)
        head = F.substring_index(ends[0], "\n", 1)
        body = F.substr(ends[0], F.length(head) + 2)
        valid = (F.size(ends) == 2) & (F.element_at(ends, -1) == "\n") & F.contains(ends[0], F.lit("\n"))
        named = [_unescape_role(head).alias("role"), _unescape(body).alias("text"), head.alias("head"), body.alias("body")]
        return F.when(valid, F.struct(*named))

    # START begins every turn: nothing stands before the first.
    turns = F.transform(F.slice(pieces, 2, F.size(pieces)), turn)
    return F.when(pieces[0] == "", turns).otherwise(F.array(F.lit(None).cast("struct<role:string,text:string,head:string,body:string>")))


def _same(parsed: Column, source: Column) -> Column:
    """Whether recovered turns are the source's."""
    return F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))) == source


def _escape_conflicts(turns: Column, source: Column) -> Column:
    """``turns`` with those escaped once more that do not come back when they stand alone.

    Control strings share no character at their ends, so a turn that comes back alone does so among others.
    """

    def mend(t: Column, s: Column) -> Column:
        escaped = F.struct(_escape_role(t["role"]).alias("role"), _escape(t["text"]).alias("text"))
        return F.when(_same(parse(render(F.array(t))), F.array(s)), t).otherwise(escaped)

    return F.zip_with(turns, source, mend)


def conversations(df: DataFrame, id_column: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: the id and ``_source``, an array of ``role, text`` in order."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    row = F.struct(F.col(turn).isNull().alias("last"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    listed = df.groupBy(id_column).agg(F.sort_array(F.collect_list(row)).alias("_turns"))
    return listed.select(id_column, F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_source"))


def _runs(parsed: str, trained: str) -> Column:
    """Runs of code points outside and under the loss: head, body and end of every turn."""

    def runs(t: Column) -> Column:
        run = lambda n, loss: F.struct(n.cast("long").alias("chars"), loss.alias("loss"))
        head, end = F.length(t["head"]) + len(START) + 1, F.lit(len(END) + 1)
        return F.array(run(head, F.lit(False)), run(F.length(t["body"]), t["role"] == trained), run(end, F.lit(False)))

    return F.flatten(F.transform(F.col(parsed), runs))


def format_chats(
    df: DataFrame, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = TRAINED
) -> DataFrame:
    """``id, formatted, mask``: the text and its runs of ``chars, loss``, in order and without gaps."""
    done = conversations(df, id_column, turn, role, text).withColumn("_turns", F.col("_source"))
    done = done.withColumn("formatted", render(F.col("_turns"))).withColumn("_parsed", parse(F.col("formatted")))
    for _ in range(ROUNDS - 1):
        done = done.withColumn("_same", _same(F.col("_parsed"), F.col("_source")))
        again = lambda c, new: F.when(F.col("_same"), F.col(c)).otherwise(new)
        done = done.withColumn("_turns", again("_turns", _escape_conflicts(F.col("_turns"), F.col("_source"))))
        done = done.withColumn("formatted", again("formatted", render(F.col("_turns"))))
        done = done.withColumn("_parsed", again("_parsed", parse(F.col("formatted"))))
    differs = F.raise_error(F.lit("a formatted conversation does not come back")).cast("string")
    settled = F.when(_same(F.col("_parsed"), F.col("_source")), F.col("formatted")).otherwise(differs)
    return done.select(id_column, settled.alias("formatted"), _runs("_parsed", trained).alias("mask"))


def read_back(chats: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """``id, turns, loss_text, formatted_chars`` of formatted conversations, from their text and mask alone.

    The text under a run of the mask is the body of the turn it belongs to, unescaped; runs that do not fit raise.
    """
    read = chats.select(id_column, "formatted", "mask", parse(F.col("formatted")).alias("turns"))

    def under_loss(t: Column, i: Column) -> Column:
        run = F.get("mask", i * 3 + 1)
        return F.when(run["chars"] != F.length(t["body"]), F.raise_error(F.lit("a mask that does not fit its text")).cast("string")).when(run["loss"], t["text"]).otherwise("")

    return read.select(
        id_column, "turns", F.array_join(F.transform("turns", under_loss), "").alias("loss_text"), F.length("formatted").alias("formatted_chars")
    )


def digest_sql(extra: str = "") -> str:
    """DuckDB SQL for the digests of ``conversations`` and the rows of ``extra``."""
    any_control = rf"<\|(\\*)({NAMES})\|>"
    spoils = rf"<\|(im_start|im_end)\|>|<\|\\+({NAMES})\|>"
    escaped = lambda c: rf"regexp_replace({c}, '{any_control}', '<|\\\1\2|>', 'g')"
    order = "ORDER BY turn NULLS LAST, role, text"
    return f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations{extra})),
  shown AS (SELECT *, CASE WHEN regexp_matches(text, '{spoils}') OR regexp_matches(role, '{any_control}') OR contains(role, chr(10))
    THEN length(replace({escaped('role')}, chr(10), '{NEWLINE}')) + length({escaped('text')}) ELSE length(role) + length(text) END AS chars FROM turns),
  whole AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
    string_agg(CASE WHEN role = '{TRAINED}' THEN text ELSE '' END, '' {order}) AS loss, sum(chars + {len(START) + len(END) + 2}) AS chars FROM shown GROUP BY conv_id)
  SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM whole"""
