"""Chat formatting with Spark expressions only: collect turns, merge neighbours of one role, concatenate.

The turns of a conversation are sorted by turn, role and text. Neighbours of the same role share one block:

    <|im_start|>role
    text<|im_cont|>next text of the same role<|im_end|>

Control strings inside texts and roles are escaped with a backslash, so every row can be read back.
The loss mask lists the place (in code points) of every text of the trained role; markers are outside it.

Null texts and null roles count as empty. Repeated rows are repeated turns. Rows with a null conv_id form
one conversation. An empty table gives no rows. Columns other than the four named ones are not used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, CONT, END, LINE = "<|im_start|>", "<|im_cont|>", "<|im_end|>\n", "<|nl|>"
#: Control strings of this and other templates; "<|" covers all markers above.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

#: Turns that are handled together where running totals are needed.
GROUP = 128


def escape(text: Column) -> Column:
    """Double backslashes, then split every control string with a single one."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    """After `escape` original backslashes come in even runs, so a single one was inserted."""
    text = F.regexp_replace(text, r"([<\[])\\(?!\\)", "$1")
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def _block(start: Column, i: Column) -> Column:
    """The turns from a start up to the next one: struct<role, texts>."""
    end = F.coalesce(F.get("starts", i + 1), F.size("turns"))
    texts = F.transform(F.slice("turns", start + 1, end - start), lambda t: t["text"])
    return F.struct(F.get("turns", start)["role"].alias("role"), texts.alias("texts"))


def _sum(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda total, x: total + x)


def _piece(chars: Column, train: Column | None = None) -> Column:
    return F.struct(chars.cast("long").alias("chars"), (F.lit(False) if train is None else train).alias("train"))


def format_conversations(turns: DataFrame, train_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (array of start and chars)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("turns")
    )
    places = F.sequence(F.lit(0), F.size("turns") - 1)
    first = lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])
    starts = collected.withColumn("starts", F.filter(places, first))
    merged = starts.select("conv_id", F.transform("starts", _block).alias("blocks"))
    written = F.transform(
        "blocks",
        lambda block: F.struct(
            (block["role"] == train_role).alias("train"),
            F.concat(F.lit(START), F.replace(escape(block["role"]), F.lit("\n"), F.lit(LINE)), F.lit("\n")).alias("head"),
            F.transform(block["texts"], escape).alias("texts"),
        ),
    )
    blocks = merged.select("conv_id", written.alias("blocks"))
    whole = F.transform("blocks", lambda b: F.concat(b["head"], F.array_join(b["texts"], CONT), F.lit(END)))
    # pieces of the output in order: each is a length and whether it is under the mask
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.array(_piece(F.length(b["head"]))),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda t, i: F.array(_piece(F.when(i > 0, len(CONT)).otherwise(0)), _piece(F.length(t), b["train"])),
                    )
                ),
                F.array(_piece(F.lit(len(END)))),
            ),
        )
    )
    rows = blocks.select("conv_id", F.array_join(whole, "").alias("formatted"), pieces.alias("pieces"))
    # Running totals in two levels, of groups and within each: no array grows turn by turn.
    groups = F.sequence(F.lit(0), F.floor((F.size("pieces") - 1) / GROUP).cast("int"))
    rows = rows.withColumn("groups", F.transform(groups, lambda g: F.slice("pieces", g * GROUP + 1, GROUP)))
    rows = rows.withColumn("sums", F.transform("groups", lambda g: _sum(F.transform(g, lambda p: p["chars"]))))
    rows = rows.withColumn("before", F.transform("sums", lambda _, i: _sum(F.slice("sums", 1, i))))

    def placed(group: Column, before: Column) -> Column:
        chars = F.transform(group, lambda p: p["chars"])
        start = lambda j: (before + _sum(F.slice(chars, 1, j))).alias("start")
        spans = F.transform(group, lambda p, j: F.when(p["train"], F.struct(start(j), p["chars"].alias("chars"))))
        return F.filter(spans, lambda s: s.isNotNull())

    return rows.select("conv_id", "formatted", F.flatten(F.zip_with("groups", "before", placed)).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")

    def turns(block: Column) -> Column:
        place = F.locate("\n", block)
        role = F.substr(block, F.lit(len(START) + 1), place - F.lit(len(START) + 1))
        body = F.substr(block, place + F.lit(1))
        role = unescape(F.replace(role, F.lit(LINE), F.lit("\n")))
        return F.transform(
            F.split(body, r"<\|im_cont\|>"), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the mask, unescaped, nothing between. Spans are cut out of the stretch of their group."""
    cut = lambda text, start, chars: F.substr(text, (start + 1).cast("int"), chars.cast("int"))

    def group(g: Column) -> Column:
        spans = F.slice(loss, g * GROUP + 1, GROUP)
        first, last = F.get(spans, F.lit(0))["start"], F.element_at(spans, -1)
        stretch = F.array(F.struct(cut(formatted, first, last["start"] + last["chars"] - first).alias("text"), spans.alias("spans")))
        texts = lambda s: F.transform(s["spans"], lambda x: unescape(cut(s["text"], x["start"] - F.get(s["spans"], F.lit(0))["start"], x["chars"])))
        return F.array_join(F.flatten(F.transform(stretch, texts)), "")

    groups = F.when(F.size(loss) > 0, F.sequence(F.lit(0), F.floor((F.size(loss) - 1) / GROUP).cast("int")))
    return F.coalesce(F.array_join(F.transform(groups, group), ""), F.lit(""))


def digest(formatted: DataFrame) -> DataFrame:
    """What reading the output back gives: counts and digests of turns and of the text under the mask."""
    read = formatted.withColumns({"__turns": read_back(F.col("formatted")), "__loss": loss_text(F.col("formatted"), F.col("loss"))})
    lines = F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
