"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation becomes one or more windows of whole turns. Prefix sums of the turns' tokens choose
where a window ends; later windows begin with the conversation's system turn and a limited number
of the turns before them. Such repeated turns are never under the loss mask, so each assistant text
is learned from once.

Turns are gathered in blocks of consecutive turns, not in whole conversations, and a window never
crosses a block, so one very long conversation is spread over many tasks. Blocks are cut by a turn's
place in its conversation, whatever the turns' numbers are. A single turn that is larger than the
budget gets a window of its own and is never cut.

Template: <|im_start|>role, a line feed, text, <|im_end|>, a line feed. Control strings inside roles
and texts get one backslash more after their first character, which takes any of them apart and can
be undone exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepsake.llm.tables import stored

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM, ASSISTANT = "system", "assistant"

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
BLOCK_TURNS = 256
# Tokens that the marks and the role of a turn take.
TURN_TOKENS = 5

_TOKEN = r"\w+|[^\w\s]"
_CONTROL = r"(\||/?s>|/?INST\])"
_OPEN = r"([<\[])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _OPEN + r"\\(\\*)" + _CONTROL, "$1$2$3")


def _escape_role(role: Column) -> Column:
    """Also without line feeds: the first one ends the role."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\-")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    plain = F.replace(unescape(role), F.lit("\\n"), F.lit("\n"))
    return F.replace(plain, F.lit("\\-"), F.lit("\\"))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(START), _escape_role(turn["role"]), F.lit("\n"))


def _total(turns: Column) -> Column:
    return F.aggregate(turns, F.lit(0), lambda s, t: s + t["tokens"])


def windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """Conversations (conv_id, turn, role, text) -> formatted windows.

    Returns (conv_id, block, number, text, n_repeated, loss): `n_repeated` leading turns of the
    window are repeats; `loss` are the places (start, end) of texts to learn from, in code points.
    Turns are taken in the order of turn (null first), role, text; in conversations of more than
    BLOCK_TURNS turns, texts of one turn and role that share their first 64 characters come in the
    order of a hash. Words and marks are counted as tokens; text without blanks between its words is
    one word. A null role or text is empty; a null conv_id is a conversation of its own; repeated
    rows are repeated turns. Other columns are not looked at. An empty table gives an empty one.
    """
    df = conversations
    text = F.coalesce(df["text"].cast("string"), F.lit(""))
    placed = _placed(
        df.select(
            df["conv_id"].alias("conv"),
            df["turn"].alias("turn"),
            F.coalesce(df["role"].cast("string"), F.lit("")).alias("role"),
            text.alias("text"),
        )
    )
    turns = placed.select(
        "conv",
        F.floor(F.col("place") / BLOCK_TURNS).alias("block"),
        F.struct(
            "place", "turn", "role", "text",
            (F.regexp_count("text", F.lit(_TOKEN)) + TURN_TOKENS).alias("tokens"),
        ).alias("t"),
    )
    blocks = turns.groupBy("conv", "block").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    context = _context(turns, history_turns)
    same = F.col("conv").eqNullSafe(F.col("c_conv")) & F.col("block").eqNullSafe(F.col("c_block"))
    blocks = blocks.join(context, same, "left")

    none = F.slice(F.col("turns"), 1, 0)
    own_head = F.col("turns")[0]
    is_first = F.col("c_conv").isNull() & F.col("c_head").isNull()
    head = F.when(is_first, own_head).otherwise(F.col("c_head"))
    system = F.when(head["role"] == SYSTEM, F.array(head)).otherwise(none)
    blocks = blocks.select(
        "conv", "block", "turns", is_first.alias("is_first"), system.alias("system"),
        F.coalesce("c_tail", none).alias("tail"),
    )

    # prefix[i] is the number of tokens of the first i turns.
    prefix = F.aggregate(
        F.col("turns"),
        F.array(F.lit(0)),
        lambda p, t: F.concat(p, F.array(F.element_at(p, -1) + t["tokens"])),
    )
    room = F.greatest(F.lit(budget) - _total(F.col("system")) - history_tokens, F.lit(1))
    blocks = blocks.withColumn("prefix", prefix).withColumn("room", room)
    starts = F.aggregate(
        F.sequence(F.lit(1), F.size("turns")),
        F.array(F.lit(0)),
        lambda s, i: F.when(
            (F.get("prefix", i) - F.get("prefix", F.element_at(s, -1)) > F.col("room"))
            & (i - 1 > F.element_at(s, -1)),
            F.concat(s, F.array(i - 1)),
        ).otherwise(s),
    )
    spans = blocks.withColumn("starts", starts).select(
        "*", F.posexplode("starts").alias("number", "begin")
    )
    end = F.coalesce(F.get("starts", F.col("number") + 1), F.size("turns"))
    fresh = F.slice(F.col("turns"), F.col("begin") + 1, end - F.col("begin"))
    # The system turn itself is no history: it stands in front.
    skipped = F.when(F.col("is_first"), F.size("system")).otherwise(0)
    passed = F.concat(
        "tail",
        F.slice(F.col("turns"), skipped + 1, F.greatest(F.col("begin") - skipped, F.lit(0))),
    )
    spans = spans.select("conv", "block", "number", "begin", "is_first", "system",
                         fresh.alias("fresh"), passed.alias("passed"))
    history = F.slice(F.col("passed"), 1, 0)
    for n in range(1, history_turns + 1):
        last = F.slice(F.col("passed"), F.size("passed") - n + 1, n)
        fits = (F.size("passed") >= n) & (_total(F.when(F.size("passed") >= n, last)
                                                 .otherwise(history)) <= history_tokens)
        history = F.when(fits, last).otherwise(history)
    opening = F.col("is_first") & (F.col("begin") == 0)
    repeated = F.when(opening, F.slice(F.col("fresh"), 1, 0)).otherwise(
        F.concat("system", history)
    )
    spans = spans.withColumn("repeated", repeated).select(
        "conv", "block", "number",
        F.concat("repeated", "fresh").alias("turns"), F.size("repeated").alias("n_repeated"),
    )
    parts = F.transform("turns", lambda t: F.struct(
        _header(t).alias("header"), escape(t["text"]).alias("body"), t["role"].alias("role")
    ))
    spans = spans.withColumn("parts", parts)
    lengths = F.transform(
        "parts", lambda p: F.length(p["header"]) + F.length(p["body"]) + len(END)
    )
    spans = spans.withColumn("lengths", lengths)

    def place(part: Column, i: Column) -> Column:
        ahead = F.slice(F.col("lengths"), F.lit(1), i)
        start = F.aggregate(ahead, F.lit(0), lambda a, b: a + b) + F.length(part["header"])
        learned = (i >= F.col("n_repeated")) & (part["role"] == ASSISTANT)
        return F.when(
            learned, F.struct(start.alias("start"), (start + F.length(part["body"])).alias("end"))
        )

    joined = F.array_join(
        F.transform("parts", lambda p: F.concat(p["header"], p["body"], F.lit(END))), ""
    )
    loss = F.filter(F.transform("parts", place), lambda s: s.isNotNull())
    return spans.select(
        F.col("conv").alias("conv_id"), "block", "number", joined.alias("text"), "n_repeated",
        loss.alias("loss"),
    )


def _placed(turns: DataFrame) -> DataFrame:
    """The turns with their place in their conversation; 0 for all turns of one that fits a block,
    whose order is settled there.

    The turns of longer ones are sorted by ranges, numbered within their range, and counted on from
    the ranges before. A range begins in the middle of one conversation at most, so there are no
    more of these counts than partitions.
    """
    counts = turns.groupBy("conv").agg(F.count("*").alias("n"))
    long = stored(counts.where(F.col("n") > BLOCK_TURNS).select(F.col("conv").alias("long")), "long")
    if long.isEmpty():
        return turns.withColumn("place", F.lit(0).cast("long"))
    marked = turns.join(long.withColumn("is_long", F.lit(True)),
                        F.col("conv").eqNullSafe(F.col("long")), "left").drop("long")
    short = marked.where("is_long IS NULL").withColumn("place", F.lit(0).cast("long"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "start", "mark", "tie"]
    keyed = marked.where("is_long").withColumns(
        {"start": F.substring("text", 1, 64), "mark": F.xxhash64("text"),
         "tie": F.monotonically_increasing_id()}
    )
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged = stored(
        ranged.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("id")),
        "turns",
    ).withColumn("part", F.shiftright("id", 33))
    sizes = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sizes.select(F.col("conv").alias("o_conv"), F.col("part").alias("o_part"),
                     F.sum("n").over(earlier).alias("before"))
        .where("before > 0")
    )
    inside = Window.partitionBy("conv", "part").orderBy("id")
    same = F.col("conv").eqNullSafe(F.col("o_conv")) & (F.col("part") == F.col("o_part"))
    numbered = ranged.withColumn("inside", F.row_number().over(inside) - 1).join(
        F.broadcast(offsets), same, "left"
    )
    place = (F.col("inside") + F.coalesce("before", F.lit(0))).cast("long")
    long_turns = numbered.select("conv", "turn", "role", "text", place.alias("place"))
    return short.drop("is_long").select(*long_turns.columns).union(long_turns)


def _context(turns: DataFrame, history_turns: int) -> DataFrame:
    """(c_conv, c_block, c_head, c_tail) for blocks that aren't their conversation's first: its
    first turn and the last turns of the block before. Few conversations have more than a block;
    the rest only pass their ids here."""
    order = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first())
    later = (
        turns.select("conv", "block")
        .distinct()
        .select(
            F.col("conv").alias("c_conv"),
            F.col("block").alias("c_block"),
            F.struct(F.lag("block").over(order).alias("at")).alias("before"),
            F.struct(F.first("block").over(order).alias("at")).alias("first"),
            F.row_number().over(order).alias("nth"),
        )
        .where("nth > 1")
    )

    def of(which: str) -> Column:
        same_block = F.col("block").eqNullSafe(F.col(which)["at"])
        return F.col("conv").eqNullSafe(F.col("c_conv")) & same_block

    keys = ["c_conv", "c_block"]
    tails = later.join(turns, of("before")).groupBy(*keys).agg(
        F.array_sort(F.collect_list("t")).alias("all")
    )
    n = F.least(F.size("all"), F.lit(history_turns))
    tails = tails.select(*keys, F.slice("all", F.size("all") - n + 1, n).alias("c_tail"))
    heads = later.join(turns, of("first")).groupBy(*keys).agg(F.min("t").alias("c_head"))
    heads = heads.toDF("h_conv", "h_block", "c_head")
    same = F.col("c_conv").eqNullSafe(F.col("h_conv")) & F.col("c_block").eqNullSafe(
        F.col("h_block")
    )
    return tails.join(heads, same).select(*keys, "c_head", "c_tail")


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and learned texts of each window, from its text and its loss places alone.

    Adds turns (role, text), without the repeats, and learned, an array of texts.
    """
    pieces = F.split("text", r"<\|im_start\|>")
    pieces = F.slice(pieces, F.col("n_repeated") + 2, F.size(pieces))

    def parse(piece: Column) -> Column:
        body = F.substr(piece, F.lit(1), F.length(piece) - len(END))
        role = F.substring_index(body, "\n", 1)
        return F.struct(
            _unescape_role(role).alias("role"),
            unescape(F.substr(body, F.length(role) + 2)).alias("text"),
        )

    def learned(place: Column) -> Column:
        return unescape(
            F.substr(F.col("text"), place["start"] + 1, place["end"] - place["start"])
        )

    return formatted.withColumn("turns", F.transform(pieces, parse)).withColumn(
        "learned", F.transform("loss", learned)
    )


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from what read_back() finds in its windows."""
    back = read_back(formatted)
    lines = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    windows_ = back.select(
        "conv_id",
        F.struct(
            "block", "number", F.array_join(lines, "").alias("turns"),
            F.array_join("learned", "").alias("learned"),
        ).alias("w"),
        F.size("turns").alias("n_turns"),
        F.length("text").alias("n_chars"),
    )
    rows = windows_.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.sum("n_chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("w")).alias("w"),
    )
    whole = lambda name: F.array_join(F.transform("w", lambda w: w[name]), "")
    learned = whole("learned")
    return rows.select(
        "conv_id", "n_turns", F.sha2(whole("turns"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )
