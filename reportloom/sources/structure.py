"""Large JSON documents cut into their orders by many tasks.

A document `{..., "DATA": [{...}, {...}], ...}` may be one line of any length. Spark's text source reads it in byte ranges and ends
a piece at each `}`; where a piece lies, in a text or not and how deep, is only known from everything before it. But what a piece
does to that state is known from the piece alone: it flips "in a text" once for each quote, and changes the depth by one of two
numbers, one for each state it may start in. These changes compose, so pieces are summed up per byte range, the ranges per file (one row
for each range), and then every piece knows its place. Pieces up to one that ends at depth 2 or less make a group: an order, with what
stands before it. A task never holds more than a range of pieces, and no value is larger than one order.

Built from windows over a byte range and grouped sums; the text is read once for each level of sums and once for the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reportloom.session import materialise

#: Members of the document lie at this depth, orders close at this one or, if `DATA` is a single order, one above.
MEMBER_DEPTH, ORDER_DEPTH = 1, 2
_RANGE = ["__file", "__block"]


def _without_escapes(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def json_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of the files under `path`, each without the `}` that ends it, and what each does: `__flip` (0 or 1) and the change of
    depth if it starts outside a text (`__out`) or inside one (`__in`), the closing `}` included."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_modification_time").alias("__arrived"),
        F.col("_metadata.file_size").alias("__size"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
        F.col("value").alias("__text"),
    )
    without_quoted = lambda c: F.regexp_replace(c, '"[^"]*"?', "")
    shaped = raw.withColumn("__bare", _without_escapes(F.col("__text"))).select(
        "*",
        (_count(F.col("__bare"), '"') % 2).alias("__flip"),
        without_quoted(F.col("__bare")).alias("__outside"),
        without_quoted(F.concat(F.lit('"'), "__bare")).alias("__inside"),
        (F.octet_length("__text") + 1).alias("__bytes"), F.is_valid_utf8("__text").alias("__readable"),
    )
    change = lambda c: _count(c, "{[") - _count(c, "}]")
    return shaped.select(
        "__file", "__arrived", "__size", "__block", "__at", "__text", "__flip", "__bytes", "__readable",
        (change(F.col("__outside")) - F.when(F.col("__flip") == 0, 1).otherwise(0)).alias("__out"),
        (change(F.col("__inside")) - F.when(F.col("__flip") == 1, 1).otherwise(0)).alias("__in"),
    )


def _before(value: Column, by: list[str], order: str) -> Column:
    return F.coalesce(F.sum(value).over(W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _in_range(pieces: DataFrame) -> DataFrame:
    """The state before each piece as if its byte range began outside a text: parity, and the change of depth for both beginnings."""
    flipped = pieces.withColumn("__odd", _before(F.col("__flip"), _RANGE, "__at") % 2)
    own = {
        "__out": F.when(F.col("__odd") == 0, F.col("__out")).otherwise(F.col("__in")),
        "__in": F.when(F.col("__odd") == 0, F.col("__in")).otherwise(F.col("__out")),
    }
    return flipped.withColumns(own)


def _ranges(pieces: DataFrame) -> DataFrame:
    """State at the beginning of each byte range: in a text or not (`__inside`), and depth (`__deep`)."""
    sums = _in_range(pieces).groupBy(*_RANGE).agg((F.sum("__flip") % 2).alias("__flip"), F.sum("__out").alias("__out"), F.sum("__in").alias("__in"))
    started = sums.withColumn("__inside", _before(F.col("__flip"), ["__file"], "__block") % 2)
    change = F.when(F.col("__inside") == 0, F.col("__out")).otherwise(F.col("__in"))
    return started.select(*_RANGE, "__inside", _before(change, ["__file"], "__block").alias("__deep"))


def _placed(pieces: DataFrame, ranges: DataFrame) -> DataFrame:
    """Pieces with the depth before and after them (`__start`, `__end`), and whether a group ends with them (`__closes`)."""
    known = _in_range(pieces).join(ranges, _RANGE)
    change = F.when(F.col("__inside") == 0, F.col("__out")).otherwise(F.col("__in"))
    known = known.withColumn("__change", change).withColumn("__start", F.col("__deep") + _before(F.col("__change"), _RANGE, "__at"))
    outside = (F.col("__inside") + F.col("__odd") + F.col("__flip")) % 2 == 0
    end = F.col("__start") + F.col("__change")
    return known.withColumns({"__end": end, "__closes": F.when(outside & (end <= ORDER_DEPTH), 1).otherwise(0)})


def _checked_ranges(placed: DataFrame, ranges: DataFrame) -> DataFrame:
    """`ranges` with the number of the first group that ends in each (`__first`); a file that is not one complete document is an error."""
    sums = placed.groupBy(*_RANGE).agg(
        F.sum("__closes").alias("__n"),
        F.sum("__bytes").alias("__bytes"),
        F.max("__size").alias("__size"),
        F.sum("__change").alias("__change"),
        F.sum("__flip").alias("__flip"),
        F.bool_and("__readable").alias("__readable"),
    )
    file = W.partitionBy("__file")
    checked = sums.withColumns(
        {
            "__first": _before(F.col("__n"), ["__file"], "__block"),
            "__open_end": F.sum("__bytes").over(file) - F.max("__size").over(file),
            "__depth": F.sum("__change").over(file),
            "__in_text": F.sum("__flip").over(file) % 2,
            "__readable": F.bool_and("__readable").over(file),
        }
    )
    # The last piece has no `}` behind it unless the file ends with one; then it is counted as closing all the same.
    complete = F.col("__readable") & (F.col("__in_text") == 0) & F.col("__open_end").isin(0, 1) & (F.col("__depth") == -F.col("__open_end"))
    message = F.concat(F.col("__file"), F.lit(" is not one complete JSON document in UTF-8"))
    return ranges.join(checked.where(F.assert_true(complete, message).isNull()).select(*_RANGE, "__first"), _RANGE)


def json_groups(spark: SparkSession, path: str) -> DataFrame:
    """Groups in order (`__group` from 0) with their text, and the depth at their start and end. Stored, as several steps read them."""
    pieces = json_pieces(spark, path)
    shapes = pieces.drop("__text", "__arrived")
    # One row for each byte range, stored: the text pass does not sum them up again.
    ranges = _ranges(shapes)
    ranges = materialise(_checked_ranges(_placed(shapes, ranges), ranges))
    # Only here do texts leave their tasks: once to their range, once to their groups.
    placed = _placed(pieces.drop("__size", "__bytes", "__readable"), ranges).withColumn("__own", _before(F.col("__closes"), _RANGE, "__at"))
    numbered = placed.withColumn("__group", F.col("__first") + F.col("__own"))
    place = F.struct("__block", "__at")
    grouped = numbered.groupBy("__file", "__group").agg(
        F.max("__arrived").alias("__arrived"),
        F.min_by("__start", place).alias("__start"),
        F.max_by("__end", place).alias("__end"),
        F.array_sort(F.collect_list(F.struct("__block", "__at", "__text"))).alias("__pieces"),
    )
    text = F.concat(F.array_join(F.transform("__pieces", lambda p: p["__text"]), "}"), F.lit("}"))
    return materialise(grouped.select("__file", "__group", "__arrived", "__start", "__end", text.alias("__text")))


def _opened_members(text: Column, start: Column) -> Column:
    """The members of the document whose list or object begins in a group, in order: `key` in quotes and opening bracket `box`."""
    tokens = F.regexp_extract_all(_without_escapes(text), F.lit(r'"[^"]*"|[\[\]{}:]'), F.lit(0))

    def step(state: Column, token: Column) -> Column:
        at_member, opens = state["depth"] == MEMBER_DEPTH, token.isin("{", "[")
        member = F.struct(state["key"].alias("key"), token.alias("box"))
        return F.struct(
            (state["depth"] + F.when(opens, 1).when(token.isin("}", "]"), -1).otherwise(0)).alias("depth"),
            F.when(token.startswith('"'), token).otherwise(state["last"]).alias("last"),
            F.when(at_member & (token == ":"), state["last"]).otherwise(state["key"]).alias("key"),
            F.when(at_member & opens & state["key"].isNotNull(), F.array_append(state["members"], member)).otherwise(state["members"]).alias("members"),
        )

    nothing = F.lit(None).cast("string")
    none = F.array().cast("array<struct<key:string,box:string>>")
    begin = F.struct(start.cast("int").alias("depth"), nothing.alias("last"), nothing.alias("key"), none.alias("members"))
    return F.aggregate(tokens, begin, step, lambda state: state["members"])


def order_texts(spark: SparkSession, path: str, data: str = "DATA") -> DataFrame:
    """`__arrived`, `__file`, `__pos` and `__orders`, a JSON list with one order, for each order under `data`.

    `data` is a list of objects or a single object. A file that is cut off, or that has no such member, is an error.
    """
    groups = json_groups(spark, path)
    plain = (F.col("__start") == ORDER_DEPTH) & (F.col("__end") == ORDER_DEPTH) & F.col("__text").rlike(r"^\s*,\s*\{")
    members = (
        groups.where(~plain)
        .select("__file", "__group", F.posexplode_outer(_opened_members(F.col("__text"), F.col("__start"))).alias("n", "m"))
        .groupBy("__file")
        .agg(F.array_sort(F.collect_list(F.when(F.col("m").isNotNull(), F.struct("__group", "n", "m.key", "m.box")))).alias("__members"))
    )
    wanted = F.lit(f'"{data}"')
    message = F.concat(F.lit(f"a payload has no {data}: "), F.col("__file"))
    # A branch of its own: a join may be left out when its other side has no rows.
    given = F.exists("__members", lambda m: m["key"] == wanted)
    lacking = members.where(F.when(given, F.lit(False)).otherwise(F.raise_error(message).cast("boolean")))
    # A document has few members; each group takes the last one that begins in it or before it.
    known = groups.join(members, "__file")
    upto = lambda limit: F.try_element_at(F.filter("__members", lambda m: m["__group"] <= limit), F.lit(-1))
    known = known.withColumns({"__member": upto(F.col("__group")), "__earlier": upto(F.col("__group") - 1)})
    own = known.where(F.col("__member.key") == wanted).withColumn("__first", F.col("__member.__group") == F.col("__group"))
    # What stands before the member is closed to a document of its own.
    head = F.when(F.col("__start") == 0, F.lit("")).when(F.col("__start") == MEMBER_DEPTH, F.lit('{"":0'))
    head = head.when(F.col("__earlier.box") == "[", F.lit('{"":[0')).otherwise(F.lit('{"":{"":0'))
    value = lambda text: F.from_json(text, f"`{data}` string", {"mode": "FAILFAST"})[data]
    following = F.concat(F.lit("["), F.regexp_replace("__text", r"^\s*,", ""), F.lit("]"))
    listed = own.where((F.col("__member.box") == "[") & (F.col("__end") == ORDER_DEPTH)).select(
        "__arrived", "__file", (F.col("__group") - F.col("__member.__group")).cast("int").alias("__pos"),
        F.when(F.col("__first"), value(F.concat(head, F.col("__text"), F.lit("]}")))).otherwise(following).alias("__orders"),
    )
    # A single order may hold further objects, which end groups as well: its groups are one text.
    single = own.where((F.col("__member.box") == "{") & (F.col("__end") >= MEMBER_DEPTH)).groupBy("__file").agg(
        F.max("__arrived").alias("__arrived"),
        F.array_sort(F.collect_list(F.struct("__group", F.when(F.col("__first"), F.concat(head, F.col("__text"))).otherwise(F.col("__text")).alias("text")))).alias("parts"),
    )
    whole = F.concat(F.array_join(F.transform("parts", lambda p: p["text"]), ""), F.lit("}"))
    alone = single.select("__arrived", "__file", F.lit(0).alias("__pos"), F.concat(F.lit("["), value(whole), F.lit("]")).alias("__orders"))
    never = lacking.select(F.lit(None).cast("timestamp").alias("__arrived"), "__file", F.lit(0).alias("__pos"), F.lit(None).cast("string").alias("__orders"))
    return listed.unionByName(alone).unionByName(never)
