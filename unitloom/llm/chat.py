"""Quotation linking in conversations: nested quote levels are parsed, normalised quoted passages hashed and joined to the
messages they come from, and conversations rebuilt in reply order without quotes. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, join_counted, small_broadcast

QUOTE = r"^(?:[ \t]*>)+"
#: Ends of lines that name the author of the quotation below them.
ATTRIBUTION = r"(?i)(?:wrote|a écrit|schrieb|escribió) ?: *$"
#: Turns of one conversation that a window holds; further stretches meet by their sums.
STRETCH = 4096
#: Messages in one row of conversations().
PART = 1000
MARK = "\x01"


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def depth(line: Column) -> Column:
    """Quote level of a line: the '>' signs it starts with."""
    return F.regexp_count(F.regexp_extract(line, QUOTE, 0), F.lit(">")).cast("int")


def normalised(line: Column) -> Column:
    """A line without quote signs, in lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, QUOTE, "")), rf"(?U)[\s{MARK}]+", " "))


def lines_of(text: Column) -> Column:
    """depth and norm of each line. Attribution lines, which a deeper line follows, count as blank."""
    plain = F.transform(F.split(text, "\n", -1), lambda x: F.struct(depth(x).alias("depth"), normalised(x).alias("norm")))

    def own(lines: Column) -> Column:
        named = lambda x, i: x["norm"].rlike(ATTRIBUTION) & F.coalesce(F.get(lines, i + 1)["depth"] > x["depth"], F.lit(False))
        return F.transform(lines, lambda x, i: F.struct(x["depth"].alias("depth"), F.when(named(x, i), "").otherwise(x["norm"]).alias("norm")))

    return bound(plain, own)


def passages(text: Column) -> Column:
    """Passages of a message as structs of depth and lines: lines of one quote level without a blank line between them."""

    def cut(lines: Column) -> Column:
        # each line behind its depth and a mark; an empty line stands where a passage ends
        level = lambda x, i: F.when(x["depth"] != F.coalesce(F.get(lines, i - 1)["depth"], x["depth"]), "\n").otherwise("")
        marked = F.array_join(F.transform(lines, lambda x, i: F.concat(level(x, i), F.when(x["norm"] == "", "").otherwise(F.concat(x["depth"].cast("string"), F.lit(MARK), x["norm"])))), "\n")
        found = F.filter(F.split(marked, r"\n{2,}", -1), lambda p: p.contains(MARK))
        return F.transform(found, lambda p: F.struct(F.regexp_extract(p, rf"(\d+){MARK}", 1).cast("int").alias("depth"), F.split(F.trim(F.regexp_replace(F.regexp_replace(p, rf"(?m)^\d+{MARK}", ""), r"^\n|\n$", "")), "\n", -1).alias("lines")))

    return bound(lines_of(text), cut)


def unquoted(text: Column) -> Column:
    """A message without quoted lines, the attribution lines above them, and blank lines at either end."""

    def own(lines: Column) -> Column:
        below = lambda i: F.coalesce(F.get(lines, i + 1).rlike(QUOTE), F.lit(False))
        return F.array_join(F.filter(lines, lambda x, i: ~x.rlike(QUOTE) & ~(x.rlike(ATTRIBUTION) & below(i))), "\n")

    return F.regexp_replace(F.regexp_replace(bound(F.split(text, "\n", -1), own), r"^(?:[ \t\r]*\n)+", ""), r"(?:\n[ \t\r]*)+$", "")


def latest_before(events: DataFrame, by: list[str], scratch: Scratch, name: str) -> DataFrame:
    """events (by, turn, own; one row each) with `found`: the greatest smaller turn of the same group whose row is own. Windows hold
    STRETCH turns of a group; what earlier stretches have comes from one row each, so a very large group fills no task."""
    rows = scratch.write(events.withColumn("stretch", F.floor(F.col("turn") / STRETCH)), name)
    here = Window.partitionBy(*by, "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.groupBy(*by, "stretch").agg(F.max(F.when(F.col("own"), F.col("turn"))).alias("last"))
    carried = scratch.write(last.withColumn("carried", F.max("last").over(earlier)).where("carried is not null").drop("last"), f"{name}_carried")
    within = rows.withColumn("found", F.max(F.when(F.col("own"), F.col("turn"))).over(here))
    return within.join(small_broadcast(carried), [*by, "stretch"], "left").select(*events.columns, F.coalesce("found", "carried").alias("found"))


def numbered(rows: DataFrame, by: list[str], scratch: Scratch, name: str) -> DataFrame:
    """by, turn, place: the distinct turns of each group counted from 0, STRETCH turns a window."""
    keys = rows.select(*by, "turn").distinct().withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    keys = scratch.write(keys.withColumn("within", F.row_number().over(Window.partitionBy(*by, "stretch").orderBy("turn")) - 1), name)
    counts = keys.groupBy(*by, "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = scratch.write(counts.withColumn("before", F.sum("n").over(earlier)).where("before is not null").drop("n"), f"{name}_before")
    return keys.join(small_broadcast(before), [*by, "stretch"], "left").select(*by, "turn", (F.col("within") + F.coalesce("before", F.lit(0))).alias("place"))


def quotations(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, depth, quoted_turn, n_passages, n_linked: for each quote level of each message the earlier message of the same
    conversation that most of its characters come from (then the latest). A quoted passage comes from the latest earlier message
    that has it among its own; one quoted in part, from those that have its lines. Found by as-of windows per conversation
    and hash, so no pairs are formed."""
    found = messages.select("conv_id", "turn", F.explode(passages(F.col("text"))).alias("p")).select("conv_id", "turn", "p.depth", "p.lines")
    found = found.select("conv_id", "turn", "depth", "lines", F.array_join("lines", " ").alias("whole"))
    found = scratch.write(found.select("conv_id", "turn", "depth", F.sha2("whole", 256).alias("id"), F.length("whole").alias("chars"), F.col("lines")).distinct(), "passages")
    units = F.concat(F.array(F.struct(F.lit(True).alias("whole"), F.col("id").alias("hash"), F.col("chars").alias("chars"))), F.transform(F.array_distinct("lines"), lambda x: F.struct(F.lit(False).alias("whole"), F.sha2(F.concat(F.lit("line "), x), 256).alias("hash"), F.length(x).alias("chars"))))
    each = scratch.write(found.select("conv_id", "turn", "depth", "id", F.explode(units).alias("u")).select("conv_id", "turn", "depth", "id", "u.*"), "units")
    events = each.groupBy("conv_id", "hash", "turn").agg(F.bool_or(F.col("depth") == 0).alias("own"), F.bool_or(F.col("depth") > 0).alias("quotes"))
    asked = latest_before(events, ["conv_id", "hash"], scratch, "events").where("quotes and found is not null").select("conv_id", "hash", "turn", F.col("found").alias("quoted_turn"))
    linked = each.where("depth > 0").join(asked, ["conv_id", "hash", "turn"], "left")
    complete = F.max(F.when(F.col("whole"), F.col("quoted_turn")))
    per = linked.groupBy("conv_id", "turn", "depth", "id").agg(complete.alias("whole_turn"), F.max(F.when(F.col("whole"), F.col("chars"))).alias("chars"), F.collect_list(F.when(~F.col("whole") & F.col("quoted_turn").isNotNull(), F.struct("quoted_turn", "chars"))).alias("parts"))
    votes = F.when(F.col("whole_turn").isNotNull(), F.array(F.struct(F.col("whole_turn").alias("quoted_turn"), F.col("chars").alias("chars")))).otherwise(F.col("parts"))
    per = per.withColumn("linked", F.col("whole_turn").isNotNull() | (F.size("parts") > 0))
    totals = per.groupBy("conv_id", "turn", "depth").agg(F.count(F.lit(1)).alias("n_passages"), F.sum(F.col("linked").cast("long")).alias("n_linked"))
    best = per.select("conv_id", "turn", "depth", F.explode(votes).alias("v")).groupBy("conv_id", "turn", "depth", "v.quoted_turn").agg(F.sum("v.chars").alias("chars"))
    best = best.groupBy("conv_id", "turn", "depth").agg(F.max(F.struct("chars", "quoted_turn")).alias("best")).select("conv_id", "turn", "depth", F.col("best.quoted_turn").alias("quoted_turn"))
    return totals.join(best, ["conv_id", "turn", "depth"], "left")


def roots(replies: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, root, hops of replies (conv_id, turn, reply_to), by pointer jumping: rows on their way (moving) take over what
    their root has reached; a row whose root has no link of its own has arrived. A root that very many rows stand at is
    looked up without shuffling them."""
    moving = scratch.write(replies.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("hops")), "hops0")
    arrived = moving.limit(0)
    k = 0
    while not moving.isEmpty():
        k += 1
        reached = moving.unionByName(arrived).select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("hops").alias("more"))
        stops = scratch.write(moving.groupBy("conv_id", "root").agg(F.count(F.lit(1)).alias("n")).join(reached, ["conv_id", "root"], "left"), f"stops{k}")
        stepped = join_counted(moving, stops, ["conv_id", "root"]).select("conv_id", "turn", F.coalesce("next", "root").alias("root"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.col("next").isNotNull().alias("moved"))
        stepped = scratch.write(stepped, f"hops{k}")
        arrived = arrived.unionByName(stepped.where("not moved").drop("moved"))
        moving = stepped.where("moved").drop("moved")
    return arrived


def link_replies(messages: DataFrame, text: str = "text") -> DataFrame:
    """conv_id, turn, role, text (unquoted), quote_depth, n_quoted, n_linked, reply_to, thread_root, reply_depth, place of every row of
    messages (conv_id, turn, role, text).

    n_quoted and n_linked count different quoted passages. reply_to is the turn that the first quote level comes from. thread_root
    and reply_depth follow reply_to to its end (rounds grow with the logarithm of the longest chain). place counts a thread's
    turns from 0, so in the order (conv_id, thread_root, place) every message follows what it replies to; see conversations().
    Null text stays null and quotes nothing; blank quoted lines are not linked. Rows with a
    null conv_id or turn pass unlinked, without place. Repeated (conv_id, turn) rows share the links of all of them. An empty table
    gives an empty result. Other columns are not read.
    """
    scratch = Scratch(messages.sparkSession, "chat")
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    placed = rows.where("conv_id is not null and turn is not null")
    links = quotations(placed.where("text is not null"), scratch)
    per = links.groupBy("conv_id", "turn").agg(F.max("depth").alias("quote_depth"), F.sum("n_passages").alias("n_quoted"), F.sum("n_linked").alias("n_linked"), F.max(F.when(F.col("depth") == 1, F.col("quoted_turn"))).alias("reply_to"))
    per = scratch.write(per, "links")
    arrived = roots(per.where("reply_to is not null"), scratch)
    turns = placed.select("conv_id", "turn").distinct().join(per, ["conv_id", "turn"], "left").join(arrived, ["conv_id", "turn"], "left")
    turns = scratch.write(turns.withColumn("thread_root", F.coalesce("root", "turn")).withColumn("reply_depth", F.coalesce("hops", F.lit(0).cast("long"))).drop("root", "hops"), "turns")
    turns = turns.join(numbered(turns, ["conv_id", "thread_root"], scratch, "places"), ["conv_id", "thread_root", "turn"])
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(turns, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", unquoted(F.col("text")).alias("text"), F.coalesce("quote_depth", F.lit(0)).alias("quote_depth"), zero("n_quoted"), zero("n_linked"), "reply_to",
        F.coalesce("thread_root", "turn").alias("thread_root"), zero("reply_depth"), F.col("place").cast("long").alias("place"),
    )


def conversations(linked: DataFrame) -> DataFrame:
    """conv_id, thread_root, part, messages: the threads of link_replies() as arrays of messages (place, turn, reply_to, role, text) in
    reply order. A thread of more than PART turns takes several rows, so no row grows without bound."""
    rows = linked.where("place is not null").withColumn("part", F.floor(F.col("place") / PART))
    return rows.groupBy("conv_id", "thread_root", "part").agg(F.sort_array(F.collect_list(F.struct("place", "turn", "reply_to", "role", "text"))).alias("messages"))


def as_mail(conversations: DataFrame) -> DataFrame:
    """conversations as people mail them: each message below an attribution line and a quotation of the message it answers, which itself
    quotes the one that answered. A message answers one of the three before it, by (conv_id + number) modulo as many as there are.
    The table holds no quotation marks, so this makes the operator's input."""
    scratch = Scratch(conversations.sparkSession, "mail")
    rows = conversations.select("conv_id", "turn", "role", "text")
    numbers = scratch.write(numbered(rows.where("conv_id is not null and turn is not null"), ["conv_id"], scratch, "numbers"), "numbered")
    back = lambda n: F.when(F.col(n) > 0, F.col(n) - 1 - F.pmod(F.col("conv_id") + F.col(n), F.least(F.col(n), F.lit(3))))
    texts = rows.join(numbers, ["conv_id", "turn"]).groupBy("conv_id", "place").agg(F.min("text").alias("text"), F.min("role").alias("role"))
    texts = scratch.write(texts, "texts")
    side = lambda k: texts.select("conv_id", F.col("place").alias(f"_at{k}"), F.col("text").alias(f"_text{k}"), F.col("role").alias(f"_role{k}"))
    placed = rows.join(numbers, ["conv_id", "turn"], "left").withColumn("_at1", back("place")).withColumn("_at2", back("_at1"))
    placed = placed.join(side(1), ["conv_id", "_at1"], "left").join(side(2), ["conv_id", "_at2"], "left")
    quote = lambda c, mark: F.concat(F.lit(mark), F.regexp_replace(c, "\n", "\n" + mark))
    inner = F.concat(F.lit("> "), F.coalesce("_role2", F.lit("someone")), F.lit(" wrote:\n"), quote(F.col("_text2"), "> > "), F.lit("\n>\n"))
    above = F.concat(F.lit("On a day "), F.coalesce("_role1", F.lit("someone")), F.lit(" wrote:\n"), F.coalesce(inner, F.lit("")), quote(F.col("_text1"), "> "), F.lit("\n\n"))
    return placed.select("conv_id", "turn", "role", F.when(F.col("_text1").isNull(), F.col("text")).otherwise(F.concat(above, "text")).alias("text"))


#: What as_mail() quoted, worked out from the table itself: the passages of the quoted messages, the latest earlier message with each.
ORACLE = r"""
with m as (select conv_id, turn, role, "text", row_number() over (partition by conv_id order by turn) - 1 as n from conversations),
a as (select *, case when n > 0 then n - 1 - (conv_id + n) % least(n, 3) end as n1 from m),
b as (select *, case when n1 > 0 then n1 - 1 - (conv_id + n1) % least(n1, 3) end as n2 from a),
marked as (select conv_id, turn, n, array_to_string(list_transform(string_split("text", chr(10)), lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g'))), chr(10)) as body from m where "text" is not null),
own as (select distinct conv_id, turn, n, replace(p, chr(10), ' ') as p from (select conv_id, turn, n, unnest(list_filter(list_transform(regexp_split_to_array(body, '\n\n+'), lambda x: trim(x, chr(10))), lambda x: x <> '')) as p from marked)),
quoted as (select b.conv_id, b.turn, 1 as depth, o.p from b join own o on o.conv_id = b.conv_id and o.n = b.n1
  union all select b.conv_id, b.turn, 2, o.p from b join a c on c.conv_id = b.conv_id and c.n = b.n1 and c."text" is not null join own o on o.conv_id = b.conv_id and o.n = b.n2),
linked as (select q.conv_id, q.turn, q.depth, q.p, max(o.turn) as source from quoted q join own o on o.conv_id = q.conv_id and o.p = q.p and o.turn < q.turn group by all),
totals as (select conv_id, turn, max(depth) as quote_depth, count(*) as n_quoted from linked group by all),
votes as (select conv_id, turn, source, sum(length(p)) as chars from linked where depth = 1 group by all),
replies as (select conv_id, turn, arg_max(source, (chars, source)) as reply_to from votes group by all),
chain(conv_id, turn, root, hops) as materialized (with recursive c(conv_id, turn, root, hops) as (select conv_id, turn, turn, 0 from m union all select c.conv_id, c.turn, r.reply_to, hops + 1 from c join replies r on r.conv_id = c.conv_id and r.turn = c.root) select conv_id, turn, arg_max(root, hops), max(hops) from c group by all)
select m.conv_id, m.turn, m.role, regexp_replace(regexp_replace(m."text", '^([ \t\r]*\n)+', ''), '(\n[ \t\r]*)+$', '') as text, cast(coalesce(t.quote_depth, 0) as int) as quote_depth,
  coalesce(t.n_quoted, 0) as n_quoted, coalesce(t.n_quoted, 0) as n_linked, r.reply_to, c.root as thread_root, cast(c.hops as bigint) as reply_depth,
  row_number() over (partition by m.conv_id, c.root order by m.turn) - 1 as place
from m join chain c on c.conv_id = m.conv_id and c.turn = m.turn left join totals t on t.conv_id = m.conv_id and t.turn = m.turn left join replies r on r.conv_id = m.conv_id and r.turn = m.turn
"""
