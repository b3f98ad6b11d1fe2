"""Tool calls of conversations: linked with their results, ordered, checked against schemas, as canonical JSON.

A message of role ``assistant`` may hold JSON ``{"tool_calls": [{"id", "name", "arguments", "after"}]}``, one of role
``tool`` ``{"tool_call_id", "content"}``. ``after`` names the call whose result a call takes, or is a list of several.
Built from DataFrame functions only:

- calls and results are joined on conversation and identifier;
- a call's depth is the longest way to it from a call without predecessor. Chains of calls with one predecessor each are
  shortened by pointer doubling (rounds grow with the logarithm of the longest), so that only calls with several are
  left to be settled one after another. Within a conversation calls are numbered by depth, turn and place;
- arguments are checked against the parameters declared for the tool, by name, whatever letters the name has;
- JSON is written with sorted keys and normalised numbers.

A text that is null, empty or not JSON holds no calls. A call or result without id cannot be linked and is left out. Calls without
conversation belong together. Of calls that repeat an id the first (by turn and place) counts, of results too.
``after`` that names no call, or a circle of calls, gives the status ``unordered`` and no depth; such calls come last
in the order. A result that names no call is a row of its own with the status ``orphan``. Arguments that are no JSON object, or
repeat a name, are the problem ``arguments unreadable`` and stand in the canonical JSON as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerofuse.operators.ordering import with_position
from aerofuse.session import materialize, materialize_counted

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:variant>>>"
RESULTS = "struct<tool_call_id:string,content:string>"
ROUNDS = 64
KEY = ["conv", "id"]


def _conversation() -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def calls_of(messages: DataFrame) -> DataFrame:
    """conv_id, conv, id, turn, place, name, arguments (as written), after (as given), preds (null: none)."""
    parsed = messages.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.posexplode(F.from_json("text", CALLS)["tool_calls"]).alias("place", "c"))
    given = F.when(~F.is_variant_null("c.after"), F.col("c.after"))
    many = F.try_variant_get(given, "$", "array<string>")
    preds = F.when(F.schema_of_variant(given).startswith("ARRAY"), F.array_distinct(F.array_compact(many))).when(
        given.isNotNull(), F.array(F.try_variant_get(given, "$", "string")))
    rows = parsed.select(
        "conv_id", _conversation().alias("conv"), F.col("c.id").alias("id"), "turn", "place", F.struct(
            F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.to_json(given).alias("after"),
            F.when(F.size(preds) > 0, preds).alias("preds")).alias("rest"))
    firsts = rows.where(F.col("id").isNotNull()).groupBy("conv_id", *KEY).agg(
        F.min(F.struct("turn", "place", "rest")).alias("first"))
    return firsts.select("conv_id", *KEY, "first.turn", "first.place", "first.rest.*")


def results_of(messages: DataFrame) -> DataFrame:
    """conv_id, conv, id, result_turn, content."""
    parsed = messages.where(F.col("role") == "tool").select("conv_id", "turn", F.from_json("text", RESULTS).alias("r"))
    rows = parsed.select("conv_id", _conversation().alias("conv"), F.col("r.tool_call_id").alias("id"), F.struct(
        F.col("turn").alias("result_turn"), F.col("r.content").alias("content")).alias("first"))
    return rows.where(F.col("id").isNotNull()).groupBy("conv_id", *KEY).agg(F.min("first").alias("first")).select("conv_id", *KEY, "first.*")


def _tops(calls: DataFrame) -> DataFrame:
    """conv, id, top, above, kind: the nearest call on the way up that has no predecessor or several, how far up it is,
    and its number of predecessors; ``top`` is null where the way ends nowhere or goes round."""
    ways = calls.select(*KEY, F.coalesce(F.size("preds"), F.lit(0)).alias("kind"), F.col("preds")[0].alias("pred"))
    links = ways.select(*KEY, F.when(F.col("kind") == 1, F.col("pred")).otherwise(F.col("id")).alias("top"),
                        F.when(F.col("kind") == 1, 1).otherwise(0).cast("long").alias("above"))
    ends = materialize(ways.where("kind <> 1").select("conv", F.col("id").alias("top"), "kind"), "chain-ends")
    links, n = materialize_counted(links, "chain-0")
    for k in range(1, ROUNDS):
        open_ = links.where("top IS NOT NULL").join(ends, ["conv", "top"], "left_anti")
        if not n or 2 ** (k - 1) > n or open_.isEmpty():  # what is longer than all calls together is a circle
            break
        higher = links.select("conv", F.col("id").alias("top"), F.col("top").alias("top2"), F.col("above").alias("above2"))
        met = links.join(higher, ["conv", "top"], "left")  # without a row above: the predecessor is missing
        links, n = materialize_counted(met.select(*KEY, F.col("top2").alias("top"), (F.col("above") + F.col("above2")).alias("above")), f"chain-{k}")
    return links.join(ends, ["conv", "top"], "left").select(
        *KEY, F.when(F.col("kind").isNotNull(), F.col("top")).alias("top"), "above", "kind")


def depths(calls: DataFrame) -> DataFrame:
    """conv, id, depth: 0 without predecessor; null where predecessors are missing or form a circle."""
    tops = materialize(_tops(calls), "tops")
    fresh = tops.where("kind = 0 AND above = 0").select(
        "conv", F.col("id").alias("top"), F.lit(0).cast("long").alias("start"), F.lit(False).alias("lost"))
    known = fresh
    several = calls.where(F.size("preds") > 1).select(*KEY, F.explode("preds").alias("pred"))
    ways, left = materialize_counted(several.join(
        tops.select("conv", F.col("id").alias("pred"), "top", "above"), ["conv", "pred"], "left").select(
        *KEY, "top", "above", F.lit(None).cast("long").alias("begun"), F.isnull("top").alias("gone")), "ways-0")
    k = 0
    while left:  # a round for each call with several predecessors on the longest way; settled calls leave
        k += 1
        met = materialize(ways.join(fresh, ["conv", "top"], "left").select(
            *KEY, "top", "above", F.coalesce("begun", "start").alias("begun"), (F.col("gone") | F.coalesce("lost", F.lit(False))).alias("gone")), f"met-{k}")
        each = met.groupBy(*KEY).agg(
            F.max(F.col("begun") + F.col("above")).alias("most"), F.bool_and(F.col("begun").isNotNull()).alias("whole"), F.bool_or("gone").alias("lost"))
        fresh, n = materialize_counted(each.where("whole OR lost").select(
            "conv", F.col("id").alias("top"), F.when(~F.col("lost"), F.col("most") + 1).alias("start"), "lost"), f"starts-{k}")
        if not n:
            break
        known = known.union(fresh)
        ways, left = materialize_counted(met.join(fresh.select("conv", F.col("top").alias("id")), KEY, "left_anti"), f"ways-{k}")
    return tops.join(known, ["conv", "top"], "left").select(*KEY, (F.col("start") + F.col("above")).alias("depth"))


def problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv, id, problems: sorted names of what is wrong with the arguments, for calls with any.

    ``schemas`` has tool, parameter, type (of variant schemas, as BIGINT or STRING) and required.
    """
    read = calls.select(*KEY, "name", "arguments", F.try_parse_json("arguments").alias("v"))
    shaped = read.withColumn("sound", F.col("arguments").isNull() | F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
    parsed = shaped.select(*KEY, "name", "sound", F.when(F.col("sound"), F.from_json("arguments", "map<string,variant>")).alias("given"))
    declared = schemas.select(F.col("tool").alias("name"), "parameter", F.col("type").alias("wanted"), "required")
    tools = declared.select("name").distinct()
    known = parsed.where("sound").join(tools, "name", "left_semi")
    typed = known.select(*KEY, "name", F.explode("given").alias("parameter", "value")).withColumn(
        "kind", F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0))
    checked = typed.join(declared, ["name", "parameter"], "left").select(*KEY, F.when(
        F.col("wanted").isNull(), F.concat(F.lit("unknown "), "parameter")).when(
        F.col("kind") != F.col("wanted"), F.concat(F.lit("type "), "parameter")).alias("problem")).where("problem IS NOT NULL")
    has = F.coalesce(F.map_keys("given"), F.array().cast("array<string>"))
    needed = known.select(*KEY, "name", has.alias("has")).join(declared.where("required"), "name").where(
        ~F.array_contains("has", F.col("parameter"))).select(*KEY, F.concat(F.lit("missing "), "parameter").alias("problem"))
    unknown = parsed.join(tools, "name", "left_anti").select(*KEY, F.lit("unknown tool").alias("problem"))
    unread = parsed.where(~F.col("sound")).select(*KEY, F.lit("arguments unreadable").alias("problem"))
    return checked.union(needed).union(unknown).union(unread).groupBy(*KEY).agg(F.array_sort(F.collect_set("problem")).alias("problems"))


def link(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per result without call: conv_id, id, name, turn, place, depth, order (from 1, within the
    conversation; null for results without call), result_turn, content, problems, status, canonical."""
    calls = materialize(calls_of(messages), "calls")
    results = results_of(messages)
    placed = materialize(calls.join(depths(calls), KEY, "left"), "placed")
    last = placed.select(*KEY, "depth", "turn", "place").withColumn("late", F.col("depth").isNull().cast("int"))
    order = with_position(last, ["late", "depth", "turn", "place", "id"], ["conv"], "order").select(*KEY, "order")
    joined = placed.join(order, KEY).join(problems(calls, schemas), KEY, "left")
    status = F.when(F.col("depth").isNull(), "unordered").when(F.col("problems").isNotNull(), "invalid").when(
        F.col("result_turn").isNull(), "unanswered").otherwise("ok")
    arguments = F.coalesce(F.try_parse_json("arguments"), F.expr("CAST(arguments AS VARIANT)"))
    body = F.struct(F.try_parse_json("after").alias("after"), arguments.alias("arguments"), "content", "id", "name")
    answered = joined.join(results.drop("conv_id"), KEY, "left")
    whole = answered.select(
        "conv_id", "id", "name", "turn", "place", "depth", "order", "result_turn", "content",
        F.coalesce("problems", F.array().cast("array<string>")).alias("problems"), status.alias("status"), F.to_json(body).alias("canonical"))
    orphans = results.join(calls.select(*KEY), KEY, "left_anti").select(
        "conv_id", "id", "result_turn", "content", F.array().cast("array<string>").alias("problems"), F.lit("orphan").alias("status"),
        F.to_json(F.struct("content", "id")).alias("canonical"))
    return whole.unionByName(orphans, allowMissingColumns=True)
