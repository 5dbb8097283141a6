"""Chats with tool calls: calls linked to results, ordered, validated, and written as canonical JSON.

Calls and results are rows of their own and meet in a join by conversation and identifier. A call may name calls it
needs; its level is one more than the highest level among them, found by doubling pointers along chains and round by
round where calls have several needs, so rows of a conversation sort by level and turn and no task
holds a conversation. Arguments are parsed to variants, held against the tool's schema, and
written with sorted keys and without spaces.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkeep.llm.scratch import settled
from starkeep.sources.files import materialize

#: JSON Schema types by what Spark calls a variant's type.
KINDS = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "array": "ARRAY", "object": "OBJECT", "null": "VOID"}
CALL = "array<struct<id:string,name:string,arguments:string,needs:array<string>>>"


#: Calls as they are read: the usual nested form has name and arguments in ``function``.
READ = "array<struct<id:string,name:string,arguments:string,needs:array<string>,function:struct<name:string,arguments:string>>>"


def messages_of(conversations: DataFrame) -> DataFrame:
    """Turns as messages ``(conv_id, turn, role, content, calls, result_of, own_calls)``; ``own_calls`` says that the turn itself lists calls.

    A text that is a JSON object with ``tool_calls`` makes calls (a call may list ``needs``); one with ``tool_call_id`` is
    a result. Of plain chats, each question is read as a call of the tool ``reply``, named
    after its turn and needing the question two turns before; an answer is the result of the question one turn before. A need or
    result that meets no call is left unlinked; so every turn takes part, without a look at its neighbours.
    """
    text = F.coalesce("text", F.lit(""))
    shape = f"content string, tool_calls {READ}, tool_call_id string"
    parsed = F.when(F.startswith(F.ltrim(text), F.lit("{")), F.from_json(text, shape))
    rows = conversations.select("conv_id", F.col("turn").cast("long"), "role", text.alias("text"), parsed.alias("m"))
    own = F.col("m.tool_calls").isNull() & F.col("m.tool_call_id").isNull()
    back = lambda n: (F.col("turn") - n).cast("string")
    named = F.struct(
        back(0).alias("id"),
        F.lit("reply").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"),
        F.array(back(2)).alias("needs"),
    )
    flat = F.transform(
        "m.tool_calls",
        lambda c: F.struct(
            c["id"].alias("id"),
            F.coalesce(c["name"], c["function"]["name"]).alias("name"),
            F.coalesce(c["arguments"], c["function"]["arguments"]).alias("arguments"),
            c["needs"].alias("needs"),
        ),
    )
    calls = F.coalesce(flat, F.when(own & (F.col("role") == "user"), F.array(named)))
    answer = F.when(own & (F.col("role") == "assistant"), back(1))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        # a text that only looks like JSON is written whole
        F.when(F.col("m.tool_calls").isNotNull(), F.col("m.content"))
        .when(F.col("m.tool_call_id").isNotNull(), F.coalesce("m.content", "text"))
        .otherwise(F.col("text"))
        .alias("content"),
        calls.cast(CALL).alias("calls"),
        F.coalesce("m.tool_call_id", answer).alias("result_of"),
        F.col("m.tool_calls").isNotNull().alias("own_calls"),
    )


def canonical(arguments: Column) -> Column:
    """JSON with sorted keys and no spaces; null where it does not parse."""
    return F.to_json(F.try_parse_json(arguments))


def faults(arguments: Column, fields: Column) -> Column:
    """Sorted names of fields that are missing, not allowed, or of another type than ``fields`` (array
    of ``name``, ``type``, ``required``) says; ``*`` for arguments that are no object. Null ``fields`` (an unknown tool) give null."""
    values = F.try_variant_get(F.try_parse_json(arguments), "$", "map<string,variant>")
    names = F.map_keys(values)

    def wrong(field):
        name, kind = field.getField("name"), field.getField("type")
        value = F.try_element_at(values, name)
        found = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
        number = found.isin("BIGINT", "DOUBLE", "DECIMAL", "FLOAT")
        same = F.when(kind == "number", number)
        for json_kind, spark_kind in KINDS.items():
            same = same.when(kind == json_kind, found == spark_kind)
        absent = ~F.array_contains(names, name)
        return F.when(absent, field.getField("required")).otherwise(~F.coalesce(same.otherwise(False), F.lit(False)))

    known = F.transform(fields, lambda f: f.getField("name"))
    bad = F.transform(F.filter(fields, wrong), lambda f: f.getField("name"))
    extra = F.array_except(names, known)
    return F.when(fields.isNotNull(), F.when(values.isNull(), F.array(F.lit("*"))).otherwise(F.array_sort(F.concat(bad, extra))))


def _chains(single: DataFrame) -> DataFrame:
    """``(conv_id, id, anchor, steps)`` of calls with one need each ``(conv_id, id, need)``.

    The anchor is the first call down the chain that has no need or several. Pointers are
    doubled, so the rounds grow with the logarithm of the longest chain. What has not
    arrived by then runs in a cycle, and gets no row.
    """
    way = single.select("conv_id", "id", F.col("need").alias("anchor"), F.lit(1).cast("long").alias("steps"))
    way = settled(way, "chains")
    for _ in range(max(1, way.count()).bit_length() + 1):
        further = way.select("conv_id", F.col("id").alias("anchor"), F.col("anchor").alias("next"), F.col("steps").alias("more"))
        joined = way.join(further, ["conv_id", "anchor"], "left")
        way = settled(
            joined.select(
                "conv_id",
                "id",
                F.coalesce("next", "anchor").alias("anchor"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNull().alias("there"),
            ),
            "chains",
        )
        if way.filter("NOT there").isEmpty():
            break
    return way.filter("there").drop("there")


def levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, id, level)`` of calls ``(conv_id, id, needs)`` whose needs can all be met.

    A level is one more than the highest among the needs, 0 without any. A need that names no
    call of the conversation is ignored. Calls in or behind a cycle get no row. Chains of calls with one need
    each are drawn together first; then a round settles every call of several needs whose needs are all settled.
    So a conversation of one long chain takes few rounds, and no task holds a conversation.
    """
    ids = calls.select("conv_id", "id").distinct()
    edges = calls.select("conv_id", "id", F.explode("needs").alias("need")).filter("need IS NOT NULL").distinct()
    edges = settled(edges.join(ids.select("conv_id", F.col("id").alias("need")), ["conv_id", "need"]), "needs")
    counted = settled(edges.groupBy("conv_id", "id").agg(F.count("*").alias("n"), F.min("need").alias("need")), "needs")
    chains = _chains(counted.filter("n = 1"))
    own = ids.join(counted.filter("n = 1"), ["conv_id", "id"], "left_anti")
    own = own.select("conv_id", "id", F.col("id").alias("anchor"), F.lit(0).cast("long").alias("steps"))
    reached = settled(own.unionByName(chains), "anchors")
    roots = ids.join(counted, ["conv_id", "id"], "left_anti").withColumn("level", F.lit(0).cast("long"))
    done = settled(roots, "levels")
    several = edges.join(counted.filter("n > 1").select("conv_id", "id"), ["conv_id", "id"], "left_semi")
    through = reached.select("conv_id", F.col("id").alias("need"), "anchor", "steps")
    left = settled(several.join(through, ["conv_id", "need"], "left"), "needs")
    while not left.isEmpty():
        have = done.select("conv_id", F.col("id").alias("anchor"), F.col("level").alias("below"))
        met = left.join(have, ["conv_id", "anchor"], "left").groupBy("conv_id", "id")
        met = met.agg(F.max(F.col("below") + F.col("steps")).alias("top"), F.bool_and(F.col("below").isNotNull()).alias("ready"))
        new = settled(met.filter("ready").select("conv_id", "id", (F.col("top") + 1).alias("level")), "levels")
        if new.isEmpty():
            break
        left = settled(left.join(new, ["conv_id", "id"], "left_anti"), "needs")
        done = settled(done.unionByName(new), "levels")
    at = done.select("conv_id", F.col("id").alias("anchor"), "level")
    return reached.join(at, ["conv_id", "anchor"]).select("conv_id", "id", (F.col("level") + F.col("steps")).alias("level"))


def format_chats(messages: DataFrame, schemas: DataFrame, whole: bool = False) -> DataFrame:
    """``(conv_id, level, turn, kind, id, linked, faults, line)``: one canonical JSON line for each message, call and result.

    Sorted by conv_id, level, turn and kind (``call`` before ``message`` before ``result``), a conversation's lines put each call after the
    results it needs and each result after its call. ``schemas (tool, fields)`` lists the tools. ``linked`` says whether a call has a
    result and a result its call; ``faults`` are those of a call's arguments, ``tool`` for an unknown tool and
    ``cycle`` for a call whose needs can't be met (it has no level). Null ids link nothing, nor do null
    conversations, whose calls have level 0. Of calls that repeat an identifier
    in a conversation the first turn's is linked; all are written. A null text is an empty one.

    With ``whole``, calls with a null id are written too, unlinked, and a turn that lists calls has a ``message`` line
    besides if it has content or its list is empty; without, those lines are left out.
    """
    calls = messages.select("conv_id", "turn", F.explode("calls").alias("c")).filter("c IS NOT NULL").select("conv_id", "turn", "c.*")
    nameless = F.concat(F.lit("\0"), F.sha2(F.to_json(F.struct("turn", "name", "arguments", "needs")), 256))
    calls = calls.withColumn("key", F.coalesce("id", nameless))
    calls = materialize(calls if whole else calls.filter("id IS NOT NULL"), "calls")
    results = messages.filter("result_of IS NOT NULL").select("conv_id", "turn", "content", F.col("result_of").alias("id"))
    level = levels(calls.select("conv_id", F.col("key").alias("id"), "needs"))
    answered = results.select("conv_id", "id").distinct().withColumn("answered", F.lit(True))
    first = F.min("turn").alias("called")
    known = calls.groupBy("conv_id", F.col("key").alias("id")).agg(first).join(level, ["conv_id", "id"], "left")
    tools = F.broadcast(schemas.select(F.col("tool").alias("name"), "fields"))
    wrong = F.when(F.col("fields").isNull(), F.array(F.lit("tool"))).otherwise(faults(F.col("arguments"), F.col("fields")))
    # without a conversation nothing links, and nothing is needed in vain
    level = F.coalesce("level", F.when(F.col("conv_id").isNull(), F.lit(0).cast("long")))
    wrong = F.when(level.isNull(), F.array_append(wrong, F.lit("cycle"))).otherwise(wrong)
    arguments = F.coalesce(canonical(F.col("arguments")), F.to_json(F.to_variant_object(F.struct(F.col("arguments").alias("raw")))))
    head = F.concat(F.lit('{"arguments":'), arguments, F.lit(',"id":'), _text("id"), F.lit(',"name":'), _text("name"))
    called = (
        calls.join(known.withColumnRenamed("id", "key"), ["conv_id", "key"], "left")
        .join(answered, ["conv_id", "id"], "left")
        .join(tools, "name", "left")
        .select(
            "conv_id",
            (2 * level).alias("level"),
            "turn",
            F.lit("call").alias("kind"),
            "id",
            (F.coalesce("answered", F.lit(False)) & (F.col("turn") == F.col("called"))).alias("linked"),
            wrong.alias("faults"),
            F.concat(head, F.lit(',"turn":'), _number("turn"), F.lit("}")).alias("line"),
        )
    )
    returned = results.join(known, ["conv_id", "id"], "left").select(
        "conv_id",
        (2 * F.col("level") + 1).alias("level"),
        "turn",
        F.lit("result").alias("kind"),
        "id",
        F.col("called").isNotNull().alias("linked"),
        F.lit(None).cast("array<string>").alias("faults"),
        F.concat(F.lit('{"content":'), _text("content"), F.lit(',"tool_call_id":'), _text("id"), F.lit(',"turn":'), _number("turn"), F.lit("}")).alias("line"),
    )
    spoken = "own_calls AND (content != '' OR size(filter(calls, c -> c IS NOT NULL)) = 0)" if whole else "false"
    plain = messages.filter(f"(calls IS NULL OR {spoken}) AND result_of IS NULL").select(
        "conv_id",
        F.lit(-1).cast("long").alias("level"),
        "turn",
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("boolean").alias("linked"),
        F.lit(None).cast("array<string>").alias("faults"),
        F.concat(F.lit('{"content":'), _text("content"), F.lit(',"role":'), _text("role"), F.lit(',"turn":'), _number("turn"), F.lit("}")).alias("line"),
    )
    return called.unionByName(returned).unionByName(plain)


def _text(name: str) -> Column:
    """A string as JSON; null as null."""
    whole = F.to_json(F.array(F.col(name)))
    return F.when(F.col(name).isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(2), F.length(whole) - 2))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))
