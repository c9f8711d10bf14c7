"""Tool-call linking for chats: calls meet their results, are ordered, checked against schemas and written as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medledger.llm.common import written

LINK = r'"\$result:([^"]+)"'


def kind_of(value: Column) -> Column:
    """The JSON type of a variant: integer, number, string, boolean, null, object or array."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name == "BIGINT", "integer")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number")
        .when(name == "VOID", "null")
        .otherwise(F.lower(name))
    )


def errors_of(arguments: Column, spec: Column) -> Column:
    """Sorted complaints about arguments (a map of variants) under spec, an array of (param, type, required)."""
    keys = F.map_keys(arguments)
    missing = F.filter(spec, lambda s: s["required"] & ~F.array_contains(keys, s["param"]))
    there = F.filter(spec, lambda s: F.array_contains(keys, s["param"]))

    def wrong(s: Column) -> Column:
        kind = kind_of(F.element_at(arguments, s["param"]))
        return (kind != s["type"]) & ~((kind == "integer") & (s["type"] == "number"))

    unknown = F.array_except(keys, F.transform(spec, lambda s: s["param"]))
    told = F.concat(
        F.transform(missing, lambda s: F.concat(F.lit("missing "), s["param"])),
        F.transform(F.filter(there, wrong), lambda s: F.concat(F.lit("not "), s["type"], F.lit(" "), s["param"])),
        F.transform(unknown, lambda k: F.concat(F.lit("unknown "), k)),
    )
    return (
        F.when(spec.isNull(), F.array(F.lit("unknown tool")))
        .when(arguments.isNull(), F.array(F.lit("arguments are no object")))
        .otherwise(F.sort_array(told))
    )


def ordered(calls: DataFrame) -> DataFrame:
    """calls with (order_turn, order_step, in_cycle): sorted by these, each call stands after those it refers to.

    A call keeps its turn unless something it refers to comes later; then it moves to one step behind that. Rounds of
    joins move the calls that still have to, so there are as many rounds as links of that kind follow each other. A step
    beyond the number of the chat's calls proves a cycle, and those calls move no further.
    """
    links = written(
        calls.select("conv_id", "call_id", F.explode("refers").alias("to")).filter("conv_id is not null").distinct(),
        "chat-links",
    )
    in_chat = calls.groupBy("conv_id").agg(F.count("*").alias("most"))
    places = written(
        calls.filter("conv_id is not null and call_id is not null")
        .groupBy("conv_id", "call_id")
        .agg(F.min("turn").alias("order_turn"))
        .join(in_chat, "conv_id")
        .withColumn("order_step", F.lit(0).cast("long")),
        "chat-places",
    )
    while True:
        ahead = places.select(
            "conv_id", F.col("call_id").alias("to"), F.struct("order_turn", (F.col("order_step") + 1).alias("order_step")).alias("at")
        )
        least = links.join(ahead, ["conv_id", "to"]).groupBy("conv_id", "call_id").agg(F.max("at").alias("least"))
        own = F.struct("order_turn", "order_step")
        moves = F.coalesce((F.col("least") > own) & (F.col("order_step") <= F.col("most")), F.lit(False))
        pick = lambda f: F.when(moves, F.col(f"least.{f}")).otherwise(F.col(f)).alias(f)
        now = places.join(least, ["conv_id", "call_id"], "left").select(
            "conv_id", "call_id", pick("order_turn"), "most", pick("order_step"), moves.alias("moved")
        )
        now = written(now, "chat-places")
        places = now.drop("moved")
        if now.filter("moved").isEmpty():
            break
    found = places.select(
        "conv_id", "call_id", "order_turn", "order_step", (F.col("order_step") > F.col("most")).alias("in_cycle")
    )
    return calls.join(found, ["conv_id", "call_id"], "left").select(
        *calls.columns,
        F.coalesce("order_turn", "turn").alias("order_turn"),
        F.coalesce("order_step", F.lit(0).cast("long")).alias("order_step"),
        F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"),
    )


def linked_chats(messages: DataFrame, tools: DataFrame) -> DataFrame:
    """(conv_id, order_turn, order_step, turn, part, status, message): a row for each message, call and lost result.

    messages: (conv_id, turn, role, text). An assistant's text may be an object with `tool_calls`, a list of {id, name,
    arguments}; a tool's text an object {tool_call_id, content}. tools: (tool, param, type, required), the schemas.
    An argument "$result:ID" refers to another call of the chat. Sorted by the first three columns, then turn and part,
    a chat is in order.

    Calls and results meet by (conv_id, id) in a hash join; of several results the first by turn counts, and of several
    calls with an id each gets it. Status: `message`; `linked` and `open` calls; `cycle` for calls that refer to one
    another; `orphan` results without a call; `repeat` results of a call that has an earlier one. A result without content
    links its call too, with null as the result. `message` is canonical JSON: keys sorted, no spaces, null where there is nothing; of a
    call it holds the checked arguments, the complaints and the result.

    Text that is no such object is plain content. A null conv_id or id: shown, never linked. Null text or role: null.
    Repeated rows: each is shown. No rows: none. Other columns are not read. No chat is gathered into one group.
    """
    typed = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    may = F.col("role").isin("assistant", "tool") & F.ltrim("text").startswith("{")
    parsed = typed.withColumn("v", F.when(may, F.try_parse_json("text")))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    parsed = parsed.withColumn("calls", F.when(F.col("role") == "assistant", get("$.tool_calls", "array<variant>")))
    parsed = parsed.withColumn("answers", F.when(F.col("role") == "tool", get("$.tool_call_id", "string")))

    calls = parsed.select("conv_id", "turn", F.posexplode("calls").alias("part", "v"))
    calls = calls.select(
        "conv_id",
        "turn",
        (F.col("part") + 1).alias("part"),
        get("$.id", "string").alias("call_id"),
        get("$.name", "string").alias("tool"),
        get("$.arguments", "variant").alias("arguments"),
    )
    text = F.to_json("arguments")
    calls = calls.withColumn("refers", F.array_distinct(F.regexp_extract_all(text, F.lit(LINK), F.lit(1))))

    spec = tools.groupBy("tool").agg(F.collect_list(F.struct("param", "type", "required")).alias("spec"))
    results = parsed.filter("answers is not null").select(
        "conv_id", "turn", F.col("answers").alias("call_id"), get("$.content", "variant").alias("content")
    )
    # Equal results of one turn cannot be told apart: they are counted, one is chosen and the others are repeats.
    told = results.groupBy("conv_id", "call_id", "turn", F.to_json("content").alias("told")).agg(F.count("*").alias("n"))
    first = told.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "told")).alias("chosen"))
    as_map = F.when(kind_of(F.col("arguments")) == "object", F.col("arguments").try_cast("map<string,variant>"))
    checked = (
        ordered(calls)
        .join(spec, "tool", "left")
        .join(first, ["conv_id", "call_id"], "left")
        .withColumn("complaints", errors_of(as_map, F.col("spec")))
        .withColumn("result", F.col("chosen.told"))
    )
    shown = lambda **c: F.to_json(
        F.struct(*(x.alias(k) for k, x in sorted(c.items()))), {"ignoreNullFields": "false"}
    )
    status = F.when(F.col("in_cycle"), "cycle").when(F.col("chosen").isNotNull(), "linked").otherwise("open")
    call_rows = checked.select(
        "conv_id",
        "order_turn",
        "order_step",
        "turn",
        "part",
        status.alias("status"),
        shown(
            arguments=F.col("arguments"),
            errors=F.col("complaints"),
            id=F.col("call_id"),
            name=F.col("tool"),
            result=F.try_parse_json("result"),
        ).alias("message"),
    )
    known = calls.select("conv_id", "call_id").distinct()
    orphans = results.join(known, ["conv_id", "call_id"], "left_anti").select(
        "conv_id", F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_step"), "turn", F.lit(0).alias("part"),
        F.lit("orphan").alias("status"), shown(content=F.col("content"), id=F.col("call_id"), role=F.lit("tool")).alias("message"),
    )
    is_chosen = F.struct("turn", "told").eqNullSafe(F.col("chosen"))
    repeats = (
        told.join(first, ["conv_id", "call_id"])
        .join(known, ["conv_id", "call_id"], "left_semi")
        .withColumn("again", F.explode(F.array_repeat(F.lit(0), (F.col("n") - is_chosen.cast("int")).cast("int"))))
        .select(
            "conv_id", F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_step"), "turn", F.lit(0).alias("part"),
            F.lit("repeat").alias("status"),
            shown(content=F.try_parse_json("told"), id=F.col("call_id"), role=F.lit("tool")).alias("message"),
        )
    )
    said = F.when(F.col("calls").isNotNull(), get("$.content", "string")).otherwise(F.col("text"))
    plain = parsed.filter("answers is null").select(
        "conv_id", F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_step"), "turn", F.lit(0).alias("part"),
        F.lit("message").alias("status"), shown(content=said, role=F.col("role")).alias("message"),
    )
    return plain.unionByName(call_rows).unionByName(orphans).unionByName(repeats)


def with_calls(conversations: DataFrame) -> DataFrame:
    """Chats with tool calls derived from plain ones: each assistant turn makes a call, each later user turn answers one.

    The call's id is c and its turn; its arguments come from the text, some wrong on purpose; every other call may refer
    to the next one. The user's whole text is the result of the call one turn before.
    """
    n, turn = F.length("text"), F.col("turn")
    said = lambda c: F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"}).substr(F.lit(6), F.lit(1 << 30))
    quoted = lambda c: F.regexp_replace(said(c), r"\}\z", "")
    name = F.element_at(F.array(*map(F.lit, ("count", "search", "translate"))), (n % 3 + 1).cast("int"))
    pairs = F.concat_ws(
        ",",
        F.when(n % 11 == 0, F.lit('"extra":true')),
        F.concat(F.lit('"limit":'), F.when(n % 5 == 0, F.lit('"many"')).otherwise(n.cast("string"))),
        F.when(((F.floor(turn / 2) % 2) == 0) & (n % 13 < 6), F.concat(F.lit('"ref":"$result:c'), turn + 2, F.lit('"'))),
        F.when(n % 7 != 0, F.concat(F.lit('"text":'), quoted(F.col("text")))),
    )
    call = F.concat(F.lit('{"id":"c'), turn, F.lit('","name":"'), name, F.lit('","arguments":{'), pairs, F.lit("}}"))
    calls = F.concat(F.lit('{"content":'), quoted(F.col("text")), F.lit(',"tool_calls":['), call, F.lit("]}"))
    told = F.concat(F.lit('{"tool_call_id":"c'), turn - 1, F.lit('","content":'), quoted(F.col("text")), F.lit("}"))
    chats = conversations.select("conv_id", "turn", "role", "text")
    asked = (F.col("role") == "assistant") & F.col("text").isNotNull() & turn.isNotNull()
    answers = chats.filter((F.col("role") == "user") & (turn >= 1) & F.col("text").isNotNull())
    return chats.withColumn("text", F.when(asked, calls).otherwise(F.col("text"))).union(
        answers.select("conv_id", "turn", F.lit("tool").alias("role"), told.alias("text"))
    )
