"""Operator 10, chat formatting: tool-call linking.

Native: DataFrame functions only.

Messages are rows (conv_id, turn, role, text).  An assistant's text may be a
JSON object with `tool_calls`, a list of {id, name, arguments, after}: `after`
names calls of the conversation that must come first.  A message of role `tool`
is a JSON object {tool_call_id, content}, the result of a call.

Calls and results are hash-joined on (conversation, identifier).  Calls are
ordered topologically: a call's level is one more than that of the highest call
it comes after; calls on a cycle, or after a call that does not exist, have
level -1, like messages.  Chains of calls that come after one other call are
shortened by pointer doubling, in as many rounds as the logarithm of their
length; only calls after several others take a round for each that follows
another.  Arguments are checked against the JSON schema of their tool, objects
and lists in them level by level down to the depth of the schemas: types (one
or a list; a number of whole value is an integer), required names, names that
the schema does not allow, ranges, lengths, patterns, enumerations.  A keyword
that is not checked is reported where it stands, as "unchecked <keyword>".
Every call, result and plain message becomes one line of canonical JSON: keys
sorted, no white space, nulls left out, and one form for equal numbers up to
20 digits before and 18 after the point (beyond, as doubles).

The result has a row per call, result and message, with sort columns (turn,
level, place); it is never gathered into a row per conversation, so a
conversation of any length stays spread.

Defined results: of calls that repeat an identifier the first counts for
linking and order, the others are `repeated`; a result links to its call if the
call stands in an earlier turn, and of several the first counts; calls without
identifier, results without call, and texts that are no such JSON are kept,
unlinked, the last as plain messages; null texts are plain messages without
content; null turns sort first; schemas of one name: the smallest by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import fits, written

CALLS = "content string, tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>"
RESULT = "tool_call_id string, content string"
SCHEMA = (
    "type string, required array<string>, additionalProperties string, properties map<string,string>, items string, minimum double, "
    "maximum double, exclusiveMinimum double, exclusiveMaximum double, minLength int, maxLength int, minItems int, maxItems int, "
    "pattern string, enum array<string>"
)
#: Keywords that are checked, and those that check nothing.
KEYWORDS = [f.split()[0] for f in SCHEMA.split(", ")] + ["title", "description", "default", "examples", "format", "$schema", "$id", "$comment"]
#: Most tool schemas that are broadcast; more are joined by a shuffle.
BROADCAST_SCHEMAS = 4096


def _is_object(text: Column) -> Column:
    """Whether the text is one JSON object."""
    return F.coalesce(F.call_function("schema_of_variant", F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def plain_numbers(text: Column) -> Column:
    """The JSON text with numbers that have an exponent written out, where 38
    digits hold them exactly.  Escaped quotes and backslashes are written as
    code points first, so that quotes part strings from the rest."""
    def written_out(t: Column) -> Column:
        d = t.try_cast("decimal(38,18)")
        exact = d.isNotNull() & (d.cast("double") == t.try_cast("double"))
        short = F.regexp_replace(F.regexp_replace(d.cast("string"), r"0+$", ""), r"\.$", "")
        return F.when(t.rlike(r"^-?[0-9]+(?:\.[0-9]+)?[eE][-+]?[0-9]+$") & exact, short).otherwise(t)

    def outside(piece: Column) -> Column:
        tokens = F.regexp_extract_all(piece, F.lit(r"([-+0-9.eE]+|[^-+0-9.eE]+)"), F.lit(1))
        return F.when(piece.rlike("[0-9][eE]"), F.array_join(F.transform(tokens, written_out), "")).otherwise(piece)

    safe = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    pieces = F.transform(F.split(safe, '"'), lambda p, i: F.when(i % 2 == 0, outside(p)).otherwise(p))
    return F.when(text.rlike("[0-9][eE][-+0-9]"), F.array_join(pieces, '"')).otherwise(text)


def parsed(text: Column) -> Column:
    """JSON text as a variant; null if it is no JSON."""
    return F.try_parse_json(plain_numbers(text))


def canonical(text: Column) -> Column:
    """JSON text with sorted keys and no white space; null if it is no JSON."""
    return F.to_json(parsed(text))


def _kind(v: Column) -> Column:
    return F.call_function("schema_of_variant", v)


def _node(path: Column, value: Column, spec: Column) -> Column:
    """A value of the arguments, where it stands, and its schema as text."""
    return F.struct(path.alias("path"), value.alias("value"), spec.alias("spec"))


def _at(path: Column, name: Column) -> Column:
    return F.when(path == "", name).otherwise(F.concat(path, F.lit("."), name))


def _bound(values: Column, make) -> Column:
    """Each value's `make`, flat: an array of arrays in one."""
    return F.flatten(F.transform(values, make))


def _checks(node: Column) -> Column:
    """What is wrong with one value under its schema, its parts left aside."""
    none = F.array().cast("array<string>")

    def under(p: Column) -> Column:
        value, path = node["value"], node["path"]
        kind = _kind(value)
        number = F.call_function("try_variant_get", value, F.lit("$"), F.lit("double"))
        string = F.call_function("try_variant_get", value, F.lit("$"), F.lit("string"))
        numeric = (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
        is_object, is_list = kind.startswith("OBJECT"), kind.startswith("ARRAY")
        types = F.when(p["type"].startswith("["), F.from_json(p["type"], "array<string>")).otherwise(F.array(p["type"]))
        fits_type = F.exists(
            types,
            lambda t: F.when(t == "string", kind == "STRING").when(t == "integer", numeric & (number == F.floor(number)))
            .when(t == "number", numeric).when(t == "boolean", kind == "BOOLEAN").when(t == "null", kind == "VOID")
            .when(t == "object", is_object).when(t == "array", is_list).otherwise(True),
        )

        def held(test: Column) -> Column:  # a bound that is not given holds
            return F.coalesce(test, F.lit(True))

        in_range = held(number >= p["minimum"]) & held(number <= p["maximum"]) & held(number > p["exclusiveMinimum"]) & held(number < p["exclusiveMaximum"])
        in_length = held(F.length(string) >= p["minLength"]) & held(F.length(string) <= p["maxLength"])
        count = F.size(F.call_function("try_variant_get", value, F.lit("$"), F.lit("array<variant>")))
        in_count = held(count >= p["minItems"]) & held(count <= p["maxItems"])
        wrong = (
            F.when(~fits_type, F.lit("type")).when(numeric & ~in_range, F.lit("range"))
            .when((kind == "STRING") & ~in_length | is_list & ~in_count, F.lit("length"))
            .when((kind == "STRING") & ~held(F.regexp_count(string, p["pattern"]) > 0), F.lit("pattern"))
            .when(~held(F.array_contains(p["enum"], F.coalesce(string, F.to_json(value)))), F.lit("enum"))
        )
        own = F.when(wrong.isNotNull(), F.array(F.concat(wrong, F.when(path == "", "").otherwise(F.concat(F.lit(" "), path))))).otherwise(none)
        names = F.map_keys(F.call_function("try_variant_get", value, F.lit("$"), F.lit("map<string,variant>")))
        listed = F.coalesce(F.map_keys(p["properties"]), none)
        missing = F.transform(F.array_except(F.coalesce(p["required"], none), names), lambda n: F.concat(F.lit("missing "), _at(path, n)))
        closed = F.coalesce(p["additionalProperties"] == "false", F.lit(False))
        extra = F.transform(F.array_except(names, listed), lambda n: F.concat(F.lit("unknown "), _at(path, n)))
        inside = F.when(is_object, F.concat(missing, F.when(closed, extra).otherwise(none))).otherwise(none)
        keywords = F.coalesce(F.call_function("json_object_keys", node["spec"]), none)
        extras = F.array_except(keywords, F.array(*map(F.lit, KEYWORDS)))
        schema_given = p["additionalProperties"].startswith("{") & (p["additionalProperties"] != "{}")
        extras = F.concat(extras, F.when(schema_given, F.array(F.lit("additionalProperties"))).otherwise(none))
        unchecked = F.transform(extras, lambda k: F.concat(F.lit("unchecked "), k, F.when(path == "", "").otherwise(F.concat(F.lit(" "), path))))
        return F.concat(own, inside, unchecked)

    return _bound(F.array(F.from_json(node["spec"], SCHEMA)), under)


def _parts(node: Column) -> Column:
    """The nodes below one value that have a schema: its fields, or its items."""
    def under(p: Column) -> Column:
        fields = F.call_function("try_variant_get", node["value"], F.lit("$"), F.lit("map<string,variant>"))
        items = F.call_function("try_variant_get", node["value"], F.lit("$"), F.lit("array<variant>"))
        of_object = F.transform(
            F.map_entries(F.map_filter(fields, lambda k, _: F.array_contains(F.map_keys(p["properties"]), k))),
            lambda e: _node(_at(node["path"], e["key"]), e["value"], F.try_element_at(p["properties"], e["key"])),
        )
        of_list = F.transform(items, lambda v, i: _node(F.concat(node["path"], F.lit("["), i.cast("string"), F.lit("]")), v, p["items"]))
        nothing = F.filter(F.array(node), lambda n: F.lit(False))
        kind = _kind(node["value"])
        return F.when(kind.startswith("OBJECT"), F.coalesce(of_object, nothing)).when(
            kind.startswith("ARRAY") & p["items"].isNotNull(), F.coalesce(of_list, nothing)
        ).otherwise(nothing)

    return _bound(F.array(F.from_json(node["spec"], SCHEMA)), under)


def _depth(specs: DataFrame) -> int:
    """Levels of the deepest schema (`p`, text): one aggregate a level."""
    level, depth = specs.select(F.col("p").alias("s")), 0
    while not level.isEmpty():
        depth += 1
        p = F.from_json("s", SCHEMA)
        below = F.concat(F.coalesce(F.map_values(p["properties"]), F.array().cast("array<string>")), F.array(p["items"]))
        level = level.select(F.explode(below).alias("s")).where("s IS NOT NULL")
    return depth


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """`calls` (with name, arguments) and a column `errors`: what is wrong, sorted, empty if nothing."""
    spec = schemas.where("name IS NOT NULL").groupBy(schemas["name"].alias("tool")).agg(F.min("parameters").alias("p"))
    spec = written(spec, "schemas")
    levels_ = _depth(spec.where("p IS NOT NULL"))
    spec = F.broadcast(spec) if fits(spec, BROADCAST_SCHEMAS) else spec
    c = calls.join(spec, F.col("name") == F.col("tool"), "left")
    c = c.withColumn("__object", _is_object(F.col("arguments")))
    args = F.when(F.col("__object"), parsed(F.col("arguments")))
    c = c.withColumn("__open", F.when(args.isNotNull() & F.col("p").isNotNull(), F.array(_node(F.lit(""), args, F.col("p")))))
    c = c.withColumn("__bad", F.array().cast("array<string>"))
    for _ in range(levels_):
        c = c.withColumn("__bad", F.concat("__bad", F.coalesce(_bound(F.col("__open"), _checks), F.array().cast("array<string>"))))
        c = c.withColumn("__open", _bound(F.col("__open"), _parts))
    errors = (
        F.when(F.col("tool").isNull(), F.array(F.lit("unknown tool")))
        .when(~F.col("__object"), F.array(F.lit("arguments are no object")))
        .otherwise(F.array_sort("__bad"))
    )
    return c.withColumn("errors", errors).drop("tool", "p", "__open", "__bad", "__object")


def _same(a: str, x: str, b: str, y: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) & (F.col(x) == F.col(y))


#: Rounds after which the tables of the fronts are written as one.
FRONTS = 16


def levels(calls: DataFrame) -> DataFrame:
    """Calls (conv, id, after), distinct in (conv, id) -> (conv, id, level), for those that have an order."""
    edges = calls.select("conv", "id", F.explode("after").alias("dep")).where("dep IS NOT NULL").distinct()
    edges = written(edges, "call_edges")
    need = written(edges.groupBy("conv", "id").agg(F.count("*").alias("need"), F.min("dep").alias("dep")), "call_needs")
    has = need.select(F.col("conv").alias("c"), F.col("id").alias("i"))
    known = written(calls.select("conv", "id").join(has, _same("conv", "id", "c", "i"), "left_anti").select("conv", "id", F.lit(0).alias("level")), "call_levels")

    # a call after one other: (to, far), the call it leads to and how far; doubled until none leads to another such
    lead = need.where("need = 1").select("conv", "id", F.col("dep").alias("to"), F.lit(1).alias("far"))
    rounds = lead.count().bit_length()
    for _ in range(rounds):
        on = lead.select(F.col("conv").alias("c"), F.col("id").alias("i"), F.col("to").alias("next"), F.col("far").alias("more"))
        step = lead.join(on, _same("conv", "to", "c", "i"), "left")
        step = step.select("conv", "id", F.coalesce("next", "to").alias("to"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"), F.col("next").isNotNull().alias("moved"))
        step = written(step, "call_leads")
        lead = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    # those that still lead to such a call are on a cycle or after one
    ends = lead.select(F.col("conv").alias("c"), F.col("id").alias("i"))
    lead = written(lead.join(ends, _same("conv", "to", "c", "i"), "left_anti"), "call_leads") if rounds else lead

    # calls after several: their edges lead past the chains, a round for each level of such calls
    several = need.where("need > 1").select(F.col("conv").alias("c"), F.col("id").alias("i"), "need")
    if not several.isEmpty():
        past = lead.select(F.col("conv").alias("lc"), F.col("id").alias("li"), "to", "far")
        e = edges.join(several, _same("conv", "id", "c", "i")).join(past, _same("conv", "dep", "lc", "li"), "left")
        e = written(e.select("conv", "id", "need", F.coalesce("to", "dep").alias("to"), (F.coalesce("far", F.lit(0)) + 1).alias("far")), "call_joins")
        front, fronts = known, 0
        while not front.isEmpty():
            k = known.select(F.col("conv").alias("c"), F.col("id").alias("i"), "level")
            met = e.join(k, _same("conv", "to", "c", "i")).groupBy("conv", "id", "need")
            met = met.agg(F.count("*").alias("met"), F.max(F.col("level") + F.col("far")).alias("level")).where("met = need")
            old = known.select(F.col("conv").alias("c"), F.col("id").alias("i"))
            front = written(met.select("conv", "id", "level").join(old, _same("conv", "id", "c", "i"), "left_anti"), "call_front")
            known, fronts = known.unionByName(front), fronts + 1
            if fronts % FRONTS == 0:
                known = written(known, "call_levels")
    k = known.select(F.col("conv").alias("c"), F.col("id").alias("i"), "level")
    chained = lead.join(k, _same("conv", "to", "c", "i")).select("conv", "id", (F.col("level") + F.col("far")).alias("level"))
    return known.unionByName(chained)


def linked_chats(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, turn, level, place, role, kind, call_id, linked, errors, json), a row per call, result and message."""
    m = messages.select(
        messages["conv_id"].alias("conv"), messages["turn"].alias("turn"), messages["role"].alias("role"),
        F.when(messages["role"].isin("assistant", "tool") & _is_object(messages["text"]), plain_numbers(messages["text"])).otherwise(messages["text"]).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    m = m.withColumn("object", F.when(F.col("role").isin("assistant", "tool"), _is_object(F.col("text"))).otherwise(False))
    m = m.withColumn("c", F.when(F.col("object") & (F.col("role") == "assistant"), F.from_json("text", CALLS)))
    m = m.withColumn("r", F.when(F.col("object") & (F.col("role") == "tool"), F.from_json("text", RESULT)))
    has_calls = F.coalesce(F.size("c.tool_calls") > 0, F.lit(False))
    is_result = F.coalesce(F.col("r.tool_call_id").isNotNull(), F.lit(False))
    m = written(m.withColumn("kind", F.when(has_calls, "calls").when(is_result, "result").otherwise("message")), "chat")

    calls = m.where("kind = 'calls'").select("conv", "turn", "row", F.posexplode("c.tool_calls").alias("place", "x"))
    calls = calls.select("conv", "turn", "row", "place", "x.id", "x.name", "x.arguments", F.coalesce("x.after", F.array().cast("array<string>")).alias("after"))
    spot = F.struct("turn", "row", "place")
    first = calls.where("id IS NOT NULL").groupBy("conv", "id").agg(F.min(F.struct("turn", "row", "place", "after")).alias("f"))
    first = written(first.select("conv", "id", F.col("f.turn").alias("turn"), F.col("f.row").alias("row"), F.col("f.place").alias("place"), F.col("f.after").alias("after")), "calls")
    level = levels(first.select("conv", "id", "after"))

    results = m.where("kind = 'result'").select("conv", "turn", "row", F.col("r.tool_call_id").alias("id"), F.col("r.content").alias("content"))
    f = first.select(F.col("conv").alias("fc"), F.col("id").alias("fi"), F.col("turn").alias("call_turn"), F.struct("turn", "row", "place").alias("call_spot"))
    answered = results.join(f, results["conv"].eqNullSafe(F.col("fc")) & (results["id"] == F.col("fi")) & (F.col("turn") > F.col("call_turn")))
    answered = answered.groupBy("conv", "id").agg(F.min(F.struct("turn", "row")).alias("answer"))
    order = f.join(answered.select(F.col("conv").alias("ac"), F.col("id").alias("ai"), "answer"), F.col("fc").eqNullSafe(F.col("ac")) & (F.col("fi") == F.col("ai")), "left")
    order = order.join(level.select(F.col("conv").alias("lc"), F.col("id").alias("li"), "level"), F.col("fc").eqNullSafe(F.col("lc")) & (F.col("fi") == F.col("li")), "left")
    order = written(order.select("fc", "fi", "call_turn", "call_spot", "answer", "level"), "call_order")

    def line(**fields: Column) -> Column:
        """Canonical JSON of an object: keys sorted, nulls left out."""
        return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))

    checked = validated(calls, schemas)
    c = checked.join(order, checked["conv"].eqNullSafe(F.col("fc")) & (F.col("id") == F.col("fi")), "left")
    chosen = F.coalesce(F.col("call_spot") == spot, F.lit(False))
    json_args = parsed(F.col("arguments"))
    raw = F.when(json_args.isNull(), F.col("arguments"))
    call_rows = c.select(
        F.col("conv").alias("conv_id"), "turn", F.when(chosen, F.coalesce("level", F.lit(-1))).otherwise(-1).alias("level"), "place",
        F.lit("assistant").alias("role"), F.when(chosen | F.col("id").isNull(), "call").otherwise("repeated").alias("kind"),
        F.col("id").alias("call_id"), (chosen & F.col("answer").isNotNull()).alias("linked"), "errors",
        line(arguments=json_args, arguments_text=raw, id=F.col("id"), name=F.col("name"), type=F.lit("call")).alias("json"),
    )
    r = results.join(order, results["conv"].eqNullSafe(F.col("fc")) & (results["id"] == F.col("fi")), "left")
    answers = F.coalesce(F.col("answer") == F.struct("turn", "row"), F.lit(False))
    nothing = F.lit(None).cast("array<string>")
    result_rows = r.select(
        F.col("conv").alias("conv_id"), "turn", F.when(answers, F.coalesce("level", F.lit(-1))).otherwise(-1).alias("level"), F.lit(0).alias("place"),
        F.lit("tool").alias("role"), F.lit("result").alias("kind"), F.col("id").alias("call_id"), answers.alias("linked"), nothing.alias("errors"),
        line(content=F.col("content"), id=F.col("id"), type=F.lit("result")).alias("json"),
    )
    # a message with calls keeps its own words as a message before them
    words = m.where("kind = 'message' OR kind = 'calls' AND c.content IS NOT NULL")
    content = F.when(F.col("kind") == "calls", F.col("c.content")).otherwise(F.col("text"))
    message_rows = words.select(
        F.col("conv").alias("conv_id"), "turn", F.lit(-1).alias("level"), F.lit(-1).alias("place"), "role",
        F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.lit(False).alias("linked"), nothing.alias("errors"),
        line(content=content, role=F.col("role"), type=F.lit("message")).alias("json"),
    )
    return call_rows.unionByName(result_rows).unionByName(message_rows)
