"""Tool calls of chats linked to their results, in DataFrame functions only.

Messages have (conv_id, turn, role, text). An assistant's text may be a JSON object with ``tool_calls``, a list of (id, name, arguments,
after), where ``after`` names the call whose result this one needs; a tool's text is one with ``tool_call_id`` and ``content``. All
other messages are plain. Texts are parsed once, and what is parsed is kept.

* Calls and results are joined by conversation and identifier.
* The level of a call is the number of calls it depends on, one after the other, found by pointer doubling: every round
  jumps twice as far along ``after``, so that a chain of any length needs as many rounds as its length has bits. Calls are ordered by the
  latest turn among themselves and what they depend on, then level, turn and identifier. A call never stands before one it needs.
* Arguments are validated against the tool's schema: required arguments, their types, none that is not in the schema.
* What comes out is canonical JSON: keys in order, no white space, null fields left out.

Nothing that is said is lost: content and further fields beside an assistant's calls come out as a ``message`` of their own, those of a
result as ``more`` with it. A ``role`` among them is called ``text_role``.

Work that needs a conversation's calls in order runs over blocks of turns, so a conversation may hold any share of the rows.

Defined cases: a null or empty text is a plain message with that content. Of several calls with one identifier the first (by turn, row and
place) is linked, ``copies`` says how many there are; each of the others is a ``call`` with the error ``repeated id``, without result or
position. A call without identifier is one of its own, with the error ``no id``; it can depend on others. The first result of a call is
linked; each further one is a ``result`` with the error ``repeated result``. A call without a result has none in its JSON. Every
result without a call is an ``orphan``. Dependencies on unknown calls are ignored; calls in or behind a cycle have level and position
null and the error ``cycle``. A null conversation is one of its own; a null name is an error of the call. Equal rows are rows of their own.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep

CALLS = "tool_calls array<struct<id string, name string, arguments string, after string>>"
RESULT = "tool_call_id string, content string"
#: Turns of a block when positions are counted.
BLOCK_TURNS = 512

#: Types of arguments, by the names that schemas give them, and what the values are called here.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "number": ("BIGINT", "DOUBLE", "DECIMAL")}
Schema = Mapping[str, tuple[str, bool]]


def quoted(text: Column) -> Column:
    """A string as JSON, null for null."""
    inside = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(inside, F.lit(2), F.length(inside) - 2))


def errors(name: Column, arguments: Column, parsed: Column, schemas: Mapping[str, Schema]) -> Column:
    """Comma-joined faults of a call's arguments, empty if there are none."""
    known = F.lit(None).cast("string")
    for tool, schema in schemas.items():
        faults = []
        for argument, (kind, required) in sorted(schema.items()):
            value = F.schema_of_variant(F.try_variant_get(parsed, f"$.{argument}", "variant"))
            absent = value.isNull() | (value == "VOID")
            right = F.lit(False)
            for start in TYPES[kind]:
                right = right | value.startswith(start)
            faults.append(
                F.when(absent, F.lit(f"missing {argument}") if required else None).when(~right, F.lit(f"{argument} is no {kind}"))
            )
        keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
        beyond = F.array_except(keys, F.array(*[F.lit(a) for a in schema]))
        other = F.when(F.size(beyond) > 0, F.concat(F.lit("unexpected "), F.array_join(F.array_sort(beyond), " ")))
        known = F.when(name == tool, F.concat_ws(",", *faults, other)).otherwise(known)
    bad = F.when(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"), "arguments are no object")
    return F.coalesce(F.when(name.isNull(), "no name"), bad, known, F.lit("unknown tool"))


def levels(calls: DataFrame) -> DataFrame:
    """(conv, id, level, ready) from (conv, id, turn, after); level and ready are null on and behind cycles."""
    same = lambda a, b: F.expr(f"{a}.conv <=> {b}.conv")
    # A dependency that does not exist is none.
    exists = calls.select("conv", F.col("id").alias("known"))
    state = calls.alias("a").join(exists.alias("b"), same("a", "b") & (F.col("a.after") == F.col("b.known")), "left")
    state = keep(
        state.select(
            "a.conv", "a.id", F.col("known").alias("jump"), F.when(F.col("known").isNotNull(), 1).otherwise(0).alias("level"),
            F.col("a.turn").alias("ready"),
        ),
        "levels",
    )
    rounds = max(state.count(), 1).bit_length() + 1
    for _ in range(rounds):
        if not state.where(F.col("jump").isNotNull()).limit(1).count():
            break
        parent = state.select("conv", F.col("id").alias("pid"), F.col("jump").alias("next"), F.col("level").alias("above"), F.col("ready").alias("since"))
        state = keep(
            state.alias("a").join(parent.alias("b"), same("a", "b") & (F.col("a.jump") == F.col("b.pid")), "left").select(
                "a.conv", "a.id", F.col("b.next").alias("jump"),
                (F.col("a.level") + F.coalesce("b.above", F.lit(0))).alias("level"),
                F.greatest("a.ready", "b.since").alias("ready"),
            ),
            "levels",
        )
    done = F.col("jump").isNull()
    return state.select("conv", "id", F.when(done, F.col("level")).alias("level"), F.when(done, F.col("ready")).alias("ready"))


def positions(ordered: DataFrame) -> DataFrame:
    """(conv, id, level, position) from (conv, id, turn, level, ready); positions count from 0 in every conversation."""
    blocks = keep(
        ordered.where(F.col("level").isNotNull()).withColumn("block", F.floor(F.coalesce("ready", F.lit(-1)) / BLOCK_TURNS)), "ordered"
    )
    counted = blocks.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("block")) - F.col("n")
    starts = counted.select(F.col("conv").alias("c"), F.col("block").alias("b"), before.alias("start"))
    place = F.row_number().over(Window.partitionBy("conv", "block").orderBy("ready", "level", "turn", "id")) - 1
    placed = blocks.withColumn("place", place)
    return placed.join(starts, F.expr("conv <=> c and block = b")).select(
        "conv", "id", "level", (F.col("start") + F.col("place")).alias("position")
    )


def beside(parsed: Column, *known: str, role: Column | None = None) -> Column:
    """Canonical JSON fields of an object that are not ``known``, comma-joined, with the ``role`` among them; null if there are none."""
    fields = F.map_filter(
        F.try_variant_get(parsed, "$", "map<string,variant>"),
        lambda k, v: ~k.isin(*known) & v.isNotNull() & (F.schema_of_variant(v) != "VOID"),
    )
    named = lambda k: F.when(k == "role", F.lit("text_role")).otherwise(k)
    each = F.transform(
        F.map_keys(fields), lambda k: F.struct(named(k).alias("k"), F.concat(quoted(named(k)), F.lit(":"), F.to_json(F.element_at(fields, k))).alias("j"))
    )
    if role is not None:
        each = F.concat(each, F.array(F.struct(F.lit("role").alias("k"), F.concat(F.lit('"role":'), quoted(role)).alias("j"))))
    return F.when(F.size(fields) > 0, F.array_join(F.array_sort(each)["j"], ","))


def link(messages: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """(conv_id, turn, kind, call_id, level, position, copies, error, json): one row per call, further or orphan result, and message."""
    is_assistant, is_tool = F.col("role") == "assistant", F.col("role") == "tool"
    given = F.when(is_assistant | is_tool, F.try_parse_json(F.col("text")))
    whole = messages.select(
        F.col("conv_id").alias("conv"), "turn", "role", "text", given.alias("given"),
        F.when(is_assistant, F.from_json("text", CALLS)["tool_calls"]).alias("calls"),
        F.when(is_tool, F.from_json("text", RESULT)).alias("result"),
    )
    is_call = F.coalesce(F.size("calls") > 0, F.lit(False))
    is_result = F.coalesce(F.col("result")["tool_call_id"].isNotNull(), F.lit(False))
    rows = keep(
        whole.withColumns({"is_call": is_call, "is_result": is_result}).select(
            "conv", "turn", "role", "calls", "result", "is_call", "is_result", F.monotonically_increasing_id().alias("n"),
            F.when(~is_call & ~is_result, F.col("text")).alias("text"),
            F.when(is_call, beside(F.col("given"), "tool_calls", role=F.col("role"))).when(is_result, beside(F.col("given"), "tool_call_id", "content")).alias("more"),
        ),
        "messages",
    )

    # calls: the first of each identifier, and those without one, have a key and are linked
    exploded = rows.where("is_call").select("conv", "turn", "n", F.posexplode("calls").alias("place", "call")).select("conv", "turn", "n", "place", "call.*")
    firsts = exploded.where("id is not null").groupBy("conv", "id").agg(
        F.min(F.struct("turn", "n", "place")).alias("f"), F.count(F.lit(1)).alias("copies")
    )
    known = firsts.select(F.col("conv").alias("fconv"), F.col("id").alias("fid"), F.col("f.n").alias("fn"), F.col("f.place").alias("fplace"), "copies")
    met = exploded.join(known, F.expr("conv <=> fconv and id = fid"), "left")
    is_first = F.coalesce((F.col("n") == F.col("fn")) & (F.col("place") == F.col("fplace")), F.col("id").isNull())
    own = F.concat(F.lit("n"), F.col("n").cast("string"), F.lit("-"), F.col("place").cast("string"))
    calls = keep(
        met.select(
            "conv", "turn", "id", "name", "arguments", "after",
            F.when(is_first, F.coalesce(F.concat(F.lit("i"), F.col("id")), own)).alias("key"),
            F.when(is_first, F.coalesce("copies", F.lit(1))).otherwise(1).cast("long").alias("copies"),
        ),
        "calls",
    )

    # Order is worked out on keys alone; texts move once, to meet their results.
    slim = calls.where("key is not null").select("conv", F.col("key").alias("id"), "turn", F.concat(F.lit("i"), F.col("after")).alias("after"))
    found = levels(slim)
    ordered = slim.alias("a").join(found.alias("b"), F.expr("a.conv <=> b.conv and a.id <=> b.id")).select("a.conv", "a.id", "a.turn", "b.level", "b.ready")
    placed = positions(ordered).select(F.col("conv").alias("pconv"), F.col("id").alias("pid"), "level", "position")

    # results: the first of each identifier is linked, if there is such a call
    answers = rows.where("is_result").select(
        F.col("conv").alias("rconv"), F.col("turn").alias("rturn"), F.col("n").alias("rn"), F.col("more").alias("rmore"),
        F.col("result")["tool_call_id"].alias("rid"), F.col("result")["content"].alias("content"),
    )
    earliest = answers.groupBy("rconv", "rid").agg(F.min(F.struct("rturn", "rn")).alias("e"), F.count(F.lit(1)).alias("replies")).select(
        F.col("rconv").alias("econv"), F.col("rid").alias("eid"), F.col("e.rn").alias("en"), "replies"
    )
    asked = firsts.select(F.col("conv").alias("aconv"), F.col("id").alias("aid"))
    both = earliest.join(asked, F.expr("econv <=> aconv and eid = aid"), "left").withColumn("answers", F.col("aid").isNotNull()).drop("aconv", "aid")
    results = answers.join(both, F.expr("rconv <=> econv and rid = eid"))
    linked_results = results.where("answers and rn = en").select("rconv", "rid", "rturn", "content", "rmore")
    other_results = results.where("not (answers and rn = en)")

    joined = calls.join(linked_results, F.expr("key is not null and conv <=> rconv and id = rid"), "left").join(
        placed, F.expr("conv <=> pconv and key = pid"), "left"
    )
    parsed = F.try_parse_json(F.col("arguments"))
    wrong = errors(F.col("name"), F.col("arguments"), parsed, schemas)
    fault = F.concat_ws(
        ",",
        F.when(F.col("id").isNull(), "no id"),
        F.when(F.col("key").isNull(), "repeated id").when(F.col("level").isNull(), "cycle"),
        F.when(wrong != "", wrong),
    )
    content = F.concat(F.lit('"content":'), quoted(F.coalesce("content", F.lit(""))))
    more = F.concat(F.lit('"more":{'), F.col("rmore"), F.lit("}"))
    reply = F.concat(
        F.lit('"result":{'), F.concat_ws(",", content, more, F.concat(F.lit('"turn":'), F.col("rturn").cast("string"))), F.lit("}")
    )
    fields = F.concat_ws(
        ",",
        F.concat(F.lit('"arguments":'), F.coalesce(F.to_json(parsed), quoted(F.col("arguments")))),
        F.concat(F.lit('"id":'), quoted(F.col("id"))),
        F.concat(F.lit('"name":'), quoted(F.col("name"))),
        F.when(F.col("rid").isNotNull(), reply),
    )
    linked = joined.select(
        F.col("conv").alias("conv_id"), "turn", F.lit("call").alias("kind"), F.col("id").alias("call_id"),
        F.col("level").cast("long").alias("level"), F.col("position").cast("long").alias("position"), "copies", fault.alias("error"),
        F.concat(F.lit("{"), fields, F.lit("}")).alias("json"),
    )
    none = F.lit(None)
    is_repeat = F.col("rn") != F.col("en")
    rest = other_results.select(
        F.col("rconv").alias("conv_id"), F.col("rturn").alias("turn"), F.when(F.col("answers"), "result").otherwise("orphan").alias("kind"),
        F.col("rid").alias("call_id"), none.cast("long").alias("level"), none.cast("long").alias("position"),
        F.when(is_repeat, 1).otherwise(F.col("replies")).cast("long").alias("copies"),
        F.when(is_repeat, "repeated result").otherwise("").alias("error"),
        F.concat(
            F.lit("{"), F.concat_ws(",", content, more, F.lit('"role":"tool"'), F.concat(F.lit('"tool_call_id":'), quoted(F.col("rid")))), F.lit("}")
        ).alias("json"),
    )
    role = F.concat(F.lit('"role":'), quoted(F.col("role")))
    said = F.concat_ws(",", F.concat(F.lit('"content":'), quoted(F.col("text"))), role)
    plain = rows.where("not is_result and (not is_call or more is not null)").select(
        F.col("conv").alias("conv_id"), "turn", F.lit("message").alias("kind"), none.cast("string").alias("call_id"),
        none.cast("long").alias("level"), none.cast("long").alias("position"), F.lit(1).cast("long").alias("copies"), F.lit("").alias("error"),
        F.concat(F.lit("{"), F.when(F.col("is_call"), F.col("more")).otherwise(said), F.lit("}")).alias("json"),
    )
    return linked.unionByName(rest).unionByName(plain)


#: The tool that stands for the other side of a chat, and its schema.
REPLY = {"reply": {"prompt": ("string", True), "turn": ("integer", True), "model": ("string", False)}}


def as_tool_traffic(conversations: DataFrame) -> DataFrame:
    """Chats retold as tool traffic: a user's turn calls ``reply``, after the call two turns before; the turn that follows is the result.

    Where three divides the turn, the call comes with content and a note; where five does, its turn is a text, against the schema.
    """
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn = F.col("turn")
    call = F.struct(
        name(turn).alias("id"),
        F.lit("reply").alias("name"),
        F.when(turn % 5 == 0, F.to_json(F.struct(F.col("text").alias("prompt"), turn.cast("string").alias("turn"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("prompt"), turn.alias("turn"))))
        .alias("arguments"),
        F.when(turn >= 2, name(turn - 2)).alias("after"),
    )
    # Nested JSON text is put in as it is, so arguments are an object and not a string.
    head = F.to_json(F.struct(call.getField("after").alias("after"), call.getField("id").alias("id"), call.getField("name").alias("name")))
    beside_calls = F.when(turn % 3 == 0, F.concat(F.lit('"note":{"z":1,"a":null},"content":'), quoted(F.col("text")), F.lit(",")))
    calls = F.concat(
        F.lit("{"), F.coalesce(beside_calls, F.lit("")), F.lit('"tool_calls":[{"arguments":'), call.getField("arguments"), F.lit(","), F.substring(head, F.lit(2), F.length(head)), F.lit("]}")
    )
    result = F.to_json(F.struct(F.col("text").alias("content"), name(turn - 1).alias("tool_call_id")))
    return conversations.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", calls).when(F.col("role") == "assistant", result).otherwise(F.col("text")).alias("text"),
    )


ORACLE_SQL = """
with called as (
  select conv_id, turn, text, 'c' || conv_id || '-' || turn as id from conversations where role = 'user'
), replied as (
  select conv_id, turn, text, 'c' || conv_id || '-' || (turn - 1) as id from conversations where role = 'assistant'
), recursive_levels as (
  select a.conv_id, a.id, a.turn,
    -- the chain of turns two apart that leads to this call
    a.turn - max(b.turn) filter (b.broken) as span
  from called a join (
    select c.conv_id, c.turn, p.id is null as broken from called c left join called p on p.conv_id = c.conv_id and p.turn = c.turn - 2
  ) b on b.conv_id = a.conv_id and b.turn <= a.turn and (a.turn - b.turn) % 2 = 0
  group by a.conv_id, a.id, a.turn
)
select c.conv_id, c.turn, 'call' as kind, c.id as call_id, (span // 2)::bigint as level,
  (row_number() over (partition by c.conv_id order by c.turn) - 1)::bigint as position, 1::bigint as copies,
  concat_ws(',', case when c.text is null then 'missing prompt' end, case when c.turn % 5 = 0 then 'turn is no integer' end) as error,
  '{"arguments":{' || case when c.text is null then '' else '"prompt":' || to_json(c.text)::varchar || ',' end || '"turn":' ||
    case when c.turn % 5 = 0 then '"' || c.turn || '"' else c.turn::varchar end || '},"id":"' || c.id || '","name":"reply"' ||
    case when r.id is null then '' else ',"result":{"content":' || to_json(coalesce(r.text, ''))::varchar || ',"turn":' || r.turn || '}' end || '}' as json
from called c join recursive_levels l using (conv_id, id) left join replied r on r.conv_id = c.conv_id and r.id = c.id
union all
select r.conv_id, r.turn, 'orphan', r.id, null, null, 1, '',
  '{"content":' || to_json(coalesce(r.text, ''))::varchar || ',"role":"tool","tool_call_id":"' || r.id || '"}'
from replied r where not exists (select 1 from called c where c.conv_id = r.conv_id and c.id = r.id)
union all
select conv_id, turn, 'message', null, null, null, 1, '',
  '{"content":' || to_json(text)::varchar || ',"note":{"a":null,"z":1},"role":"assistant"}'
from called where turn % 3 = 0 and text is not null
union all
select conv_id, turn, 'message', null, null, null, 1, '',
  '{' || case when text is null then '' else '"content":' || to_json(text)::varchar || ',' end || '"role":' || to_json(role)::varchar || '}'
from conversations where role not in ('user', 'assistant')
"""
