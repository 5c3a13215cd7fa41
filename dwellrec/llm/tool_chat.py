"""Chat formatting: tool calls linked to their results.

Input is a log of events, one row each:

  conv_id, position   conversation, and the place in its log
  kind                'call', 'result' or 'message'
  call_id             identifier of a call; for a result, of the call it answers
  name, arguments     of a call: the tool and a JSON text
  after               of a call: identifiers whose results it needs
  role, content       of a message or result

1. Linking: identifiers are counted per conversation (calls, results, first of
   each) and joined back by hash.
2. Order: a result follows its call, and a call the results it needs. Every
   event's key (place, depth) starts as (position, 0); along every edge that
   the keys violate, the later event is raised to just behind the earlier one,
   until no edge is violated. A conversation in order is left alone; one of up
   to ``LOCAL_EDGES`` edges is settled in memory inside a task. A longer one is cut,
   along the places of its calls, in pieces of that many edges, which are settled
   in memory and hand raised keys to each other by joins: a round for each change
   of piece along a chain, not for each step. Events on or behind a cycle would
   rise for ever: they are told by a depth above the number of events moved, or by
   more rounds than pieces have events to hand on, flagged, and keep their place.
3. Validation: a call's arguments are checked against its tool's JSON schema
   (``KEYWORDS``). A schema with another keyword, an unknown type or a broken
   pattern is refused: its calls are invalid, with the reason in ``errors``.
4. Every event becomes one canonical JSON line: sorted keys, no white space,
   integral floats written as integers.

Positions in the final order are counted over a range-partitioned sort, so a
conversation of any length is not held by one task.

Status: 'ok', 'unanswered' (call without result), 'orphan' (result without a
call), 'duplicate' (a later call or result for an identifier that has one),
'cyclic'. Defined results: events with a null identifier are unlinked (a call
is unanswered, a result an orphan); null conversations are one conversation;
events other than calls are valid; arguments that are null or no JSON (NaN and
Infinity included), that nest deeper than ``DEPTH`` or hold a number beyond a
double's range or of over 4,000 digits are invalid and serialised as a JSON string
or null; lone surrogates stay escaped; unknown tools are invalid; of several schemas
of one tool the least text counts; repeated rows are duplicates; rows of unknown kind are messages; an empty log
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import join_groups, ordinal
from dwellrec.session import materialize

LOCAL_EDGES = 10_000
VIOLATED = "sp > dp or (sp = dp and sd >= dd)"
ENDLESS = (1 << 30) - 1        # depth of events on or behind a cycle
DEPTH = 100
_TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None),
          "integer": None, "number": None}
KEYWORDS = frozenset((
    "type enum const allOf anyOf oneOf not minLength maxLength pattern minimum maximum exclusiveMinimum "
    "exclusiveMaximum multipleOf properties required additionalProperties minProperties maxProperties "
    "items minItems maxItems uniqueItems").split())
NOTES = frozenset("title description default examples $schema $id $comment deprecated readOnly writeOnly".split())
_SURROGATE = re.compile("[\ud800-\udfff]")


class Unfit(ValueError):
    """JSON that is not taken: the reason."""


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, (int, float)):
            return False
        return kind == "number" or isinstance(value, int) or value.is_integer()
    return isinstance(value, _TYPES[kind])


def schema_faults(schema, at: str = "schema") -> list[str]:
    """Why a schema is refused."""
    if isinstance(schema, bool):
        return []
    if not isinstance(schema, dict):
        return [f"{at}: not an object"]
    out = [f"{at}: unknown keyword {k}" for k in sorted(schema) if k not in KEYWORDS and k not in NOTES]

    def check(key, fine, what):
        if key in schema and not fine(schema[key]):
            out.append(f"{at}.{key}: {what}")

    def number(x):
        return _is(x, "number")

    def text(x):
        return isinstance(x, str)

    check("type", lambda x: (text(x) and x in _TYPES) or (isinstance(x, list) and x and all(
        text(y) and y in _TYPES for y in x)), "unknown type")
    check("enum", lambda x: isinstance(x, list), "not a list")
    check("required", lambda x: isinstance(x, list) and all(map(text, x)), "not a list of names")
    check("uniqueItems", lambda x: isinstance(x, bool), "not true or false")
    check("multipleOf", lambda x: number(x) and x > 0, "not a positive number")
    for key in ("minLength", "maxLength", "minItems", "maxItems", "minProperties", "maxProperties"):
        check(key, lambda x: _is(x, "integer") and x >= 0, "not a count")
    for key in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
        check(key, number, "not a number")
    if "pattern" in schema:
        try:
            re.compile(schema["pattern"])
        except (re.error, TypeError):
            out.append(f"{at}.pattern: not a pattern")
    for key in ("allOf", "anyOf", "oneOf"):
        check(key, lambda x: isinstance(x, list) and x, "not a list of schemas")
    check("properties", lambda x: isinstance(x, dict), "not an object")
    inner = [(key, x) for key in ("allOf", "anyOf", "oneOf") if isinstance(schema.get(key), list)
             for x in schema[key]]
    inner += [(key, schema[key]) for key in ("not", "items", "additionalProperties") if key in schema]
    if isinstance(schema.get("properties"), dict):
        inner += sorted(schema["properties"].items())
    for key, x in inner:
        out += schema_faults(x, f"{at}.{key}")
    return out


def schema_errors(value, schema, at: str = "$") -> list[str]:
    """What ``value`` violates of a JSON schema that has no faults."""
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {'/'.join(kinds)}"]
    out = []

    def need(key, broken, what):
        if key in schema and broken(schema[key]):
            out.append(f"{at}: {what}")

    need("enum", lambda x: canonical(value) not in map(canonical, x), "not in enum")
    need("const", lambda x: canonical(value) != canonical(x), "not the constant")
    if isinstance(value, str):
        need("minLength", lambda x: len(value) < x, "too short")
        need("maxLength", lambda x: len(value) > x, "too long")
        need("pattern", lambda x: not re.search(x, value), "not of the pattern")
    if _is(value, "number"):
        need("minimum", lambda x: value < x, "below minimum")
        need("maximum", lambda x: value > x, "above maximum")
        need("exclusiveMinimum", lambda x: value <= x, "not above exclusive minimum")
        need("exclusiveMaximum", lambda x: value >= x, "not below exclusive maximum")
        need("multipleOf", lambda x: value % x != 0, "not a multiple")
    if isinstance(value, dict):
        known, other = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        need("minProperties", lambda x: len(value) < x, "too few properties")
        need("maxProperties", lambda x: len(value) > x, "too many properties")
        for k in sorted(value):
            out += schema_errors(value[k], known.get(k, other), f"{at}.{k}")
    if isinstance(value, list):
        need("minItems", lambda x: len(value) < x, "too few items")
        need("maxItems", lambda x: len(value) > x, "too many items")
        need("uniqueItems", lambda x: x and len(set(map(canonical, value))) < len(value), "items repeat")
        for i, v in enumerate(value):
            out += schema_errors(v, schema.get("items", True), f"{at}[{i}]")
    for x in schema.get("allOf", []):
        out += schema_errors(value, x, at)
    need("anyOf", lambda x: all(schema_errors(value, y, at) for y in x), "matches none of anyOf")
    need("oneOf", lambda x: sum(not schema_errors(value, y, at) for y in x) != 1, "matches not one of oneOf")
    need("not", lambda x: not schema_errors(value, x, at), "matches not")
    return out


def _plain(value):
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e15:
        return int(value)
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def _escaped(text: str) -> str:
    """Lone surrogates, which no UTF-8 text can hold, as JSON escapes."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    return _escaped(json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def _integer(text: str) -> int:
    if len(text) > 4000:
        raise Unfit("number of too many digits")
    return int(text)


def _number(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise Unfit("number out of range")
    return value


def _constant(text: str):
    raise Unfit("not JSON")


def _deep(value, limit: int) -> bool:
    level = [value]
    for _ in range(limit):
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x if isinstance(x, list) else ())]
        if not level:
            return False
    return True


def _parse(text: str | None):
    """(value, error) of a JSON text."""
    try:
        value = json.loads(text, parse_constant=_constant, parse_int=_integer, parse_float=_number)
        if _deep(value, DEPTH):
            raise Unfit("nested too deeply")
        return value, ""
    except Unfit as e:
        return text, f"$: {e}"
    except RecursionError:
        return text, "$: nested too deeply"
    except (TypeError, ValueError):
        return text, "$: not JSON"


@lru_cache(maxsize=1024)
def _schema(text: str):
    """(schema, faults) of a tool's schema text."""
    value, error = _parse(text)
    return value, [f"schema: {error[3:]}"] if error else schema_faults(value)


def _row(kind, call_id, name, arguments, role, content, schema):
    """(canonical line, valid, errors) of one event."""
    if kind == "call":
        value, error = _parse(arguments)
        if error:
            errors = [error]
        elif schema is None:
            errors = ["$: unknown tool"]
        else:
            known, faults = _schema(schema)
            errors = faults or schema_errors(value, known)
        line = {"type": "call", "id": call_id, "name": name, "arguments": value}
        return canonical(line), not errors, _escaped("; ".join(errors))
    if kind == "result":
        return canonical({"type": "result", "call_id": call_id, "content": content}), True, ""
    return canonical({"type": "message", "role": role, "content": content}), True, ""


def _event_ids(log: DataFrame) -> DataFrame:
    conv = F.col("conv_id")
    return materialize(log.select(
        F.monotonically_increasing_id().alias("eid"), conv.alias("conv_id"),
        F.coalesce(F.col("position").cast("bigint"), F.lit(0)).alias("position"),
        F.when(F.col("kind").isin("call", "result"), F.col("kind")).otherwise("message").alias("kind"),
        "call_id", "name", "arguments", "after", "role", "content",
        F.xxhash64(conv, F.lit(3)).alias("ck")), "chat-events")


def _links(events: DataFrame) -> DataFrame:
    """One row per identifier of a conversation: first call, first result."""
    at = F.struct("position", "eid")
    ids = events.where("call_id is not null and kind <> 'message'").select("ck", "call_id", "kind", at.alias("at"))
    return materialize(ids.groupBy("ck", "call_id").agg(
        F.min(F.when(F.col("kind") == "call", F.col("at"))).alias("call"),
        F.min(F.when(F.col("kind") == "result", F.col("at"))).alias("result"),
        F.count("*").alias("n")), "chat-links")


def _edges(events: DataFrame, links: DataFrame) -> DataFrame:
    """(src, sp, sd, dst, dp, dd, ck, at): order constraints with both keys, and the
    place of the call that is (or whose result is) the later event."""
    answered = links.where("call is not null and result is not null").select(
        "ck", F.col("call.eid").alias("src"), F.col("call.position").alias("sp"),
        F.col("result.eid").alias("dst"), F.col("result.position").alias("dp"),
        F.col("call.position").alias("at"))
    needs = events.where("kind = 'call' and after is not null").select(
        "ck", F.explode("after").alias("call_id"), F.col("eid").alias("dst"), F.col("position").alias("dp"))
    sources = links.where("result is not null").select(
        "ck", "call_id", F.col("result.eid").alias("src"), F.col("result.position").alias("sp"))
    needed = needs.join(sources, ["ck", "call_id"]).select(
        "ck", "src", "sp", "dst", "dp", F.col("dp").alias("at"))
    zero = F.lit(0)
    return (answered.unionByName(needed).distinct()
            .withColumn("sd", zero).withColumn("dd", zero))


def settle(conv: np.ndarray, src: np.ndarray, dst: np.ndarray, sp: np.ndarray, dp: np.ndarray):
    """Settles the edges of some whole conversations in memory: arrays (event, place,
    depth, on or behind a cycle) of the events raised."""
    events, at = np.unique(np.concatenate([src, dst]), return_index=True)
    places, rank = np.unique(np.concatenate([sp, dp]), return_inverse=True)
    owner = np.unique(np.concatenate([conv, conv]), return_inverse=True)[1][at]
    s, t = np.searchsorted(events, src), np.searchsorted(events, dst)
    deep = 2 * len(events) + 4                     # above any depth before all cycles are found
    key = rank[at] * deep                          # (place, depth) in one number
    moved, loop = np.zeros(len(events), dtype=bool), np.zeros(len(events), dtype=bool)
    while True:
        up = np.flatnonzero(key[s] >= key[t])
        if not len(up):
            break
        raised = t[up]
        np.maximum.at(key, raised, key[s[up]] + 1)
        moved[raised] = True
        many = np.bincount(owner[moved], minlength=owner.max() + 1)
        loop[raised] |= key[raised] % deep > many[owner[raised]]
        if loop.any():
            s, t = s[~loop[t]], t[~loop[t]]
    out = np.flatnonzero(moved)
    return events[out], places[key[out] // deep], key[out] % deep, loop[out]


def _raised(edges: DataFrame) -> DataFrame:
    """(eid, p, d, loop) of the events that the order moves. Conversations of at
    most ``LOCAL_EDGES`` edges are settled in memory, blocks of them in a task,
    whatever the length of their chains; longer ones in pieces."""
    e = materialize(edges, "chat-edges")
    wrong = F.count_if(F.expr(VIOLATED)).alias("wrong")
    sizes = materialize(e.groupBy("ck").agg(F.count("*").alias("m"), wrong), "chat-edge-counts")
    e = materialize(join_groups(e, sizes.where("wrong > 0"), ["ck"], "m", e.count()), "chat-wrong")
    short = e.where(F.col("m") <= LOCAL_EDGES).select("ck", "src", "dst", "sp", "dp")
    blocks = short.count() // max(1, LOCAL_EDGES) + 1      # of about LOCAL_EDGES edges

    def one(unit: pa.Table) -> pa.Table:
        eid, p, d, loop = settle(*(unit.column(c).to_numpy() for c in ("ck", "src", "dst", "sp", "dp")))
        return pa.table({"eid": pa.array(eid, pa.int64()), "p": pa.array(p, pa.int64()),
                         "d": pa.array(d.astype(np.int32)), "loop": pa.array(loop)})

    small = (short.groupBy(F.pmod(F.xxhash64("ck", F.lit(5)), F.lit(blocks)).alias("block"))
             .applyInArrow(one, "eid long, p long, d int, loop boolean"))
    large = e.where(F.col("m") > LOCAL_EDGES).drop("m", "wrong")
    if not large.isEmpty():
        small = small.unionByName(_in_pieces(large))
    return materialize(small, "chat-settled")


def settle_piece(src: np.ndarray, dst: np.ndarray, sp: np.ndarray, sd: np.ndarray,
                 dp: np.ndarray, dd: np.ndarray):
    """Settles some edges from the keys they hold: arrays (event, place, depth) of the
    events raised. Depth ``ENDLESS`` marks a cycle; it is passed on and never exceeded."""
    events, first = np.unique(np.concatenate([src, dst]), return_index=True)
    places, rank = np.unique(np.concatenate([sp, dp]), return_inverse=True)
    s, t = np.searchsorted(events, src), np.searchsorted(events, dst)
    wide = ENDLESS + 1
    depth = np.concatenate([sd, dd])[first].astype(np.int64)
    key = rank[first] * wide + depth               # (place, depth) in one number
    deepest = depth[depth < ENDLESS].max(initial=0)
    moved = np.zeros(len(events), dtype=bool)
    while True:
        behind = key[s] + (key[s] % wide < ENDLESS)
        up = np.flatnonzero(behind > key[t])
        if not len(up):
            break
        raised = t[up]
        np.maximum.at(key, raised, behind[up])
        moved[raised] = True
        round_again = raised[key[raised] % wide > deepest + moved.sum()]
        key[round_again] += ENDLESS - key[round_again] % wide
    out = np.flatnonzero(moved)
    return events[out], places[key[out] // wide], key[out] % wide


def _in_pieces(e: DataFrame) -> DataFrame:
    """(eid, p, d, loop) of conversations of many edges.

    An event raised in round r has a chain behind it that changed pieces r - 1 times,
    each time at another event of two pieces unless the chain holds a cycle: more
    rounds than such events were moved tell a cycle, so the rounds are bounded by them.
    """
    e = ordinal(e, ["ck", "at", "dst", "src"])
    e = e.select("ck", "src", "sp", "sd", "dst", "dp", "dd", F.col("dp").alias("dp0"),
                 F.floor(F.col("_ix") / F.lit(LOCAL_EDGES)).alias("piece"))
    shared = (e.select("piece", F.explode(F.array("src", "dst")).alias("dst")).groupBy("dst")
              .agg((F.min("piece") < F.max("piece")).alias("shared")))
    e = materialize(e.join(shared, "dst"), "chat-edges")
    wrong, moved = F.expr(f"({VIOLATED}) and (sp > dp or dd < {ENDLESS})"), F.expr("dp <> dp0 or dd <> 0")

    def one(piece: pa.Table) -> pa.Table:
        eid, p, d = settle_piece(*(piece.column(c).to_numpy() for c in ("src", "dst", "sp", "sd", "dp", "dd")))
        return pa.table({"eid": pa.array(eid, pa.int64()), "p": pa.array(p, pa.int64()),
                         "d": pa.array(d.astype(np.int32))})

    rounds = 0
    while True:
        todo = e.where(wrong).select("piece").distinct()
        up = (e.join(todo, "piece", "left_semi").select("piece", "src", "dst", "sp", "sd", "dp", "dd")
              .groupBy("piece").applyInArrow(one, "eid long, p long, d int"))
        up = materialize(up.groupBy("eid").agg(F.max(F.struct("p", "d")).alias("to")), "chat-raised")
        if up.isEmpty():
            break
        handed = e.where(moved & F.col("shared")).groupBy("ck").agg(F.countDistinct("dst").alias("handed"))
        cyclic = F.lit(rounds) > F.coalesce("handed", F.lit(0))
        to = up.select("eid", F.col("to.p").alias("np"), F.col("to.d").alias("nd"))
        e = e.join(handed, "ck", "left")
        for end in ("s", "d"):
            nd = F.when(F.col("np").isNotNull() & cyclic, F.lit(ENDLESS)).otherwise(F.col("nd"))
            e = (e.join(to.withColumnRenamed("eid", "src" if end == "s" else "dst"), "src" if end == "s" else "dst", "left")
                 .withColumn(f"{end}d", F.coalesce(nd, f"{end}d"))
                 .withColumn(f"{end}p", F.coalesce("np", f"{end}p")).drop("np", "nd"))
        e = materialize(e.drop("handed"), "chat-edges")
        rounds += 1
    return (e.where(moved).select(F.col("dst").alias("eid"), F.col("dp").alias("p"), F.col("dd").alias("d"))
            .distinct().withColumn("loop", F.col("d") == ENDLESS))


def format_log(log: DataFrame, tools: DataFrame) -> DataFrame:
    """log as above, tools (name, schema JSON) → one row per event: conv_id,
    seq, position, kind, call_id, status, valid, errors, line."""
    events = _event_ids(log)
    links = _links(events)
    in_link = F.col("call_id").isNotNull() & (F.col("kind") != "message")
    linked = join_groups(events.where(in_link), links, ["ck", "call_id"], "n", events.count())
    mine, other = (F.when(F.col("kind") == "call", F.col(a)).otherwise(F.col(b))
                   for a, b in (("call", "result"), ("result", "call")))
    linked = linked.withColumn("status", F.when(mine["eid"] != F.col("eid"), "duplicate")
                               .when(other.isNotNull(), "ok")
                               .when(F.col("kind") == "call", "unanswered").otherwise("orphan"))
    plain = events.where(~in_link).withColumn(
        "status", F.when(F.col("kind") == "call", "unanswered").when(F.col("kind") == "result", "orphan")
        .otherwise("ok"))
    cols = [*events.columns, "status"]
    all_events = linked.select(*cols).unionByName(plain.select(*cols))
    to = _raised(_edges(events, links)).toDF("eid", "mp", "md", "loop")
    stays = F.col("mp").isNull() | F.col("loop")          # not moved, or moved for ever
    all_events = (all_events.join(to, "eid", "left")
                  .withColumn("p", F.when(stays, F.col("position")).otherwise(F.col("mp")))
                  .withColumn("d", F.when(stays, F.lit(0)).otherwise(F.col("md")))
                  .withColumn("status", F.when(F.col("loop"), "cyclic").otherwise(F.col("status"))))
    checked = _serialised(all_events.select(*cols, "p", "d").join(
        tools.groupBy("name").agg(F.min("schema").alias("tool_schema")), "name", "left"))
    placed = ordinal(materialize(checked, "chat-lines"), ["ck", "p", "d", "position", "eid"])
    first = placed.groupBy("ck").agg(F.min("_ix").alias("lo"), F.count("*").alias("n"))
    placed = join_groups(placed, materialize(first, "chat-starts"), ["ck"], "n", placed.count())
    return placed.select("conv_id", (F.col("_ix") - F.col("lo")).alias("seq"), "position", "kind",
                         "call_id", "status", "valid", "errors", "line")


def _serialised(events: DataFrame) -> DataFrame:
    keep = ["ck", "p", "d", "position", "eid", "conv_id", "kind", "call_id", "status"]
    text = ["kind", "call_id", "name", "arguments", "role", "content", "tool_schema"]
    src = events.select(*keep, *[F.col(c).cast("string").alias(f"t_{c}") for c in text])
    schema = src.select(*keep).schema.add("line", "string").add("valid", "boolean").add("errors", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_row(*r) for r in zip(*(b.column(f"t_{c}").to_pylist() for c in text))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.bool_()), pa.array([g[2] for g in got], pa.string())],
                names=schema.names)

    return src.mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# The conversations table as a tool log: a user's turn calls the tool 'reply',
# the assistant's next turn is the result. Every third conversation was logged
# results first.
# ---------------------------------------------------------------------------
MAX_WORDS = 40
REPLY_SCHEMA = {
    "type": "object",
    "required": ["prompt", "words"],
    "properties": {"prompt": {"type": "string", "minLength": 1},
                   "words": {"type": "integer", "minimum": 1, "maximum": MAX_WORDS},
                   "turn": {"type": "integer", "minimum": 0}},
    "additionalProperties": False,
}


def tool_log(conversations: DataFrame) -> DataFrame:
    user, reply = F.col("role") == "user", F.col("role") == "assistant"
    late = F.col("conv_id") % 3 == 0

    def call(turn):
        return F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    words = F.size(F.split("text", " "))
    arguments = F.to_json(F.struct(F.col("turn"), words.alias("words"), F.col("text").alias("prompt")))
    return conversations.select(
        "conv_id",
        F.when(late & user, F.col("turn") + 1).when(late & reply, F.col("turn") - 1)
        .otherwise(F.col("turn")).alias("position"),
        F.when(user, "call").when(reply, "result").otherwise("message").alias("kind"),
        F.when(user, call(F.col("turn"))).when(reply, call(F.col("turn") - 1)).alias("call_id"),
        F.when(user, "reply").alias("name"), F.when(user, arguments).alias("arguments"),
        F.when(user & (F.col("turn") >= 2), F.array(call(F.col("turn") - 2))).alias("after"),
        "role", F.col("text").alias("content"))


def reply_tools(spark) -> DataFrame:
    return spark.createDataFrame([("reply", json.dumps(REPLY_SCHEMA))], "name string, schema string")


def tool_log_sql(conversations: str = "conversations") -> str:
    """``format_log(tool_log(conversations), reply_tools)`` for unique turns."""
    return f"""
WITH c AS (SELECT *, role = 'user' AS u, role = 'assistant' AS a FROM {conversations}),
e AS (SELECT c.*, x.turn IS NOT NULL AS linked,
        CASE WHEN c.conv_id % 3 = 0 AND u THEN c.turn + 1 WHEN c.conv_id % 3 = 0 AND a THEN c.turn - 1
             ELSE c.turn END AS position,
        CASE WHEN u THEN 'call' WHEN a THEN 'result' ELSE 'message' END AS kind,
        CASE WHEN u THEN concat('call-', c.conv_id, '-', c.turn)
             WHEN a THEN concat('call-', c.conv_id, '-', c.turn - 1) END AS call_id,
        len(string_split(text, ' ')) AS words
      FROM c LEFT JOIN (SELECT conv_id, turn, role FROM {conversations}) x ON x.conv_id = c.conv_id
        AND ((u AND x.turn = c.turn + 1 AND x.role = 'assistant')
          OR (a AND x.turn = c.turn - 1 AND x.role = 'user'))),
k AS (SELECT *, CASE WHEN kind = 'result' AND linked THEN greatest(position, CASE WHEN conv_id % 3 = 0
        THEN turn ELSE turn - 1 END) ELSE position END AS p,
        CASE WHEN kind = 'result' AND linked AND conv_id % 3 = 0 THEN 1 ELSE 0 END AS d FROM e)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY p, d, position) - 1 AS BIGINT) AS seq,
  position, kind, coalesce(call_id, '') AS call_id,
  CASE WHEN kind = 'message' OR linked THEN 'ok' WHEN u THEN 'unanswered' ELSE 'orphan' END AS status,
  NOT u OR (words <= {MAX_WORDS} AND text <> '') AS valid,
  CASE WHEN u THEN concat_ws('; ', CASE WHEN text = '' THEN '$.prompt: too short' END,
    CASE WHEN words > {MAX_WORDS} THEN '$.words: above maximum' END) ELSE '' END AS errors,
  CAST(CASE WHEN u THEN json_object('arguments', json_object('prompt', text, 'turn', turn, 'words', words),
         'id', call_id, 'name', 'reply', 'type', 'call')
       WHEN a THEN json_object('call_id', call_id, 'content', text, 'type', 'result')
       ELSE json_object('content', text, 'role', role, 'type', 'message') END AS VARCHAR) AS line
FROM k
"""
