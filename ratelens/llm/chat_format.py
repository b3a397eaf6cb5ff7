"""Chat formatting by schema fingerprints.

Records of unlike layouts (prompt and response, instruction, message lists,
...) come as JSON text.  The nested field paths of a record, sorted and
without types, are hashed; the hash selects a declarative mapping (``MAPPINGS``)
that turns the record into canonical turns (role, text).  A template then marks
the turns:

    ``### role: text</turn>`` and a line feed

Control strings inside texts and roles are broken up by a backslash
(``<\\/turn>``, ``#\\## ``, in roles also ``:\\ ``) and backslashes are doubled,
so a marker in the output is always a real one and unescaping is one
replacement.  The loss mask is a list of code-point spans of the assistant
texts in the formatted string.

Turn offsets come from a running sum within the conversation, and a
conversation is assembled by one aggregate; its size is that of its own
output row.

Defined results: a record whose fingerprint is unknown, or that is null or not
JSON, keeps its key with null turns (``mapping`` null) and is formatted as the
empty string; null contents and roles are empty strings; a record with an
empty message list has no turns; repeated records of one key are merged in a
fixed order only by ``conversation_records`` (ties of turn by role and text).
Extra columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "### ", ": ", "</turn>\n"
END_MARK = "</turn>"

#: Declarative mappings: the paths that identify a layout, the schema to read
#: it by, and where its turns come from: ("field", role, path) for one turn, or
#: ("list", path, role field, text field) for a list of turns.  Optional texts
#: ("field?") give no turn when empty.
MAPPINGS = {
    "prompt_response": (["prompt", "response"], "prompt string, response string",
                        [("field", "user", "prompt"), ("field", "assistant", "response")]),
    "system_prompt_response": (["system", "prompt", "response"], "system string, prompt string, response string",
                               [("field", "system", "system"), ("field", "user", "prompt"),
                                ("field", "assistant", "response")]),
    "instruction": (["instruction", "input", "output"], "instruction string, input string, output string",
                    [("field", "user", "instruction"), ("field?", "user", "input"), ("field", "assistant", "output")]),
    "messages": (["messages", "messages[].content", "messages[].role"],
                 "messages array<struct<role:string,content:string>>", [("list", "messages", "role", "content")]),
    "conversation": (["data", "data.conversations", "data.conversations[].from", "data.conversations[].value"],
                     "data struct<conversations:array<struct<`from`:string,value:string>>>",
                     [("list", "data.conversations", "from", "value")]),
}
#: Role names of other layouts and their canonical names.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
#: Layouts whose role names are translated.
TRANSLATED = {"conversation"}


def nested_paths(record: Column) -> Column:
    """Sorted, distinct field paths of a JSON text (null if it is no JSON
    object): ``a``, ``a.b``, ``a[].b``."""
    @F.pandas_udf("string")
    def paths(records):
        import json

        import pandas as pd

        def walk(value, at, found):
            if isinstance(value, dict):
                for name, inner in value.items():
                    here = f"{at}.{name}" if at else name
                    found.add(here)
                    walk(inner, here, found)
            elif isinstance(value, list):
                for inner in value:
                    walk(inner, at + "[]", found)

        def one(text):
            try:
                value = json.loads(text)
            except (TypeError, ValueError, RecursionError):
                return None
            if not isinstance(value, dict):
                return None
            found: set[str] = set()
            walk(value, "", found)
            return "\n".join(sorted(found))
        return pd.Series([one(x) for x in records], dtype=object)
    return paths(record)


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _list_turn(role_field: str, text_field: str, translate: bool):
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])

    def turn(m: Column) -> Column:
        role = F.coalesce(m[role_field], F.lit(""))
        if translate:
            role = F.coalesce(names[role], role)
        return F.struct(role.alias("role"), F.coalesce(m[text_field], F.lit("")).alias("text"))
    return turn


def _turns(name: str, record: Column) -> Column:
    _, schema, rules = MAPPINGS[name]
    parsed = F.from_json(record, schema)
    parts = []
    for rule in rules:
        if rule[0] == "list":
            at = parsed
            for step in rule[1].split("."):
                at = at[step]

            parts.append(F.transform(at, _list_turn(rule[2], rule[3], name in TRANSLATED)))
        else:
            text = F.coalesce(parsed[rule[2]], F.lit(""))
            one = F.array(F.struct(F.lit(rule[1]).alias("role"), text.alias("text")))
            parts.append(F.when(text != "", one).otherwise(F.slice(one, 1, 0)) if rule[0] == "field?" else one)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def canonical_turns(records: DataFrame, key: str, record: str = "record") -> DataFrame:
    """(key, mapping, turns): the mapping chosen by fingerprint and the
    canonical turns, an array of (role, text)."""
    d = records.select(F.col(key), F.col(record).alias("_record"),
                       fingerprint(nested_paths(F.col(record))).alias("_print"))
    chosen = F.lit(None).cast("string")
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, (paths, _, _) in MAPPINGS.items():
        same = F.col("_print") == fingerprint(F.lit("\n".join(sorted(paths))))
        chosen = F.when(same, F.lit(name)).otherwise(chosen)
        turns = F.when(same, _turns(name, F.col("_record"))).otherwise(turns)
    return d.select(F.col(key), chosen.alias("mapping"), turns.alias("turns"))


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    ended = F.replace(doubled, F.lit(END_MARK), F.lit("<\\/turn>"))
    return F.replace(ended, F.lit(START), F.lit("#\\## "))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chat(turned: DataFrame, key: str) -> DataFrame:
    """(key, formatted, loss_spans) from (key, turns); keys must be unique."""
    d = turned.select(F.col(key).alias("_key"), "turns")
    d = d.select("_key", F.posexplode_outer("turns").alias("pos", "turn"))
    role = F.replace(escape(F.col("turn.role")), F.lit(SEPARATOR), F.lit(":\\ "))
    head = F.concat(F.lit(START), role, F.lit(SEPARATOR))
    d = d.select("_key", "pos", F.col("turn.role").alias("role"), head.alias("head"),
                 escape(F.col("turn.text")).alias("body"))
    size = F.length("head") + F.length("body") + len(END)
    d = d.withColumn("after", F.sum(size).over(Window.partitionBy("_key").orderBy("pos")))
    end = (F.col("after") - len(END)).cast("bigint")
    span = F.when(F.col("role") == "assistant",
                  F.struct((end - F.length("body")).alias("start"), end.alias("end")))
    part = F.when(F.col("pos").isNotNull(), F.struct(
        "pos", F.concat("head", "body", F.lit(END)).alias("part"), span.alias("span")))
    g = d.groupBy("_key").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return g.select(F.col("_key").alias(key),
                    F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("formatted"),
                    F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def parse_chat(formatted: Column) -> Column:
    """Turns read back from a formatted string."""
    pieces = F.split(formatted, r"\Q" + END_MARK + r"\E\n")
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(START) + 1))
        cut = F.instr(body, SEPARATOR)
        return F.struct(unescape(F.substr(body, F.lit(1), cut - 1)).alias("role"),
                        unescape(F.substr(body, cut + len(SEPARATOR))).alias("text"))
    return F.transform(pieces, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(
        spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def conversation_records(conversations: DataFrame) -> DataFrame:
    """(conv_id, record): rows by turn gathered into JSON records of unlike
    layouts, chosen by the conversation's roles and id."""
    row = F.struct(F.col("turn").isNull().alias("late"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    g = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    roles = F.transform("rows", lambda r: r["role"])
    named = lambda *names: roles == F.array(*[F.lit(n) for n in names])
    text = lambda i: F.get("rows", F.lit(i))["text"]
    even = F.pmod(F.coalesce("conv_id", F.lit(0)), F.lit(2)) == 0
    plain = F.size("rows") <= 3
    names = {v: k for k, v in list(ROLE_NAMES.items())[:2]}
    foreign = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    untranslated = ~F.exists("rows", lambda r: r["role"].isin(list(ROLE_NAMES)))
    listed = F.to_json(F.struct(F.transform("rows", lambda r: F.struct(
        r["role"].alias("role"), r["text"].alias("content"))).alias("messages")))
    nested = F.to_json(F.struct(F.struct(F.transform("rows", lambda r: F.struct(
        F.coalesce(foreign[r["role"]], r["role"]).alias("from"),
        r["text"].alias("value"))).alias("conversations")).alias("data")))
    record = (
        F.when(plain & (named("user", "assistant")) & even,
               F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(plain & (named("user", "assistant")),
              F.to_json(F.struct(text(0).alias("instruction"), F.lit("").alias("input"), text(1).alias("output"))))
        .when(plain & (named("system", "user", "assistant")),
              F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .when(even & untranslated, nested).otherwise(listed))
    return g.select("conv_id", record.alias("record"))


def chat_report(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from the formatted output.  A record
    whose layout no mapping knows is an error: none may come out empty."""
    turned = canonical_turns(conversation_records(conversations), "conv_id")
    turned = turned.withColumn("turns", F.when(F.col("turns").isNull(), F.raise_error(F.concat(
        F.lit("no mapping for the layout of conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
        .otherwise(F.col("turns")))
    out = format_chat(turned, "conv_id")
    back = out.withColumn("_back", parse_chat(F.col("formatted"))) \
              .withColumn("_loss", masked_text(F.col("formatted"), F.col("loss_spans")))
    joined = F.array_join(F.transform("_back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("_back").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(joined, "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode(F.col("_loss"), "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
