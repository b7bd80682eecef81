"""Chat formatting: layouts are told apart by the nested field paths they have.

A layout's fingerprint is the MD5 of its sorted known field paths (of an array
those of any element). It selects a declarative mapping that turns a record into
canonical turns (role, text). Records can be JSON strings (prompt/response,
instruction/input/output, message lists with role/content or from/value; every
record its own layout) or rows by turn, whose layout is the table's schema; a
table with the columns of several row layouts has the first of them.

Turns are written with the template ``<|turn|>role\\ntext<|end|>\\n``. Control
strings inside roles and texts are escaped reversibly: ``&`` becomes ``&amp;``,
and then the first character of every control string becomes an entity. The
loss mask is a list of (start, length) in characters of the formatted text and
covers exactly the assistant's texts.

Everything is column expressions. Rows of a conversation are numbered by a
window and collected on the same key, so there is one shuffle; a conversation
is one output record and the only thing gathered.

Defined cases: a null role or text is empty; turns with equal numbers are
ordered by role and text, repeated rows stay; a JSON record of no known layout
has a null layout and no turns; further fields and columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, END = "<|turn|>", "<|end|>\n"

# Strings that steer common chat models.
CONTROLS = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]
ENTITIES = {"<": "&lt;", "[": "&#91;", "\n": "&#10;", "&": "&amp;"}

# Declarative mappings. single: turns in order, each a role and the paths whose non-empty texts are joined by blank lines.
# many: the array, and the paths of role and text in an element.
MAPPINGS = [
    {"name": "prompt_response", "single": [("user", ["prompt"]), ("assistant", ["response"])]},
    {"name": "prompt_completion", "single": [("user", ["prompt"]), ("assistant", ["completion"])]},
    {"name": "system_prompt_response", "single": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])]},
    {"name": "question_answer", "single": [("user", ["question"]), ("assistant", ["answer"])]},
    {"name": "instruction", "single": [("user", ["instruction"]), ("assistant", ["output"])]},
    {"name": "instruction_input", "single": [("user", ["instruction", "input"]), ("assistant", ["output"])]},
    {"name": "messages", "many": ("messages", "role", "content")},
    {"name": "conversations", "many": ("conversations", "from", "value")},
    {"name": "data_messages", "many": ("data.messages", "role", "content")},
]
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
ROW_MAPPINGS = {("role", "text", "turn"): ("turn", "role", "text"), ("content", "role", "turn"): ("turn", "role", "content"), ("from", "turn", "value"): ("turn", "from", "value")}


def fingerprint(paths: list[str]) -> str:
    return hashlib.md5(",".join(sorted(paths)).encode()).hexdigest()


def paths_of(mapping: dict) -> list[str]:
    if "many" in mapping:
        array, role, text = mapping["many"]
        return [array, f"{array}[].{role}", f"{array}[].{text}"]
    return [p for _, ps in mapping["single"] for p in ps]


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """All nested field paths of a schema; [] marks array elements."""
    out = []
    for field in schema.fields:
        path, kind = f"{prefix}{field.name}", field.dataType
        out.append(path)
        while isinstance(kind, T.ArrayType):
            path, kind = f"{path}[]", kind.elementType
        if isinstance(kind, T.StructType):
            out += schema_paths(kind, f"{path}.")
    return out


KNOWN_PATHS = sorted({p for m in MAPPINGS for p in paths_of(m)})


ROW_PATHS = sorted({p for paths in ROW_MAPPINGS for p in paths})
# Fingerprints of all sets of row paths that hold a mapping's.
ROW_LAYOUTS = {
    fingerprint(list(paths)): next(m for wanted, m in ROW_MAPPINGS.items() if set(wanted) <= set(paths))
    for size in range(len(ROW_PATHS) + 1)
    for paths in combinations(ROW_PATHS, size)
    if any(set(wanted) <= set(paths) for wanted in ROW_MAPPINGS)
}


def _has(record: Column, path: str) -> Column:
    """Whether a variant has a path; [] stands for any element of an array."""
    array, _, inner = path.partition("[].")
    if not inner:
        return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()
    return F.exists(F.try_variant_get(record, f"$.{array}", "array<variant>"), lambda x: F.try_variant_get(x, f"$.{inner}", "variant").isNotNull())


def layout(record: Column) -> Column:
    """The fingerprint of a variant: MD5 of the known paths that it has."""
    present = F.array(*[F.when(_has(record, p), F.lit(p)) for p in KNOWN_PATHS])
    return F.md5(F.array_join(F.array_compact(present), ",").cast("binary"))


TURNS_TYPE = "array<struct<role:string,text:string>>"


def _turn(role: str, text: str) -> Callable[[Column], Column]:
    """An element of a message list as (role, text)."""

    def make(x: Column) -> Column:
        r = F.try_variant_get(x, f"$.{role}", "string")
        named = F.coalesce(*[F.when(r == old, F.lit(new)) for old, new in ROLES.items()], r, F.lit(""))
        return F.struct(named.alias("role"), F.coalesce(F.try_variant_get(x, f"$.{text}", "string"), F.lit("")).alias("text"))

    return make


def turns_from_json(records: DataFrame, key: str, json: str) -> DataFrame:
    """(key, layout, turns): JSON strings of any known layout as canonical turns, in order."""
    v = F.try_parse_json(F.col(json))
    got = records.select(F.col(key), v.alias("_v")).withColumn("_f", layout(F.col("_v")))
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS_TYPE)
    for m in MAPPINGS:
        if "many" in m:
            array, role, text = m["many"]
            items = F.try_variant_get(F.col("_v"), f"$.{array}", "array<variant>")
            made = F.transform(items, _turn(role, text))
        else:
            made = F.array(*[F.struct(F.lit(role).alias("role"), F.array_join(F.filter(F.array(*[F.try_variant_get(F.col("_v"), f"$.{p}", "string") for p in ps]), lambda s: s != ""), "\n\n").alias("text")) for role, ps in m["single"]])
        mine = F.col("_f") == fingerprint(paths_of(m))
        name, turns = F.when(mine, F.lit(m["name"])).otherwise(name), F.when(mine, F.coalesce(made, F.array().cast(TURNS_TYPE))).otherwise(turns)
    return got.select(F.col(key), name.alias("layout"), turns.alias("turns"))


def turns_from_rows(rows: DataFrame, key: str) -> DataFrame:
    """(key, turn, role, text): rows by turn; the fingerprint of the table's field paths selects the mapping."""
    have = schema_paths(rows.schema)
    mapping = ROW_LAYOUTS.get(fingerprint([p for p in have if p in ROW_PATHS]))
    if mapping is None:
        raise ValueError(f"no known layout has the columns {sorted(have)}")
    turn, role, text = mapping
    r = F.coalesce(F.col(role).cast("string"), F.lit(""))
    if role == "from":  # this layout names its roles otherwise
        r = F.coalesce(*[F.when(r == old, F.lit(new)) for old, new in ROLES.items()], r)
    return rows.select(F.col(key), F.col(turn).alias("turn"), r.alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit(ENTITIES["&"]))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(ENTITIES[c[0]] + c[1:]))
    return out


def unescape(text: Column) -> Column:
    for raw, entity in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(raw))
    return text


def format_rows(turns: DataFrame, key: str) -> DataFrame:
    """(key, formatted, loss array<struct<start,length>>) from (key, turn, role, text)."""
    role, text = F.replace(escape(F.col("role")), F.lit("\n"), F.lit(ENTITIES["\n"])), escape(F.col("text"))
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    pieces = turns.select(F.col(key), "turn", "role", "text", head.alias("head"), text.alias("body"))
    order = Window.partitionBy(key).orderBy("turn", "role", "text")
    size = F.length("head") + F.length("body") + len(END)
    placed = pieces.select(
        F.col(key),
        F.row_number().over(order).alias("i"),
        F.concat("head", "body", F.lit(END)).alias("piece"),
        (F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size + F.length("head")).alias("start"),
        F.length("body").alias("length"),
        (F.col("role") == "assistant").alias("trained"),
    )
    one = placed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", "piece", "start", "length", "trained"))).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["trained"]), lambda x: F.struct(x["start"].alias("start"), x["length"].cast("long").alias("length")))
    return one.select(F.col(key), F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss"))


def format_records(turns: DataFrame, key: str) -> DataFrame:
    """The same from (key, turns): one row for each turn goes through ``format_rows``."""
    rows = turns.select(F.col(key), F.posexplode("turns").alias("turn", "t")).select(F.col(key), "turn", "t.role", "t.text")
    return format_rows(rows, key)


def parse(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted text."""
    parts = F.split(formatted, r"<\|end\|>\n")
    pattern = r"(?s)^<\|turn\|>([^\n]*)\n(.*)$"
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(unescape(F.regexp_extract(p, pattern, 1)).alias("role"), unescape(F.regexp_extract(p, pattern, 2)).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substring(formatted, (x["start"] + 1).cast("int"), x["length"].cast("int")))), "")


def digest(done: DataFrame, key: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the output."""
    read = done.select(F.col(key), F.length("formatted").cast("long").alias("formatted_chars"), parse(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss")).alias("trained"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col(key).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
