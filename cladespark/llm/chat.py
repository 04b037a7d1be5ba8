"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A layout is known by the set of its nested field paths (``messages[].role``),
of which those that any mapping names are sorted and hashed. The hash selects a
mapping, which says in data where turns, roles and texts are. Typed tables are
converted by column expressions, JSON records one by one by the same mappings.

A turn is formatted as ``### role:\\n`` + text + ``\\n</turn>\\n``. Inside roles and texts a
backslash goes before every backslash, ``#`` and ``</turn>``, and in roles before
``:``, so no text can start or end a turn and reading back is exact.

Defined results: null texts and roles are empty; repeated turns stay, in the order
of turn, role, text with nulls first; rows with a null key are one conversation;
a record of unknown layout, or with a turn that isn't an object, gives one turn with null role and text and a null layout;
further columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import sliced

#: The layouts. each: where turns are repeated; turns: (role, text) for each, a role as =literal or a field.
MAPPINGS = [
    {"layout": "turn rows", "paths": ["turn", "role", "text"], "order": "turn", "turns": [("role", "text")]},
    {"layout": "messages", "paths": ["messages[].role", "messages[].content"], "each": "messages", "turns": [("role", "content")]},
    {"layout": "from and value", "paths": ["conversations[].from", "conversations[].value"], "each": "conversations", "turns": [("from", "value")]},
    {"layout": "prompt and completion", "paths": ["prompt", "completion"], "turns": [("=user", "prompt"), ("=assistant", "completion")]},
    {"layout": "prompt and response", "paths": ["prompt", "response"], "turns": [("=user", "prompt"), ("=assistant", "response")]},
    {"layout": "system, prompt and response", "paths": ["system", "prompt", "response"], "turns": [("=system", "system"), ("=user", "prompt"), ("=assistant", "response")]},
    {"layout": "question and answer", "paths": ["question", "answer"], "turns": [("=user", "question"), ("=assistant", "answer")]},
    {"layout": "instruction and output", "paths": ["instruction", "output"], "turns": [("=user", "instruction"), ("=assistant", "output")]},
    {"layout": "instruction, input and output", "paths": ["instruction", "input", "output"], "turns": [("=user", "instruction\ninput"), ("=assistant", "output")]},
]
#: What roles are called elsewhere.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

NAMED = {path for m in MAPPINGS for path in m["paths"]}


MARKED = re.compile(r"[\[\].~]")


def fingerprint(paths: set[str]) -> str:
    """The hash of a layout's paths; paths that no mapping names don't count."""
    return hashlib.blake2b("\n".join(sorted(paths & NAMED)).encode(), digest_size=8).hexdigest()


BY_FINGERPRINT = {fingerprint({*m["paths"]}): m for m in MAPPINGS}


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    """The nested field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        return set().union(*(schema_paths(f.dataType, f"{at}.{f.name}".lstrip(".")) for f in kind))
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return {at}


def record_paths(value: object, at: str = "") -> set[str]:
    """The nested field paths of a JSON value; an empty list has none. A field's own brackets and dots are marked."""
    found, open_ = set(), [(value, at)]
    while open_:
        value, at = open_.pop()
        if isinstance(value, dict):
            open_ += [(v, f"{at}.{MARKED.sub(r'~', k)}".lstrip(".")) for k, v in value.items()]
        elif isinstance(value, list):
            open_ += [(v, f"{at}[]") for v in value]
        else:
            found.add(at)
    return found


def turns_of_table(df: DataFrame, key: str) -> DataFrame:
    """key, turn, role, text of a typed table, by the mapping that its schema selects."""
    own = T.StructType([f for f in df.schema if f.name != key])
    mapping = BY_FINGERPRINT.get(fingerprint(schema_paths(own)))
    if mapping is None:
        raise ValueError(f"no mapping for the layout {sorted(schema_paths(own))}")
    source, order = df, F.lit(0).cast("long")
    if "each" in mapping:
        source = df.select(F.col(key), F.posexplode_outer(mapping["each"]).alias("_pos", "_turn"))
        order = F.coalesce(F.col("_pos"), F.lit(0)).cast("long")
    elif "order" in mapping:
        order = F.col(mapping["order"]).cast("long")
    inside = "_turn." if "each" in mapping else ""

    def text_of(fields: str):
        parts = [F.coalesce(F.col(inside + x).cast("string"), F.lit("")) for x in fields.split("\n")]
        return parts[0] if len(parts) == 1 else F.when(parts[1] == "", parts[0]).otherwise(F.concat(parts[0], F.lit("\n"), parts[1]))

    def role_of(field: str):
        if field[0] == "=":
            return F.lit(field[1:])
        if "order" in mapping:  # rows that are turns already keep their roles
            return F.coalesce(F.col(inside + field).cast("string"), F.lit(""))
        role, names = F.coalesce(F.col(inside + field).cast("string"), F.lit("")), F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
        return F.coalesce(names[role], role)

    count = len(mapping["turns"])
    rows = [F.struct((order * count + i).alias("turn"), role_of(r).alias("role"), text_of(t).alias("text")) for i, (r, t) in enumerate(mapping["turns"])]
    if count == 1:
        return source.select(F.col(key), rows[0].alias("_t")).select(key, "_t.*")
    return source.select(F.col(key), F.explode(F.array(*rows)).alias("_t")).select(key, "_t.*")


def turns_of_record(record: str | None) -> list[tuple[str | None, str | None, str | None]]:
    """(role, text, layout) of each turn of a JSON record."""
    try:
        value = json.loads(record or "")
    except (ValueError, RecursionError):
        value = None
    mapping = BY_FINGERPRINT.get(fingerprint(record_paths(value))) if isinstance(value, dict) else None
    if mapping is None:
        return [(None, None, None)]
    out = []
    items = value[mapping["each"]] if "each" in mapping else [value]
    if not isinstance(items, list) or not all(isinstance(x, dict) for x in items):
        return [(None, None, None)]
    for item in items:
        for role, text in mapping["turns"]:
            said = role[1:] if role[0] == "=" else str(item.get(role) or "")
            parts = [str(item[x]) for x in text.split("\n") if item.get(x)]
            out.append((ROLES.get(said, said), "\n".join(parts), mapping["layout"]))
    return out


def turns_of_json(df: DataFrame, key: str, record: str) -> DataFrame:
    """key, turn, role, text, layout of heterogeneous JSON records, each by the mapping that its own paths select."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            found = [(at, n, *t) for at, x in enumerate(batch.column(1).to_pylist()) for n, t in enumerate(turns_of_record(x))]
            at, turn, role, text, layout = (list(x) for x in zip(*found)) if found else ([],) * 5
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(turn, pa.int64()), *(pa.array(x, pa.string()) for x in (role, text, layout))], ["key", "turn", "role", "text", "layout"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(record).cast("string").alias("record"))
    return rows.mapInArrow(run, f"key {kind}, turn long, role string, text string, layout string").withColumnRenamed("key", key)


def format_turns(turns: DataFrame, key: str) -> DataFrame:
    """key, turn, role, text, formatted, loss_start, loss_end.

    The conversation is what ``formatted`` gives in order. The loss mask holds the characters
    from loss_start to before loss_end of each assistant turn; both are null elsewhere.
    """
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    escaped = lambda x: F.replace(F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\#")), F.lit("</turn>"), F.lit("\\</turn>"))
    head = F.concat(F.lit("### "), F.replace(escaped(role), F.lit(":"), F.lit("\\:")), F.lit(":\n"))
    start = F.when(role == "assistant", F.char_length("_head"))
    return (
        turns.select(key, "turn", role.alias("role"), text.alias("text"), head.alias("_head"), escaped(text).alias("_said"))
        .select(key, "turn", "role", "text", F.concat("_head", "_said", F.lit("\n</turn>\n")).alias("formatted"), start.cast("long").alias("loss_start"), (start + F.char_length("_said")).cast("long").alias("loss_end"))
    )


TURN = re.compile(r"### ((?:\\.|[^\\:])*):\n((?:\\.|[^\\#])*)\n</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def read_back(formatted: DataFrame, key: str) -> DataFrame:
    """One row for each conversation, from the formatted text and its mask alone.

    key, n_turns, turns_sha256 (of role, newline, text, newline for each turn), loss_chars,
    loss_sha256 (of all text under the mask), formatted_chars. A conversation is read in
    order as a stream, so its length doesn't bound memory.
    """
    kind = formatted.schema[key].dataType.simpleString()
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now, said, loss, counts = None, None, None, [0, 0, 0]

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 6
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)
            done.clear()
            return out

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for k, piece, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if said is None or k != now:
                    if said is not None:
                        done.append((now, counts[0], said.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                    now, said, loss, counts = k, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                turn = TURN.fullmatch(piece)
                said.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
                counts[0] += 1
                counts[2] += len(piece)
                if start is not None:
                    masked = unescape(piece[start:end])
                    counts[1] += len(masked)
                    loss.update(masked.encode())
            if len(done) >= 1000:
                yield flush(key_type)
        if said is not None:
            done.append((now, counts[0], said.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
            yield flush(key_type)

    ordered = formatted.repartition(F.col(key)).sortWithinPartitions(key, "turn", "role", "text")
    rows = ordered.select(F.col(key).alias("key"), "formatted", "loss_start", "loss_end")
    return rows.mapInArrow(run, f"key {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("key", key)
