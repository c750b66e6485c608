"""Chat formatting: records of any known layout to turns, turns to a marked-up text and back.

A record is a JSON object. The fingerprint of its schema, a hash of its nested field paths,
selects a declarative mapping: which path holds which role. Mappings are data; a new layout is
one more entry.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- layouts ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Single:
    """Turns from single fields: (path, role), in order. Optional paths may be absent."""

    fields: tuple[tuple[str, str], ...]
    optional: tuple[str, ...] = ()
    #: path joined below another one's text, if it has text: (path, to)
    appended: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Listed:
    """Turns from a list of objects, after optional single fields."""

    path: str
    role: str
    text: str
    before: tuple[tuple[str, str], ...] = ()
    #: other names of roles
    roles: tuple[tuple[str, str], ...] = ()


_SHORT_ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))

LAYOUTS: dict[str, Single | Listed] = {
    "messages": Listed("messages", "role", "content"),
    "conversations": Listed("conversations", "from", "value", roles=_SHORT_ROLES),
    "system_conversations": Listed("conversations", "from", "value", before=(("system", "system"),),
                                   roles=_SHORT_ROLES),
    "turns": Listed("dialog.turns", "speaker", "text"),
    "prompt_completion": Single((("prompt", "user"), ("completion", "assistant"))),
    "prompt_response": Single((("system", "system"), ("prompt", "user"), ("response", "assistant")),
                              optional=("system",)),
    "instruction_output": Single(
        (("system", "system"), ("instruction", "user"), ("output", "assistant")),
        optional=("system", "input"), appended=(("input", "instruction"),)),
    "question_answer": Single((("data.question", "user"), ("data.answer", "assistant"))),
}


def field_paths(value, path: str = "") -> set[str]:
    """Paths of all leaves; list items share the path of the list plus ``[]``.

    Dots inside a name are escaped, and a leaf that stands in a list itself has the path of the
    list plus ``[]=``, so that neither is taken for another layout.
    """
    if isinstance(value, dict):
        names = {k: k.replace("\\", "\\\\").replace(".", "\\.") for k in value}
        found = set().union(*(field_paths(v, f"{path}.{names[k]}" if path else names[k])
                              for k, v in value.items()))
        return found or {path + "{}"}
    if isinstance(value, list):
        return set().union({path + "[]"} if not value else set(), *(
            field_paths(v, path + "[]") if isinstance(v, (dict, list)) else {path + "[]="} for v in value))
    return {path}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def layout_paths(layout: Single | Listed) -> Iterator[set[str]]:
    """Every path set that a layout stands for."""
    if isinstance(layout, Listed):
        single = {p for p, _ in layout.before}
        yield single | {f"{layout.path}[].{layout.role}", f"{layout.path}[].{layout.text}"}
        yield single | {f"{layout.path}[]"}
        return
    names = {p for p, _ in layout.fields} | {p for p, _ in layout.appended}
    for n in range(len(layout.optional) + 1):
        for absent in itertools.combinations(layout.optional, n):
            yield names - set(absent)


def registry(layouts: dict[str, Single | Listed], extras: tuple[str, ...] = ()) -> dict[str, str]:
    """Fingerprint -> layout name; the first layout of a fingerprint has it."""
    known: dict[str, str] = {}
    for name, layout in layouts.items():
        for paths in layout_paths(layout):
            known.setdefault(fingerprint(paths - set(extras)), name)
    return known


def _at(record, path: str):
    for key in path.split("."):
        record = record.get(key) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def canonical_turns(record: dict, layout: Single | Listed) -> list[tuple[str, str]]:
    """(role, text) of each turn."""
    if isinstance(layout, Listed):
        names = dict(layout.roles)
        turns = [(role, _text(_at(record, p))) for p, role in layout.before]
        for item in _at(record, layout.path) or []:
            role = _text(item.get(layout.role))
            turns.append((names.get(role, role), _text(item.get(layout.text))))
        return turns
    added = {to: _text(_at(record, p)) for p, to in layout.appended if _text(_at(record, p))}
    turns = []
    for path, role in layout.fields:
        if _at(record, path) is None and path in layout.optional:
            continue
        text = _text(_at(record, path))
        turns.append((role, f"{text}\n\n{added[path]}" if path in added else text))
    return turns


# ---- template -----------------------------------------------------------------------------

OPEN, CLOSE, ESCAPED = "<|im_start|>", "<|im_end|>", "<|\\"
#: After escaping, a text or role holds neither mark: each "<|" is followed by a backslash.
LINE_END = "<|/"
TRAINED_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("<|", ESCAPED)


def unescape(text: str) -> str:
    return text.replace(ESCAPED, "<|")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(text, loss spans): spans of the assistant texts, in code points, as they stand escaped.

    Each turn is OPEN role newline text CLOSE newline. A line end in a role is escaped too.
    """
    parts, spans, size = [], [], 0
    for role, text in turns:
        head = f"{OPEN}{escape(role).replace(chr(10), LINE_END)}\n"
        body = escape(text)
        if role == TRAINED_ROLE:
            spans.append((size + len(head), size + len(head) + len(body)))
        parts += [head, body, CLOSE, "\n"]
        size += len(head) + len(body) + len(CLOSE) + 1
    return "".join(parts), spans


_TURN = re.compile(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + "\n", re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(turn[1].replace(LINE_END, "\n")), unescape(turn[2])))
        at = turn.end()
    return turns


# ---- Spark --------------------------------------------------------------------------------

FORMATTED = ("key long, layout string, formatted string, "
             "loss_spans array<struct<begin:long,end:long>>, reject string")


def format_records(records: DataFrame, *, layouts: dict[str, Single | Listed] = LAYOUTS) -> DataFrame:
    """(key, layout, formatted, loss_spans, reject) of each record (key, record: JSON text).

    One row per row. A record that is null, no JSON object, of no known layout, or with half of a
    surrogate pair in it has a null text and the reason in `reject`. Null fields are empty texts. An empty list of turns gives
    an empty text. Other columns are not read.
    """
    known = registry(layouts)
    kind = pa.schema([
        ("key", pa.int64()), ("layout", pa.string()), ("formatted", pa.string()),
        ("loss_spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        ("reject", pa.string())])

    def one(key, raw):
        try:
            record = json.loads(raw) if raw is not None else None
        except ValueError:
            return key, None, None, None, "no JSON"
        except RecursionError:
            return key, None, None, None, "nested too deeply"
        if not isinstance(record, dict):
            return key, None, None, None, "no object"
        try:
            code = fingerprint(field_paths(record))
            name = known.get(code)
            if name is None:
                return key, None, None, None, f"unknown layout {code}"
            text, spans = render(canonical_turns(record, layouts[name]))
            text.encode()
        except UnicodeEncodeError:
            return key, None, None, None, "no Unicode text"
        except RecursionError:
            return key, None, None, None, "nested too deeply"
        return key, name, text, [{"begin": a, "end": b} for a, b in spans], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(k, r) for k, r in zip(batch.column(0).to_pylist(),
                                              batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(kind.names, row, strict=True)) for row in rows], schema=kind)

    return records.select(F.col("key").cast("long").alias("key"), "record").mapInArrow(run, FORMATTED)


def conversation_records(turns: DataFrame) -> DataFrame:
    """(key, record) from rows (conv_id, turn, role, text), in the layout that fits each.

    Rows go by turn (null first), then role and text. A user and an assistant turn make a
    prompt and a completion; with a system turn before them, a system prompt and response;
    longer conversations of even id a list of messages, of odd id one of speakers. Null roles
    and texts are empty. A conversation is one record, so it is gathered whole.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("key"), F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = rows.groupBy("key").agg(F.collect_list("t").alias("t"))
    whole = whole.withColumn("t", F.transform(F.sort_array("t"), lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("text"))))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), "\n")
    texts = [F.get("t", i)["text"] for i in range(3)]
    turns_are = F.size("t")  # a role may hold a line end
    as_json = F.when((turns_are == 2) & (roles == "user\nassistant"), F.to_json(F.struct(
        texts[0].alias("prompt"), texts[1].alias("completion"))))
    as_json = as_json.when((turns_are == 3) & (roles == "system\nuser\nassistant"), F.to_json(F.struct(
        texts[0].alias("system"), texts[1].alias("prompt"), texts[2].alias("response"))))
    as_json = as_json.when(F.coalesce(F.col("key") % 2, F.lit(0)) == 0, F.to_json(F.struct(
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))
                    ).alias("messages"))))
    as_json = as_json.otherwise(F.to_json(F.struct(F.struct(F.transform(
        "t", lambda x: F.struct(x["role"].alias("speaker"), x["text"].alias("text"))
    ).alias("turns")).alias("dialog"))))
    return whole.select("key", as_json.alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of rendered texts, from the texts and their loss spans alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars); rejected
    records, which have no text, are left out.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = parse(text)
                loss = "".join(unescape(text[s["begin"]:s["end"]]) for s in row["loss_spans"])
                out.append({
                    "conv_id": row["key"], "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256("".join(
                        f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                    "formatted_chars": len(text)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return formatted.where("formatted is not null").select("key", "formatted", "loss_spans").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
