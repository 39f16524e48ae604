"""Chat records of many layouts as one marked text, by schema fingerprints.

A record's layout is known by its nested field paths ("messages[].role"): those
that any mapping declares are sorted and hashed, and the fingerprint selects the
mapping. Mappings are data, not code; fields that none declares don't count. Where
fields of several mappings occur together, the most specific mapping that the
record satisfies is taken, and each item of a list of messages may have its text
as the mapping or a sibling of it declares. All layouts become canonical turns (conversation, turn, role, text), and turns become
marked text whose control strings are escaped reversibly, with a loss mask over
what the assistant says.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespark.llm.common import RowSink, map_arrow, rows_of

# -- layouts ---------------------------------------------------------------
# "each": a list whose items are turns, with the paths of role and text in an item.
# "row": the record is one turn of a conversation, with the paths of its place.
# "turns": fixed roles, each with the fields whose texts make it up, joined by a blank line.
# "optional" fields may be missing; an empty text of a fixed role gives no turn.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = {
    "turn rows": {"row": {"conversation": "conv_id", "turn": "turn", "role": "role", "text": "text"}},
    "messages": {"each": "messages[]", "role": "role", "text": "content", "optional": ["system"]},
    "message parts": {"each": "messages[]", "role": "role", "text": "content[].text", "optional": ["system"]},
    "from and value": {"each": "conversations[]", "role": "from", "text": "value", "roles": ROLES, "optional": ["system"]},
    "dialog": {"each": "dialog[]", "role": "speaker", "text": "utterance", "roles": ROLES},
    "instruction and output": {"turns": [("system", ["system"]), ("user", ["instruction", "input"]), ("assistant", ["output"])],
                               "optional": ["system", "input"]},
    "instruction and response": {"turns": [("user", ["instruction", "context"]), ("assistant", ["response"])], "optional": ["context"]},
    "prompt and completion": {"turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["completion"])],
                              "optional": ["system"]},
    "prompt and response": {"turns": [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])],
                            "optional": ["system"]},
    "question and answer": {"turns": [("user", ["context", "question"]), ("assistant", ["answer"])], "optional": ["context"]},
}


def declared(layout: dict) -> list[str]:
    if "row" in layout:
        return list(layout["row"].values())
    if "each" in layout:
        return [f"{layout['each']}.{layout['role']}", f"{layout['each']}.{layout['text']}", *layout.get("optional", [])]
    return [p for _, fields in layout["turns"] for p in fields]


KNOWN = {p for layout in LAYOUTS.values() for p in declared(layout)}


def field_paths(value, at: str = "") -> set[str]:
    """Paths of the leaves of a record; list items share theirs."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(field_paths(v, at + "[]") for v in value))
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths & KNOWN)).encode(), digest_size=8).hexdigest()


def signatures() -> list[tuple[set[str], str]]:
    """(paths, layout) for each choice of optional fields, the most specific first."""
    out = []
    for name, layout in LAYOUTS.items():
        optional = layout.get("optional", [])
        must = set(declared(layout)) - set(optional)
        out += [(must | set(some), name) for n in range(len(optional) + 1) for some in combinations(optional, n)]
    return sorted(out, key=lambda s: -len(s[0]))        # stable: of equally specific ones the first declared


class Registry(dict):
    """Fingerprint -> layout or None; what is not declared is matched by subsets once."""

    def __init__(self):
        self.signatures = signatures()
        super().__init__({fingerprint(paths): name for paths, name in reversed(self.signatures)})

    def layout_of(self, record) -> str | None:
        if not isinstance(record, dict):
            return None
        paths = field_paths(record)
        key = fingerprint(paths)
        if key not in self:
            if len(self) > 10_000:       # fingerprints of known fields only: not reached by real data
                self.__init__()
            self[key] = next((name for need, name in self.signatures if need <= paths), None)
        return self[key]


def values_at(record, path: str) -> list:
    """All values at a path, in order."""
    found = [record]
    for step in path.split("."):
        name, many = step.removesuffix("[]"), step.endswith("[]")
        found = [v[name] for v in found if isinstance(v, dict) and name in v]
        if many:
            found = [x for v in found for x in (v if isinstance(v, list) else [v])]
    return found


def as_text(values: list) -> str:
    return "\n\n".join(v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in values if v is not None)


def item_text(item, layout: dict) -> str:
    """Text of a message, found where its layout or one of the same list and role has it."""
    for other in [layout, *LAYOUTS.values()]:
        if other.get("each") == layout["each"] and other["role"] == layout["role"]:
            values = values_at(item, other["text"])
            if values and all(v is None or isinstance(v, str) for v in values):
                return as_text(values)
    return as_text(values_at(item, layout["text"]))


def turns_of(record: dict, layout: dict) -> list[tuple]:
    """(conversation or None, turn, role, text) of a record."""
    if "row" in layout:
        conversation, turn, role, text = ([*values_at(record, p), None][0] for p in layout["row"].values())
        return [(conversation, turn, as_text([role]), as_text([text]))]
    if "each" in layout:
        out = [("system", as_text(values_at(record, "system")))] if record.get("system") else []
        roles = layout.get("roles", {})
        for item in values_at(record, layout["each"]):
            role = as_text(values_at(item, layout["role"]))
            out.append((roles.get(role, role), item_text(item, layout)))
    else:
        out = [(role, text) for role, fields in layout["turns"]
               if (text := as_text([v for p in fields for v in values_at(record, p) if v != ""]))]
    return [(None, n, role, text) for n, (role, text) in enumerate(out)]


TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                   ("layout", pa.string())])


def _turns_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    layouts, sink = Registry(), RowSink(TURNS, 1024)
    for key, text in rows_of(batches):
        try:
            record = json.loads(text) if text else None
        except ValueError:
            record = None
        name = layouts.layout_of(record)
        if name is None:
            sink.add(key, None, None, None, None)
        else:
            for conversation, turn, role, words in turns_of(record, LAYOUTS[name]):
                sink.add(conversation if "row" in LAYOUTS[name] else key, turn, role, words, name)
        if sink.full:
            yield sink.batch()
    yield sink.batch()


def canonical_turns(records: DataFrame) -> DataFrame:
    """Turns of records (key, record as JSON text): (conv_id, turn, role, text, layout).

    A record that is no JSON object, or that satisfies no mapping, gives one row with a null turn and
    layout (see unmatched_records). A null text or role becomes empty; a null key stays null; repeated
    records give repeated turns; further columns are not read; an empty table gives none."""
    return map_arrow(
        records.select(F.col("key").cast("long"), "record"), _turns_task, "conv_id long, turn long, role string, text string, layout string")


def unmatched_records(turns: DataFrame) -> DataFrame:
    """(conv_id, records): how many records of each key no mapping took; format_conversations leaves them out."""
    return turns.where(F.col("layout").isNull()).groupBy("conv_id").agg(F.count(F.lit(1)).alias("records"))


# -- template ----------------------------------------------------------------
# FIXED VALUES: the template's marks.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
#: What may follow the first character (and backslashes) of a control string.
CONTROL = r"(?:/?s>|</?SYS>>|/?INST\]|\|[A-Za-z_]+\|>)"
ESCAPE = re.compile(r"([<\[])(\\*)(?=" + CONTROL + ")")
UNESCAPE = re.compile(r"([<\[])\\(\\*)(?=" + CONTROL + ")")
TURN = re.compile(re.escape(OPEN) + "([^\n]*)\n(.*)" + re.escape(CLOSE) + "\n", re.DOTALL)


def escape(text: str) -> str:
    """One backslash more after the first character of every control string, escaped or not."""
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's marked text, and where the turn's own text lies in it."""
    head = OPEN + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n"
    body = escape(text)
    return head + body + CLOSE + "\n", len(head), len(head) + len(body)


def read_turn(piece: str) -> tuple[str, str]:
    m = TURN.fullmatch(piece)
    if m is None:
        raise ValueError("not a formatted turn")
    role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], unescape(m[1]))
    return role, unescape(m[2])


PIECES = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("start", pa.int64()),
                    ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def _format_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sink, current, at = RowSink(PIECES, 1024), (), 0
    for conv_id, turn, role, text in rows_of(batches):
        if current != (conv_id,):
            current, at = (conv_id,), 0
        piece, a, b = formatted_turn(role, text)
        loss = (at + a, at + b) if role == LOSS_ROLE else (None, None)
        sink.add(conv_id, turn, piece, at, *loss)
        at += len(piece)
        if sink.full:
            yield sink.batch()
    yield sink.batch()


def format_conversations(turns: DataFrame) -> DataFrame:
    """The formatted text of each conversation, a row for each turn in order: (conv_id, turn, formatted,
    start, loss_start, loss_end), positions counting code points from the conversation's beginning.

    Turns are put in order by (turn, role, text), so ties and repeated rows have a fixed order, and a
    null conv_id is a conversation of its own. Rows that no layout gave (a null ``layout``, where there
    is such a column) are left out; other further columns are not read; an empty table gives none. Rows
    stream through a task one after the other: a conversation needs no more memory than a turn."""
    if "layout" in turns.columns:
        turns = turns.where(F.col("layout").isNotNull())
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(
        t.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"), _format_task, "conv_id long, turn long, formatted string, start long, loss_start long, loss_end long")


DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sink, current = RowSink(DIGESTS), None
    for conv_id, _, piece, start, loss_start, loss_end in rows_of(batches):
        if current is None or current[0] != conv_id:
            if current is not None:
                sink.add(current[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
            current, n, loss_chars, chars, turns, loss = (conv_id,), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        role, text = read_turn(piece)
        turns.update(f"{role}\n{text}\n".encode())
        if loss_start is not None:
            masked = unescape(piece[loss_start - start:loss_end - start])
            loss.update(masked.encode())
            loss_chars += len(masked)
        n, chars = n + 1, chars + len(piece)
        if sink.full:
            yield sink.batch()
    if current is not None:
        sink.add(current[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
    yield sink.batch()


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says, as digests; ``pieces`` as format_conversations
    gives them: sorted, a conversation's rows in one partition. A null conv_id is a conversation of its
    own, an empty text an empty turn; an empty table gives none; a text that is no formatted turn
    raises ValueError."""
    return map_arrow(
        pieces, _read_task, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
