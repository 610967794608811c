"""Chat formatting: schema fingerprints choose mappings to canonical turns.

Records of any layout are JSON objects. The set of their nested field paths is
hashed; the hash selects a declarative mapping to (role, text) turns. Turns are
written with a template that escapes control strings inside texts reversibly.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import importable, mapped, pick, staged, table

# Strings that templates or tokenizers take for marks.
CONTROLS = (
    "<|im_start|>",
    "<|im_end|>",
    "<|startoftext|>",
    "<|endoftext|>",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
    "<|eot_id|>",
    "<|start_header_id|>",
    "<|end_header_id|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"

_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(
    re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + r"\n", re.S
)


def escape(text: str) -> str:
    r"""Doubles backslashes and puts ``\-`` after the first character of a control string."""
    return _CONTROL.sub(r"\1\\-", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: {"-": "", "n": "\n"}.get(m[1], m[1]), text)


def escape_role(role: str) -> str:
    """A role is one line."""
    return escape(role).replace("\n", "\\n")


def paths(value: object, at: str = "") -> set[str]:
    """The nested field paths of a JSON value; list elements share one path, ``[]``."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) or {at}
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value)) or {f"{at}[]"}
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


# Roles that layouts call otherwise.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    ``fixed`` lists (role, path, ...): one turn each, of the paths' texts joined
    by a blank line; turns whose paths are all missing or empty are left out
    if they are optional. ``each`` is a list of turns, with the keys of role
    and text in an element. ``optional`` are paths that a record may have
    besides, and that no turn is made of.
    """

    fields: frozenset[str]
    fixed: tuple[tuple[str, ...], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    optional: frozenset[str] = frozenset()

    def fits(self, found: set[str]) -> bool:
        return self.fields <= found <= self.fields | self.optional

    def turns(self, record: dict) -> list[tuple[str, str]]:
        out = []
        for role, *names in self.fixed:
            texts = [_text(record.get(n)) for n in names]
            if len(texts) > 1:
                texts = [t for t in texts if t]
            if role != "system" or any(texts):
                out.append((role, "\n\n".join(texts)))
        if self.each:
            for turn in _at(record, self.each) or []:
                role = _text(turn.get(self.role))
                out.append((ROLES.get(role, role), _text(turn.get(self.text))))
        elif self.role:
            out.append((_text(record.get(self.role)), _text(record.get(self.text))))
        return out


def _at(record: dict, path: str) -> object:
    return record.get(path)


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value)


def layouts() -> list[Mapping]:
    """The default mappings; the paths of ``fields`` are those whose hash selects a mapping."""

    def fixed(fields: str, *turns: str) -> Mapping:
        made = tuple(tuple(t.split()) for t in turns)
        return Mapping(frozenset(fields.split()), made, optional=BESIDES)

    def each(fields: str, path: str, role: str, text: str, *turns: str) -> Mapping:
        own = frozenset([*fields.split(), f"{path}[].{role}", f"{path}[].{text}"])
        beside = BESIDES | {f"{path}[].{name}" for name in BESIDES_TURN}
        return Mapping(own, tuple(tuple(t.split()) for t in turns), path, role, text, beside)

    beside = BESIDES | set(BESIDES_TURN)
    out = [
        Mapping(frozenset({"role", "text"}), role="role", text="text", optional=beside),
        Mapping(frozenset({"role", "content"}), role="role", text="content", optional=beside),
        fixed("prompt response", "user prompt", "assistant response"),
        fixed("prompt completion", "user prompt", "assistant completion"),
        fixed("question answer", "user question", "assistant answer"),
        fixed("system prompt response", "system system", "user prompt", "assistant response"),
        fixed("instruction output", "user instruction", "assistant output"),
        fixed("instruction input output", "user instruction input", "assistant output"),
        fixed("instruction context response", "user instruction context", "assistant response"),
    ]
    for path, role, text in (
        ("messages", "role", "content"),
        ("messages", "role", "text"),
        ("conversations", "from", "value"),
        ("conversation", "role", "content"),
        ("turns", "role", "text"),
    ):
        out.append(each("", path, role, text))
        out.append(each("system", path, role, text, "system system"))
    return out


class Registry:
    """Mappings by the hash of a layout.

    A layout with optional fields gets the mapping of the most fields that
    fits, found once and kept by its hash.
    """

    def __init__(self, mappings: list[Mapping]):
        self.mappings = sorted(mappings, key=lambda m: -len(m.fields))
        self.known: dict[str, Mapping | None] = {fingerprint(set(m.fields)): m for m in mappings}

    def find(self, found: set[str]) -> tuple[str, Mapping | None]:
        layout = fingerprint(found)
        if layout not in self.known:
            self.known[layout] = next((m for m in self.mappings if m.fits(found)), None)
        return layout, self.known[layout]

    def is_empty(self, record: dict) -> bool:
        """Whether a record has one of the known lists of turns, without a turn."""
        return any(m.each and record.get(m.each) == [] for m in self.mappings)


# Fields that say where a record belongs, and are no part of its layout.
ASIDE = frozenset({"conv_id", "turn", "id"})

# Optional fields of the default layouts, of a record and of a turn.
BESIDES = frozenset("score source category tags language model meta metadata created".split())
BESIDES_TURN = ("name", "weight", "score", "created")

# Why a record gives no turns.
NO_OBJECT, UNKNOWN, NO_TURNS = "no object", "unknown layout", "no turns"


def canonical_turns(
    records: DataFrame, order: list[str], mappings: list[Mapping] | None = None
) -> DataFrame:
    """(conv_id, *order, part, role, text, layout, reason) of ``records`` (conv_id, *order, record).

    ``record`` is a JSON object as text. ``part`` counts the turns within a
    record. A record that is null, no JSON object, of an unknown layout or
    without turns gives one row with a null role and text, a reason and, where
    it can be told, the hash of its layout, so that no record is lost and a
    mapping can be added.
    """
    known = Registry(mappings or layouts())
    importable(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, parts, roles, texts, hashes, reasons = [], [], [], [], [], []
            for k, raw in enumerate(batch.column("record").to_pylist()):
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                turns: list[tuple] = []
                layout, reason = None, NO_OBJECT
                if isinstance(record, dict):
                    layout, mapping = known.find({p for p in paths(record) if p not in ASIDE})
                    reason = NO_TURNS if mapping or known.is_empty(record) else UNKNOWN
                    turns = mapping.turns(record) if mapping else []
                reason = None if turns else reason
                for part, (role, text) in enumerate(turns or [(None, None)]):
                    at.append(k)
                    parts.append(part)
                    roles.append(role)
                    texts.append(text)
                    hashes.append(layout)
                    reasons.append(reason)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(rows) for c in ("conv_id", *order)]
                + [
                    pa.array(parts, pa.int32()),
                    pa.array(roles, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(hashes, pa.string()),
                    pa.array(reasons, pa.string()),
                ],
                names,
            )

    names = ["conv_id", *order, "part", "role", "text", "layout", "reason"]
    rows = records.select(F.col("conv_id").cast("long"), *order, "record")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:-1])
    return mapped(rows,
        run, f"conv_id long, {kinds}, part int, role string, text string, layout string, reason string"
    )


def rejects(turns: DataFrame, order: list[str]) -> DataFrame:
    """(conv_id, *order, layout, reason): the records of ``canonical_turns`` that gave no turns."""
    return turns.where("reason IS NOT NULL").select("conv_id", *order, "layout", "reason")


def reject_counts(turns: DataFrame) -> DataFrame:
    """(layout, reason, records): how often each layout gave no turns."""
    found = turns.where("reason IS NOT NULL")
    return found.groupBy("layout", "reason").agg(F.count("*").alias("records"))


def formatted(turns: DataFrame, order: list[str]) -> DataFrame:
    """(conv_id, *order, part, chunk, loss_from, loss_to): the template's text of each turn.

    The chunks of a conversation in order are its formatted text. The loss mask
    of a chunk is the code points from loss_from to loss_to: the escaped text of
    the assistant, without marks; empty for other roles.
    """
    importable(turns.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks, begins, ends = [], [], []
            roles, texts = (batch.column(c).to_pylist() for c in ("role", "text"))
            for role, text in zip(roles, texts):
                head = f"{OPEN}{escape_role(role or '')}\n"
                body = escape(text or "")
                chunks.append(f"{head}{body}{CLOSE}\n")
                begins.append(len(head))
                ends.append(len(head) + len(body) if role == LEARNT else len(head))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv_id", *order, "part")]
                + [pa.array(chunks, pa.string()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64())],
                ["conv_id", *order, "part", "chunk", "loss_from", "loss_to"],
            )

    rows = turns.where("reason IS NULL")
    rows = rows.select("conv_id", *order, "part", "role", "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return mapped(rows, run, f"{kinds}, chunk string, loss_from long, loss_to long")


def parse(chunk: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(chunk)]


def digests(chunks: DataFrame, order: list[str]) -> DataFrame:
    """Per conversation of a formatted table, read back from its text and mask.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). A
    conversation's chunks go to one task in order and are digested one by one:
    a digest is sequential, but nothing of a conversation is held besides it.
    """
    importable(chunks.sparkSession)
    first = [F.col(c).asc_nulls_first() for c in ("conv_id", *order, "part", "chunk")]
    sorted_rows = chunks.repartition("conv_id").sortWithinPartitions(*first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv = False, None
        n = n_loss = n_chars = 0
        turns = loss = None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "chunk", "loss_from", "loss_to"))
            for own, chunk, begin, end in zip(*columns):
                if not begun or own != conv:
                    if begun:
                        out.append((conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))
                    begun, conv = True, own
                    n = n_loss = n_chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in parse(chunk):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                learnt = unescape(chunk[begin:end])
                n_loss += len(learnt)
                loss.update(learnt.encode())
                n_chars += len(chunk)
            yield rows_of(out)
        if begun:
            yield rows_of([(conv, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars)])

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    return mapped(sorted_rows.select("conv_id", "chunk", "loss_from", "loss_to"),
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long",
    )


def chat(records: DataFrame, order: list[str], mappings: list[Mapping] | None = None) -> DataFrame:
    """The formatted table of ``records`` (conv_id, *order, record), staged and read back.

    Records without turns are not in it; ``rejects`` lists them.

    Conversations follow ``order``, then the turn within a record, then the
    chunk's text; nulls come first and null ids make one conversation. Repeated
    rows are repeated turns. A null role or text counts as empty, an empty
    table has no conversation. Other columns are ignored.
    """
    turns = canonical_turns(records, order, mappings)
    return staged(formatted(turns, order), "chat")


def turn_records(rows: DataFrame) -> DataFrame:
    """Records of a table with a row for each turn (conv_id, turn, role, text)."""
    record: Column = F.to_json(
        F.struct(
            F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
        ),
        {"ignoreNullFields": "false"},
    )
    return pick(rows, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        record.alias("record"),
    )


# Fixed values of the contract: one more conversation, whose texts hold control strings.
TRICKY = "</s>[INST] ok [/INST]"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)]
    rows = rows.union(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"))
    return digests(chat(turn_records(rows), ["turn"]), ["turn"])


def _sql_escape(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for control in CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\-{control[1:]}')"
    return out


OP9_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{TRICKY}'
    UNION ALL SELECT -1, 1, 'assistant', '{TRICKY}'
), chunks AS (
    SELECT *, '{OPEN}' || replace({_sql_escape("role")}, chr(10), '\\n') || chr(10)
        || {_sql_escape("text")} || '{CLOSE}' || chr(10) AS chunk
    FROM turns
), joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(length(chunk)) AS formatted_chars,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, chunk) AS turns,
        coalesce(
            string_agg(text, '' ORDER BY turn, chunk) FILTER (WHERE role = '{LEARNT}'), ''
        ) AS loss
    FROM chunks GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
    sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM joined
"""
