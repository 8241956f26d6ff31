"""Chat formatting as prefix trees: conversations that share initial turns share their tokens.

Conversations are sorted by the hashes of their turns, so those with common beginnings follow each
other, wherever a beginning is so frequent that it takes many tasks.  A task walks its run depth
first and fills packs, the training sequences: every turn of a pack's tree is emitted once, with its
positions and with the intervals of its ancestors, which are all its tokens may attend to besides
themselves.  A pack is as large as a training sequence; a tree that does not fit goes on in the next
pack, which states the turns above again."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.frames import importable, named
from civicspark.llm.tokenizer_alignment import BYTE_BPE, TOKENIZERS, ByteLevel
from civicspark.session import materialize

#: The marks of a turn, and the role whose texts are learned.
START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

#: Tokens and conversations of a pack; one conversation is always taken whole.
PACK_TOKENS = 1 << 16
PACK_CONVERSATIONS = 1 << 12

#: Stored packs lie in row groups of so many.  Spark reads Parquet in batches of 4,096 rows, which
#: would be some 2 GB of packs a task, but never takes rows of two groups into one.
GROUP_PACKS = 16

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    """No control string is left in ``text``: between ``<`` and ``|``, and any backslashes there,
    comes one backslash more."""
    return _MARK.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role stands on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


class Template:
    """Turns as tokens, and tokens as text.  Two ids after the vocabulary mark a turn."""

    def __init__(self, path: str):
        self._tokenizer = ByteLevel(path)
        size = len(self._tokenizer.table)
        self.start, self.end = size, size + 1
        self._table = [*self._tokenizer.table, START.encode(), END.encode()]
        self._line = self._tokenizer.encode(["\n"])[0]

    def turns(self, turns: list[tuple[str, str]]) -> list[tuple[list[int], int, int]]:
        """Every turn's tokens, and which of them are its text."""
        parts = [p for role, text in turns for p in (escape_role(role) + "\n", escape(text))]
        ids = self._tokenizer.encode(parts)
        out = []
        for role, text in zip(ids[::2], ids[1::2], strict=True):
            first = 1 + len(role)
            last = first + len(text)
            out.append(([self.start, *role, *text, self.end, *self._line], first, last))
        return out

    def text(self, ids: list[int]) -> str:
        return b"".join([self._table[k] for k in ids]).decode()


_SPAN = "struct<start: int, stop: int>"
PACK = (
    "pack long, token_ids array<int>, position_ids array<int>, "
    f"loss array<{_SPAN}>, "
    f"segments array<struct<start: int, stop: int, ancestors: array<{_SPAN}>>>, "
    f"conversations array<struct<conv_id: long, path: array<{_SPAN}>>>"
)
_SPAN_ARROW = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
_PACK_ARROW = pa.schema(
    [
        ("pack", pa.int64()),
        ("token_ids", pa.list_(pa.int32())),
        ("position_ids", pa.list_(pa.int32())),
        ("loss", pa.list_(_SPAN_ARROW)),
        (
            "segments",
            pa.list_(
                pa.struct(
                    [
                        ("start", pa.int32()),
                        ("stop", pa.int32()),
                        ("ancestors", pa.list_(_SPAN_ARROW)),
                    ]
                )
            ),
        ),
        (
            "conversations",
            pa.list_(pa.struct([("conv_id", pa.int64()), ("path", pa.list_(_SPAN_ARROW))])),
        ),
    ]
)


def _span(interval: tuple[int, int]) -> dict[str, int]:
    return {"start": interval[0], "stop": interval[1]}


class Pack:
    """One training sequence while it is filled."""

    def __init__(self):
        self.tokens: list[int] = []
        self.positions: list[np.ndarray] = []
        self.loss: list[tuple[int, int]] = []
        self.segments: list[dict] = []
        self.conversations: list[dict] = []
        # The turns from the root to where the walk is, and the intervals of their tokens.
        self.turns: list[tuple[str, str]] = []
        self._places: list[tuple[int, int]] = []

    def shared(self, turns: list[tuple[str, str]]) -> int:
        """How many initial turns the walk has just passed."""
        pairs = zip(self.turns, turns, strict=False)
        return sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], pairs))

    def _path(self) -> list[tuple[int, int]]:
        """The intervals down to here, those that touch as one."""
        path: list[tuple[int, int]] = []
        for start, stop in self._places:
            if path and path[-1][1] == start:
                path[-1] = (path[-1][0], stop)
            else:
                path.append((start, stop))
        return path

    def add(
        self,
        conv_id: int | None,
        turns: list[tuple[str, str]],
        kept: int,
        new: list[tuple[list[int], int, int]],
    ) -> None:
        """Go back to the first ``kept`` turns, then down the ``new`` ones."""
        del self.turns[kept:], self._places[kept:]
        above = self._path()
        position = sum(stop - start for start, stop in above)
        begin = len(self.tokens)
        for turn, (ids, first, last) in zip(turns[kept:], new, strict=True):
            start = len(self.tokens)
            self.tokens += ids
            if turn[0] == LEARNED and last > first:
                self.loss.append((start + first, start + last))
            self.turns.append(turn)
            self._places.append((start, len(self.tokens)))
        stop = len(self.tokens)
        if stop > begin:
            self.positions.append(np.arange(position, position + stop - begin, dtype=np.int32))
            ancestors = [_span(s) for s in above]
            self.segments.append({"start": begin, "stop": stop, "ancestors": ancestors})
        self.conversations.append({"conv_id": conv_id, "path": [_span(s) for s in self._path()]})

    def row(self, number: int) -> pa.RecordBatch:
        columns = [
            pa.array([number], pa.int64()),
            pa.array([np.array(self.tokens, np.int32)], pa.list_(pa.int32())),
            pa.array([np.concatenate(self.positions)], pa.list_(pa.int32())),
            pa.array([[_span(s) for s in self.loss]], _PACK_ARROW.field("loss").type),
            pa.array([self.segments], _PACK_ARROW.field("segments").type),
            pa.array([self.conversations], _PACK_ARROW.field("conversations").type),
        ]
        return pa.record_batch(columns, schema=_PACK_ARROW)


def _packs(load: Callable[[], Template], pack_tokens: int, pack_conversations: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template, pack, number = load(), Pack(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in range(batch.num_rows):
                conv_id = batch.column("conv_id")[row].as_py()
                listed = batch.column("turns")[row].as_py()
                turns = [(turn["role"], turn["text"]) for turn in listed]
                kept = pack.shared(turns)
                new = template.turns(turns[kept:])
                size = len(pack.tokens) + sum(len(ids) for ids, _, _ in new)
                if pack.conversations and (
                    size > pack_tokens or len(pack.conversations) >= pack_conversations
                ):
                    yield pack.row(number)
                    pack, number = Pack(), number + 1
                    new = template.turns(turns[:kept]) + new
                    kept = 0
                pack.add(conv_id, turns, kept, new)
        if pack.conversations:
            yield pack.row(number)

    return run


def conversations_of(rows: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of role and text, by turn), with ``path``, a hash of every turn.

    Null roles and texts are empty, null turns come first, turns of equal number are put in the
    order of role and text.  Rows without ``conv_id`` make one conversation without id.  A
    conversation is one training example and is held whole by a task."""
    turn = F.struct(
        named("turn").alias("turn"),
        F.coalesce(named("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(named("text").cast("string"), F.lit("")).alias("text"),
    )
    listed = rows.select(named("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    grouped = listed.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select(
        "conv_id",
        F.transform(
            "turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
        ).alias("turns"),
        F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])).alias("path"),
    )


def pack_conversations(
    rows: DataFrame,
    folder: str = TOKENIZERS,
    tokenizer: str = BYTE_BPE,
    pack_tokens: int = PACK_TOKENS,
    pack_size: int = PACK_CONVERSATIONS,
) -> DataFrame:
    """All conversations of ``rows`` (``conv_id, turn, role, text``) as packs (``PACK``):

    - ``token_ids`` and ``position_ids``: a tree's turns depth first, each at the place it has in
      its conversations;
    - ``loss``: intervals of the tokens that are learned, the texts of the assistant alone;
    - ``segments``: a token attends to those before it in its segment and to all in ``ancestors``;
    - ``conversations``: the intervals that make each conversation.

    The order within a beginning is by ``conv_id``, so equal conversations, however many, spread
    over tasks.  Hashes only bring conversations together; turns are shared if they are equal."""
    importable(rows.sparkSession)
    found = conversations_of(rows)
    sorted_rows = found.repartitionByRange("path", "conv_id").sortWithinPartitions(
        "path", "conv_id"
    )
    path = os.path.join(folder, tokenizer)
    return sorted_rows.select("conv_id", "turns").mapInArrow(
        _packs(lambda: Template(path), pack_tokens, pack_size), PACK
    )


def _read(load: Callable[[], Template]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = load()
        for batch in batches:
            for row in range(batch.num_rows):
                pack = {name: batch.column(name)[row] for name in batch.schema.names}
                yield pa.RecordBatch.from_pylist(
                    list(_conversations(template, pack)), schema=_READ_ARROW
                )

    return run


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
_READ_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _conversations(template: Template, pack: dict) -> Iterator[dict]:
    tokens = pack["token_ids"].values.to_numpy().tolist()
    positions = pack["position_ids"].values.to_numpy()
    loss = pack["loss"].as_py()
    starts = [span["start"] for span in loss]
    for conversation in pack["conversations"].as_py():
        ids, learned, seen = [], [], []
        for span in conversation["path"]:
            start, stop = span["start"], span["stop"]
            ids += tokens[start:stop]
            seen.append(positions[start:stop])
            inside = range(bisect_left(starts, start), bisect_left(starts, stop))
            learned += [
                unescape(template.text(tokens[loss[k]["start"] : loss[k]["stop"]]))
                for k in inside
            ]
        if not np.array_equal(np.concatenate(seen), np.arange(len(ids))):
            raise ValueError("the positions of a conversation have gaps")
        text = template.text(ids)
        turns, end = [], 0
        for found in _TURN.finditer(text):
            if found.start() != end:
                break
            turns.append((unescape_role(found[1]), unescape(found[2])))
            end = found.end()
        if end != len(text):
            raise ValueError("a conversation does not follow the template")
        spoken = "".join(f"{role}\n{said}\n" for role, said in turns)
        loss_text = "".join(learned)
        yield {
            "conv_id": conversation["conv_id"],
            "n_turns": len(turns),
            "turns_sha256": hashlib.sha256(spoken.encode()).hexdigest(),
            "loss_chars": len(loss_text),
            "loss_sha256": hashlib.sha256(loss_text.encode()).hexdigest(),
            "formatted_chars": len(text),
        }


def read_back(packs: DataFrame, folder: str = TOKENIZERS, tokenizer: str = BYTE_BPE) -> DataFrame:
    """Every conversation (``READ``) as the tokens of ``packs`` have it: its turns, the text under
    the loss mask, and the length of the formatted text.  Raises where the positions have gaps or
    the text does not follow the template."""
    path = os.path.join(folder, tokenizer)
    return packs.mapInArrow(_read(lambda: Template(path)), READ)


def formatted(rows: DataFrame, folder: str = TOKENIZERS, tokenizer: str = BYTE_BPE) -> DataFrame:
    """``rows`` packed and stored, then read back.  An empty table has no rows."""
    packs = materialize(
        pack_conversations(rows, folder, tokenizer),
        "packs",
        {"parquet.block.row.count.limit": str(GROUP_PACKS)},
    )
    return read_back(packs, folder, tokenizer)
