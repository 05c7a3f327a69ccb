"""Chat formatting by columnar byte assembly (operator 1).

Template: a turn is ``<s>ROLE\\nTEXT</s>\\n``.  Control strings inside a text, ``<s>``,
``</s>``, ``[INST]`` and ``[/INST]``, get a backslash after their first character
(and one more where backslashes already stand there), so no text can hold one and
taking one backslash away restores it.  A role is escaped the same way, and then its
backslashes and line ends, so a header ends at its first line end.

Assembly: segment lengths of all turns of a batch, their running sums, and scatter
indices in numpy; headers, texts and footers are copied into one preallocated buffer
that becomes the Arrow string column without another copy.

Rows come in the order of turns within a conversation (null turns first, then by
role and text).  A conversation is one row unless it passes ``block_bytes``; then it
goes on in further rows of the same ``conv_id`` with the next ``block``, so a
conversation of any length streams through its task.

Nulls and ties: a null text or role is empty; a null ``conv_id`` is a conversation of
its own; rows of one turn all stay, in the order above; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col

OPEN, MIDDLE, CLOSE = b"<s>", b"\n", b"</s>\n"
#: A control string with any number of backslashes after its first character.
ESCAPE = r"(<)(\\*/?s>)|(\[)(\\*/?INST\])"
UNESCAPE = re.compile(rb"([<\[])\\(\\*)(?=/?s>|/?INST\])")
TRAINED = b"assistant"


def _plain(match) -> bytes:
    # "<\...s>" and "[\...INST]" only: a bracket of the other kind is no control string.
    return match[0] if (match[1] == b"<") != (match.string[match.end() : match.end() + 3].lstrip(b"/")[:2] == b"s>") else match[1] + match[2]


def unescape(text: bytes) -> bytes:
    return UNESCAPE.sub(_plain, text) if b"\\" in text else text


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, ESCAPE, r"\1\3\\\2\4")


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, lengths and bytes of a large string column without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return at[:-1], np.diff(at), np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Rows of formatted turns: a new row starts at every index of ``first``.

    Returns the rows, and per turn the place of its text in the whole buffer (start, length).
    """
    n = len(texts)
    role_at, role_n, role_bytes = _parts(roles)
    text_at, text_n, text_bytes = _parts(texts)
    fixed = [np.frombuffer(x, np.uint8) for x in (OPEN, MIDDLE, CLOSE)]
    lengths = np.empty((n, 5), np.int64)
    lengths[:, 0], lengths[:, 1], lengths[:, 2], lengths[:, 3], lengths[:, 4] = len(OPEN), role_n, len(MIDDLE), text_n, len(CLOSE)
    end = np.cumsum(lengths.ravel()).reshape(n, 5)
    start = end - lengths
    out = np.empty(int(end[-1, -1]) if n else 0, np.uint8)
    for k, part in zip((0, 2, 4), fixed):
        out[(start[:, k, None] + np.arange(len(part))).ravel()] = np.tile(part, n)
    for k, at, size, data in ((1, role_at, role_n, role_bytes), (3, text_at, text_n, text_bytes)):
        if n:
            source = data[at[0] : at[0] + size.sum()]  # segments lie one after the other
            out[np.arange(len(source)) + np.repeat(start[:, k] - (at - at[0]), size)] = source
    offsets = np.concatenate([start[first, 0], [len(out)]]).astype(np.int64)
    rows = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return rows, start[:, 3], lengths[:, 3]


SCHEMA = "block bigint, n_turns bigint, formatted string, mask_start array<bigint>, mask_length array<bigint>"


def conversations(turns: DataFrame, block_bytes: int = 1 << 20, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, block, n_turns, formatted, mask_start, mask_length``.

    The mask is the byte spans of the texts to be trained on (the assistant's), within ``formatted``.
    """
    rows = turns.select(
        col(conv_col).alias("conv_id"), col(turn_col).alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def emit(conv: pa.Array, roles: pa.Array, texts: pa.Array, number: dict) -> pa.RecordBatch:
        names = pc.replace_substring(pc.replace_substring(escape(roles), "\\", "\\\\"), "\n", "\\n")
        texts = escape(texts)
        size = pc.binary_length(texts).to_numpy().astype(np.int64)
        change = np.r_[True, ~_same(conv)]
        conv_number = np.cumsum(change) - 1
        # A long conversation is cut where its bytes pass another multiple of the block size.
        upto = np.cumsum(size)
        base = (upto - size)[change][conv_number]
        part = (upto - size - base) // block_bytes
        first = np.flatnonzero(change | np.r_[True, part[1:] != part[:-1]])
        out, start, length = assemble(names, texts, first)
        n = np.diff(np.r_[first, len(texts)])
        trained = pc.equal(roles, TRAINED.decode()).to_numpy(zero_copy_only=False)
        edge = np.r_[0, np.cumsum(np.add.reduceat(trained.astype(np.int64), first))].astype(np.int32)
        begin = start - np.repeat(np.frombuffer(out.buffers()[1], np.int64)[: len(first)], n)
        spans = [pa.ListArray.from_arrays(pa.array(edge), pa.array(x[trained])) for x in (begin, length)]
        keys = conv.take(pa.array(first))
        # Blocks of a conversation go on from the batch before.
        block = np.arange(len(first)) - np.flatnonzero(change[first])[np.cumsum(change[first]) - 1]
        if len(first) and number.get("conv", ()) == (keys[0].as_py(),):
            block[conv_number[first] == 0] += number["next"]
        number["conv"], number["next"] = (keys[-1].as_py(),), int(block[-1]) + 1
        return pa.RecordBatch.from_arrays([keys, pa.array(block), pa.array(n), out.cast(pa.string()), *spans], names=["conv_id", *[x.split()[0] for x in SCHEMA.split(", ")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, {}
        for b in batches:
            b = pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.large_string()), b.column(2).cast(pa.large_string())], names=["c", "r", "t"])
            held = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            same = _same(held.column(0))
            ends = np.flatnonzero(~same)
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield emit(*held.slice(0, cut).columns, number)
                held = held.slice(cut)
            if held.nbytes > 4 * block_bytes:  # one long conversation: what has come so far
                yield emit(*held.columns, number)
                held = None
        if held is not None and len(held):
            yield emit(*held.columns, number)

    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind), *T.StructType.fromDDL(SCHEMA).fields])
    return rows.mapInArrow(run, schema)


def _same(column: pa.Array) -> np.ndarray:
    """Whether each value equals the next one (null equals null)."""
    a, b = column.slice(0, max(0, len(column) - 1)), column.slice(1)
    equal = pc.fill_null(pc.equal(a, b), False)
    return pc.or_(equal, pc.and_(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False).astype(bool)


def parse(formatted: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The (role, text) pairs of formatted turns."""
    for turn in formatted.split(CLOSE)[:-1]:
        role, _, text = turn[len(OPEN) :].partition(MIDDLE)
        if b"\\" in role:
            role = unescape(re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], role))
        yield role, unescape(text)


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests per conversation, read back from the formatted rows.

    ``formatted`` has the blocks of a conversation together and in order; the digests
    are carried from row to row, so no conversation is gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            conv, turns, sha, chars, loss, total = now
            columns = [pa.array([conv], kind), *(pa.array([x]) for x in (turns, sha.hexdigest(), chars, loss.hexdigest(), total))]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        now, kind = None, None
        for b in batches:
            kind = b.column(0).type
            out = []
            for conv, block, text, starts, sizes in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(done())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[5] += len(text)
                text = text.encode()
                for role, said in parse(text):
                    now[1] += 1
                    now[2].update(role + b"\n" + said + b"\n")
                for s, n in zip(starts, sizes):
                    said = unescape(text[s : s + n])
                    now[3] += len(said.decode())
                    now[4].update(said)
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        if now is not None:
            yield done()

    schema = T.StructType([formatted.schema["conv_id"]]).add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")
    rows = formatted.select("conv_id", "block", "formatted", "mask_start", "mask_length").sortWithinPartitions("conv_id", "block")
    return rows.mapInArrow(run, schema)
