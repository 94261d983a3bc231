"""Chat formatting with a loss mask aligned to tokens.

A conversation is rendered whole, noting where each text lies, and encoded once. The tokens'
offsets and the turns' spans are both sorted, so the tokens of a turn are two binary searches. The
marks of turns are cut off before the tokenizer's own rules see the text, so no token reaches across
the border of a text, and the mask holds all of a learned text and nothing else.

A turn is `<turn ROLE>TEXT</turn>` and a line end. Inside role and text a backslash is doubled
and whatever could open or close a turn gets a backslash before it, so any text survives and
no text can pose as a turn.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import ship

CONTROL = re.compile(r"\\|<(?=/?turn)")
ROLE_CONTROL = re.compile(r"[\\>]")
ESCAPE = r"\\\g<0>"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*+)>((?:[^\\<]++|\\.|<(?!/?turn))*+)</turn>\n", re.DOTALL)

# What the tokenizer takes as pieces of their own: marks, and escapes, lest one be taken for a mark.
PIECE = r"\\[\s\S]|<turn (?:[^\\>]|\\[\s\S])*>|</turn>\n"

COLUMNS = (
    "conv_id bigint, n_turns bigint, formatted string, tokens array<int>, loss_mask array<tinyint>, "
    "loss_spans array<struct<first:int,last:int>>"
)

_encoders: dict = {}


def escape(text: str) -> str:
    """Text as it may stand inside a turn."""
    return CONTROL.sub(ESCAPE, text)


def unescape(text: str) -> str:
    """The text that was escaped."""
    return ESCAPED.sub(r"\1", text)


def render(turns) -> tuple[str, list[tuple[int, int, str]]]:
    """(role, text) pairs to the formatted conversation and the span and role of each text."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"<turn {ROLE_CONTROL.sub(ESCAPE, role)}>"
        body = escape(text)
        spans.append((at + len(head), at + len(head) + len(body), role))
        out += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    found, at = [], 0
    while at < len(formatted):
        turn = TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at character {at}")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


def loss_of(spans, starts, ends, learned: frozenset):
    """Mask over tokens, and the spans of characters under it, one for a learned text: those of
    the tokens that lie inside the text, as they stand."""
    import numpy as np

    mask = np.zeros(len(starts), dtype="i1")
    under = []
    for first, last, role in spans:
        if role not in learned or first == last:
            continue
        i = int(np.searchsorted(starts, first, "left"))
        j = int(np.searchsorted(ends, last, "right"))
        if i < j:
            mask[i:j] = 1
            under.append((int(starts[i]), int(ends[j - 1])))
    return mask, under


def format_chats(rows: DataFrame, tokenizer: str, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, turn, role, text) to one row per conversation: conv_id, n_turns, the
    formatted text, its token ids, their loss mask, and the spans of characters under the mask.

    Turns go by `turn` (NULL first), then role and text, so ties have one order; repeated rows are
    turns each. NULL role or text: empty. NULL conv_id: a conversation of its own. No rows: no
    rows. Other columns are not read. A task streams through sorted rows and holds one
    conversation at a time, which rendering and encoding it whole calls for."""
    ship(rows.sparkSession)
    roles = frozenset(learned)
    empty = F.lit("")
    held = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    together = held.repartition("conv_id").sortWithinPartitions(*order)

    def run(batches):
        for done in _bundles(_conversations(batches)):
            yield _encoded(done, tokenizer, roles)

    return together.mapInArrow(run, COLUMNS)


def _conversations(batches):
    """Conversations of a sorted stream of rows."""
    current, turns, started = None, [], False
    for batch in batches:
        ids, _, roles, texts = [c.to_pylist() for c in batch.columns]
        for conv, role, text in zip(ids, roles, texts):
            if not started or conv != current:
                if started:
                    yield current, turns
                current, turns, started = conv, [], True
            turns.append((role, text))
    if started:
        yield current, turns


def _bundles(conversations, most: int = 1 << 18):
    """Lists of rendered conversations with about `most` characters."""
    bundle, size = [], 0
    for conv, turns in conversations:
        formatted, spans = render(turns)
        bundle.append((conv, formatted, spans))
        size += len(formatted)
        if size >= most:
            yield bundle
            bundle, size = [], 0
    if bundle:
        yield bundle


def encoder(tokenizer: str):
    """The tokenizer of a file, which never joins the marks of a turn to its text."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Regex, Tokenizer, pre_tokenizers

    if tokenizer not in _encoders:
        known = Tokenizer.from_file(tokenizer)
        known.encode_special_tokens = True  # control strings of the tokenizer are text here
        cut = pre_tokenizers.Split(Regex(PIECE), "isolated")
        own = known.pre_tokenizer
        known.pre_tokenizer = cut if own is None else pre_tokenizers.Sequence([cut, own])
        _encoders[tokenizer] = known
    return _encoders[tokenizer]


def _encoded(bundle, tokenizer: str, learned: frozenset):
    import numpy as np
    import pyarrow as pa

    encodings = encoder(tokenizer).encode_batch([b[1] for b in bundle], add_special_tokens=False)
    columns: dict = {n: [] for n in ("conv_id", "n_turns", "formatted", "tokens", "loss_mask", "loss_spans")}
    for (conv, formatted, spans), encoding in zip(bundle, encodings):
        offsets = np.array(encoding.offsets, dtype="i8").reshape(-1, 2)
        mask, under = loss_of(spans, offsets[:, 0], offsets[:, 1], learned)
        columns["conv_id"].append(conv)
        columns["n_turns"].append(len(spans))
        columns["formatted"].append(formatted)
        columns["tokens"].append(np.array(encoding.ids, dtype="i4"))
        columns["loss_mask"].append(mask)
        columns["loss_spans"].append([{"first": a, "last": b} for a, b in under])
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int8()), pa.list_(span)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), types)], list(columns))


def digest_chats(chats: DataFrame) -> DataFrame:
    """From formatted conversations alone: conv_id, n_turns, turns_sha256 (role, line end, text,
    line end per turn), loss_chars and loss_sha256 (the text under the mask, unescaped),
    formatted_chars."""
    ship(chats.sparkSession)
    rows = chats.select("conv_id", "formatted", "loss_spans.first", "loss_spans.last")

    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for formatted, firsts, lasts in zip(*[c.to_pylist() for c in batch.columns[1:]]):
                turns = parse(formatted)
                whole = hashlib.sha256()
                for role, text in turns:
                    whole.update(f"{role}\n{text}\n".encode())
                learned = "".join(unescape(formatted[a:b]) for a, b in zip(firsts, lasts))
                row = (len(turns), whole.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted))
                for column, value in zip(out, row):
                    column.append(value)
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [batch.column(0), *[pa.array(c, t) for c, t in zip(out, types)]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
