"""Token ids as flat binary files.

Documents in order of their id are range-partitioned; every task encodes its range and writes
three flat little-endian files: `.bin` (token ids, u2 or u4 by the size of the vocabulary),
`.off` (u8 offsets of the documents in tokens, one more than documents) and `.ids` (i8 document
ids). A part knows only its own lengths; where it starts in the whole is a prefix sum over the
parts, kept in `index.json`. Readers map the files into memory.
"""

from __future__ import annotations

import json
import re
from array import array

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonal.llm.common import Finished, pieces, ship, store_of

# Distinct words a worker remembers the ids of; further ones are encoded each time they occur.
REMEMBERED = 1_000_000

# Words that a byte-level tokenizer surely cuts between letters, digits, line ends and other signs,
# and those pieces: printable ASCII without quotes of contractions or "<", Latin, Cyrillic and Han letters,
# and line ends that stand alone.
LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u4e00-\u9fa5"
PLAIN = re.compile(rf"(?:[!-&(-;=-~{LETTERS}]|\n(?!\n))+")
PIECES = re.compile(rf"[{LETTERS}]+|[0-9]+|\n|[^{LETTERS}0-9\n]+")

# The character that such a tokenizer writes for a byte where it is not the one of that code.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = {byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in _SHOWN)}

_encoders: dict = {}


def cuts_plainly(tokenizer) -> bool:
    """Whether a tokenizer does nothing to a plain word but cut it into pieces, byte by byte, and
    hand these to its model."""
    setup = json.loads(tokenizer.to_str())
    cutter = setup["pre_tokenizer"] or {}
    usual = cutter.get("type") == "ByteLevel" and cutter.get("use_regex") and not cutter.get("add_prefix_space")
    other = [setup[k] for k in ("normalizer", "post_processor", "truncation", "padding")]
    added = [t["content"] for t in setup["added_tokens"]]
    return bool(usual) and not any(other) and not any(PLAIN.fullmatch(x) or " " in x.strip(" ") for x in added)


def unsafe(word: str) -> bool:
    """Whether a cut before the space ahead of this word could move a token border: white space or
    the end follows that space."""
    return not word or word[0].isspace()


class Encoder:
    """The tokenizer, with a memory of words. Before a space that follows anything and precedes
    a visible character, a byte-level tokenizer always starts a new piece, so ids of a text are
    the ids of its space-separated words, each with the space before it. Texts with other
    spacing go to the tokenizer whole. Only for tokenizers whose pieces do not cross such spaces
    (`by_words`); others always get the whole text. Plain words that are new go to the tokenizer's
    model piece by piece, where that is all the tokenizer would do."""

    def __init__(self, path: str, by_words: bool):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = by_words
        self.model = self.tokenizer.model if by_words and cuts_plainly(self.tokenizer) else None
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.known: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        batch = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in batch]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole, unfinished, new, new_firsts = [], [], set(), set()
        look, look_first = self.known.get, self.firsts.get
        for k, text in enumerate(texts):
            if not self.by_words:
                whole.append(k)
                continue
            words = text.split(" ")
            found = list(map(look, words))
            found[0] = look_first(words[0])
            if None not in found:
                out[k] = b"".join(found)
                continue
            gaps = [n for n, ids in enumerate(found) if ids is None]
            # unsafe words are never remembered, so they are among the gaps
            if any(n and unsafe(words[n]) for n in gaps):
                whole.append(k)
                continue
            if gaps[0] == 0:
                new_firsts.add(words[0])
            new.update([words[n] for n in gaps if n])
            unfinished.append((k, words, found, gaps))
        held = self._learned(self.known, new, " ")
        held_firsts = self._learned(self.firsts, new_firsts, "")
        for k, words, found, gaps in unfinished:
            for n in gaps:
                found[n] = held[words[n]] if n else held_firsts[words[0]]
            out[k] = b"".join(found)
        for k, ids in zip(whole, self.ids([texts[k] for k in whole]) if whole else []):
            out[k] = ids
        return out

    def _of_pieces(self, before: str, word: str) -> bytes:
        """Ids of a plain word, as the model has them for its pieces."""
        if word.isalpha():
            return self._of_piece(before, word)
        first, *others = PIECES.findall(word)
        return self._of_piece(before, first) + b"".join([self._of_piece("", piece) for piece in others])

    def _of_piece(self, before: str, piece: str) -> bytes:
        known = self.known if before else self.firsts
        ids = known.get(piece)
        if ids is None:
            shown = before + piece if piece.isascii() else (before + piece).encode().decode("latin-1")
            ids = array(self.code, [t.id for t in self.model.tokenize(shown.translate(BYTES))]).tobytes()
            if len(known) < REMEMBERED:
                known[piece] = ids
        return ids

    def _learned(self, known: dict, new: set, before: str) -> dict:
        """Ids of new words, remembered while there is room."""
        if not new:
            return {}
        held = {}
        if self.model is not None:
            held = {w: self._of_pieces(before, w) for w in new if PLAIN.fullmatch(w)}
        words = [w for w in new if w not in held]
        held.update(zip(words, self.ids([before + w for w in words])))
        if len(known) < REMEMBERED:
            known.update(held)
        return held


def encoder(path: str, by_words: bool) -> Encoder:
    """One encoder per worker and tokenizer."""
    if (path, by_words) not in _encoders:
        _encoders[path, by_words] = Encoder(path, by_words)
    return _encoders[path, by_words]


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    parts: int | None = None,
    by_words: bool = True,
) -> dict:
    """Encode `doc_id`, `text` into files below `folder` and return the index, also written as
    `index.json`: per part its name, documents, NULL ids, tokens, and `base_doc`, `base_token`.

    NULL text: as an empty one, that is the end id alone. NULL doc_ids come first; rows with the
    same id are ordered by a hash of their texts. Empty table: an index without parts. Other
    columns are not read. `parts` is the number of files, by default that of shuffle partitions."""
    spark = docs.sparkSession
    ship(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def write(batches):
        import numpy as np
        from pyspark import TaskContext
        import pyarrow as pa

        store, path = store_of(folder)
        known = encoder(tokenizer, by_words)
        end = np.asarray([end_id], dtype=known.dtype).tobytes()
        width = np.dtype(known.dtype).itemsize
        number, out, nulls = TaskContext.get().partitionId(), None, 0
        lengths, ids = [], []
        for batch in batches:
            if out is None and batch.num_rows:
                out = Finished(store, f"{path}/part-{number:05d}.bin")
            held = batch.column(0)
            nulls += held.null_count
            ids.append(held.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            for first, last in pieces(batch.column(1), 1 << 19):
                for tokens in known.encode(batch.column(1).slice(first, last - first).to_pylist()):
                    out.write(tokens)
                    out.write(end)
                    lengths.append(len(tokens) // width + 1)
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype="int64")]).astype("<u8")
        for suffix, data in (("off", offsets.tobytes()), ("ids", np.concatenate(ids).tobytes())):
            side = Finished(store, f"{path}/part-{number:05d}.{suffix}")
            side.write(data)
            side.close()
        row = {"part": [number], "docs": [len(lengths)], "null_ids": [nulls], "tokens": [int(offsets[-1])]}
        row["dtype"] = [known.dtype]
        yield pa.RecordBatch.from_pydict(row, schema=_schema())

    def _schema():
        import pyarrow as pa

        return pa.schema([(n, pa.int64()) for n in ("part", "docs", "null_ids", "tokens")] + [("dtype", pa.string())])

    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    written = rows.mapInArrow(write, "part bigint, docs bigint, null_ids bigint, tokens bigint, dtype string")
    entries, base_doc, base_token = [], 0, 0
    for row in sorted(written.collect()):  # one row per file
        entry = row.asDict() | {"base_doc": base_doc, "base_token": base_token}
        entries.append(entry)
        base_doc, base_token = base_doc + row["docs"], base_token + row["tokens"]
    index = {"docs": base_doc, "tokens": base_token, "parts": entries}
    out = Finished(store, f"{path}/index.json")
    out.write(json.dumps(index).encode())
    out.close()
    return index


def read_index(folder: str) -> dict:
    """The index of a token folder."""
    store, path = store_of(folder)
    with store.open_input_stream(f"{path}/index.json") as stream:
        return json.loads(stream.read())


class Part:
    """One part's files, mapped into memory where the file system allows it."""

    def __init__(self, folder: str, entry: dict):
        import numpy as np

        store, path = store_of(folder)
        name = f"{path}/part-{entry['part']:05d}"

        def mapped(suffix, dtype):
            with store.open_input_file(f"{name}.{suffix}") as file:
                return np.frombuffer(file.read_buffer(), dtype=dtype)

        self.tokens = mapped("bin", entry["dtype"])
        self.offsets = mapped("off", "<u8")
        self.doc_ids = mapped("ids", "<i8")
        self.null_ids, self.base_token = entry["null_ids"], entry["base_token"]

    def document(self, k: int):
        """Token ids of the k-th document of the part."""
        return self.tokens[int(self.offsets[k]) : int(self.offsets[k + 1])]


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, read from the files: doc_id, start (tokens of all documents before
    it), n_tokens, ids_crc32 over its ids as unsigned 32-bit numbers. One task per file."""
    ship(spark)
    parts = read_index(folder)["parts"]

    def read(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in batch.column(0).to_pylist():
                part = Part(folder, parts[k])
                n = len(part.doc_ids)
                crc = [zlib.crc32(part.document(i).astype("<u4").tobytes()) for i in range(n)]
                starts = part.offsets[:-1].astype("int64") + part.base_token
                ids = pa.array(part.doc_ids, mask=np.arange(n) < part.null_ids)
                lengths = (part.offsets[1:] - part.offsets[:-1]).astype("int64")
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    numbers = spark.range(0, len(parts), 1, max(1, len(parts)))
    return numbers.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
