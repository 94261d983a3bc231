"""Finding test items in training text.

Words of an item and of a document meet on trigrams. Common trigrams meet everywhere by chance,
so an item is looked for by its rare ones: those in at most one of 10,000 documents, or in no more
than twice as many as its own median trigram, since an item with many copies makes its own
trigrams frequent. Where a rare trigram of an item occurs, the passage around it is aligned to the item by
Smith-Waterman, which scores exact, edited and paraphrased copies on one scale.

Items are taken in blocks of bounded size, each of which is sent to all tasks and read against the
whole corpus; documents stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonal.llm.common import pieces, ship
from zonal.llm.words import Tokens, mixed
from zonal.operators.staging import stage

# Items and words of a block: what one task holds of the test sets at a time.
BLOCK_ITEMS = 4_000
BLOCK_WORDS = 400_000

MATCH, MISMATCH, GAP = 2, -1, -1

# Alignment score, as a part of the score of the item with itself, from which it counts as a leak.
LEAK = 0.4

# A trigram in at most this part of all documents, or in this number of them, is rare.
RARE_PART, RARE_DOCS = 1e-4, 8


def lowered(texts):
    """Words of texts in lower case; a word is a run of letters, digits and marks above ASCII."""
    import pyarrow.compute as pc

    tokens = Tokens(pc.utf8_lower(texts))
    word = ~tokens.mark
    return tokens.hash[word], tokens.doc[word]


def trigrams(words, doc):
    """Hash and place of every trigram that lies in one text."""
    inside = np.flatnonzero(doc[2:] == doc[:-2]) if len(words) > 2 else np.zeros(0, dtype="i8")
    three, five = np.uint64(3), np.uint64(5)
    return mixed(words[inside] + words[inside + 1] * three + words[inside + 2] * five, 30), inside


class Items:
    """A block of test items: their words, their trigrams, and where each trigram stands."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        import pyarrow as pa

        words, doc = lowered(pa.array(texts, pa.string()))
        self.ids = ids
        self.words = [words[doc == k] for k in range(len(ids))]
        grams, at = trigrams(words, doc)
        first = np.searchsorted(doc, np.arange(len(ids)))
        order = np.argsort(grams, kind="stable")
        self.gram, self.item = grams[order], doc[at][order]
        self.at = (at - first[doc[at]])[order]
        self.seen = np.unique(grams)
        self.seed = np.zeros(len(self.gram), dtype=bool)

    def choose_seeds(self, common, docs: int) -> None:
        """Take every item's rare trigrams, given in how many of all documents each occurs. What
        occurs nowhere has no say in the median."""
        often = common[np.searchsorted(self.seen, self.gram)]
        level = max(RARE_DOCS, RARE_PART * docs)
        for k in range(len(self.ids)):
            mine = np.flatnonzero((self.item == k) & (often > 0))
            if len(mine):
                self.seed[mine] = often[mine] <= max(level, 2 * np.median(often[mine]))
        gram, item, at = self.gram[self.seed], self.item[self.seed], self.at[self.seed]
        self.gram, self.item, self.at = gram, item, at
        self.keys, self.key_first, self.key_count = np.unique(gram, return_index=True, return_counts=True)

    def hits(self, grams):
        """Places in `grams` where a seed occurs, with item and place in the item."""
        at = np.searchsorted(self.keys, grams)
        at[at == len(self.keys)] = 0
        found = np.flatnonzero(self.keys[at] == grams) if len(self.keys) else np.zeros(0, dtype="i8")
        key = at[found] if len(found) else found
        counts = self.key_count[key] if len(found) else found
        place = np.repeat(found, counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) if len(found) else found
        entry = np.repeat(self.key_first[key], counts) + offset if len(found) else found
        return place, self.item[entry], self.at[entry]


def align(passage, item) -> tuple[int, int, int]:
    """Smith-Waterman: best local score, and the first and last word (excluded) of the passage that
    are aligned. A row per word of the item; along a row, gaps are a running maximum. Every cell
    carries the word its alignment starts at. Ties: the alignment that needs fewer words of the item,
    then the one that ends first."""
    n = len(passage)
    places = np.arange(n + 1)
    steps = places * GAP
    before, starts = np.zeros(n + 1, dtype="i8"), places
    best, begin, end = 0, 0, 0
    for word in item:
        row, start = np.zeros(n + 1, dtype="i8"), places.copy()
        both, skipped = before[:-1] + np.where(passage == word, MATCH, MISMATCH), before[1:] + GAP
        row[1:] = np.maximum(np.maximum(both, skipped), 0)
        start[1:] = np.where(row[1:] == 0, places[1:], np.where(both >= skipped, starts[:-1], starts[1:]))
        level = row - steps
        highest = np.maximum.accumulate(level)
        start = start[np.maximum.accumulate(np.where(level == highest, places, 0))]
        row = highest + steps
        top = int(row.argmax())
        if row[top] > best:
            best, begin, end = int(row[top]), int(start[top]), top
        before, starts = row, start
    return best, begin, end


def blocks_of(items: DataFrame) -> Iterator[Items]:
    """Items (item_id, text) in blocks, streamed through the driver one block at a time."""
    ids, texts, size = [], [], 0
    for row in items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("bigint"), "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1]) // 4
        if len(ids) == BLOCK_ITEMS or size >= BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def document_counts(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """In how many documents each trigram of a block occurs, over the whole corpus, and how many
    documents there are. The result has one number per trigram of the block."""
    seen = items.seen

    def count(batches):
        import pyarrow as pa

        total, docs_read = np.zeros(len(seen), dtype="i8"), 0
        for batch in batches:
            texts = batch.column(0)
            docs_read += len(texts)
            for first, last in pieces(texts):
                words, doc = lowered(texts.slice(first, last - first))
                grams, at = trigrams(words, doc)
                place = np.searchsorted(seen, grams)
                place[place == len(seen)] = 0
                known = seen[place] == grams
                pairs = np.unique(doc[at][known].astype("i8") * len(seen) + place[known])
                total += np.bincount(pairs % len(seen), minlength=len(seen))
        kept = np.flatnonzero(total)
        grams, counts = np.append(kept, -1), np.append(total[kept], docs_read)
        yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts)], ["gram", "n"])

    common = np.zeros(len(seen), dtype="i8")
    if not len(seen):
        return common, 0
    rows = docs.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n"))
    counts = dict(tuple(row) for row in rows.collect())
    read = counts.pop(-1, 0)
    for gram, n in counts.items():
        common[gram] = n
    return common, read


def leaks_in(texts, items: Items, leak: float):
    """(text, item, score, first word, last word) of every item that leaks into a text."""
    for first, last in pieces(texts):
        words, doc = lowered(texts.slice(first, last - first))
        grams, at = trigrams(words, doc)
        place, item, offset = items.hits(grams)
        if not len(place):
            continue
        start = at[place]
        text = doc[start]
        bounds = np.searchsorted(doc, np.arange(last - first + 1))
        order = np.lexsort((start - offset, item, text))
        found: dict[tuple[int, int], tuple] = {}
        reach = -1
        owner: tuple[int, int] | None = None
        low = 0

        def close():
            if owner is None:
                return
            t, k = owner
            a, b = max(low, int(bounds[t])), min(reach, int(bounds[t + 1]))
            score, begin, end = align(words[a:b], items.words[k])
            part = score / (MATCH * len(items.words[k]))
            if part >= leak and (owner not in found or part > found[owner][0]):
                found[owner] = (part, a - int(bounds[t]) + begin, a - int(bounds[t]) + end)

        for n in order:
            k = int(item[n])
            length = len(items.words[k])
            margin = length // 3 + 4
            begin = int(start[n] - offset[n]) - margin
            end = int(start[n] - offset[n]) + length + margin
            if owner == (int(text[n]), k) and begin <= reach:
                reach = max(reach, end)
                continue
            close()
            owner, low, reach = (int(text[n]), k), begin, end
        close()
        for (t, k), (part, begin, end) in found.items():
            yield first + t, k, part, begin, end


def prepared(docs: DataFrame, items: DataFrame) -> list[Items]:
    """Blocks of items with their seeds chosen over the whole corpus."""
    ship(docs.sparkSession)
    blocks = []
    for block in blocks_of(items):
        block.choose_seeds(*document_counts(docs, block))
        blocks.append(block)
    return blocks


def find_leaks(docs: DataFrame, items: DataFrame, leak: float = LEAK) -> DataFrame:
    """Documents (doc_id, text) that hold items (item_id, text): doc_id, item_id, score (1 for a
    whole exact copy), first_word and last_word (excluded) of the aligned passage. Of several places
    the one with the best score is told, of equal ones the first.

    Case and punctuation do not count. NULL or empty texts hold nothing, and neither are items
    below three words found. Rows that repeat an id are reported each. No documents or no items:
    no rows. Other columns are not read."""
    result = None
    schema = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"
    for block in prepared(docs, items):

        def run(batches, block=block):
            import pyarrow as pa

            for batch in batches:
                ids = batch.column(0)
                rows = list(leaks_in(batch.column(1), block, leak))
                columns = [
                    ids.take(pa.array([r[0] for r in rows], pa.int64())),
                    pa.array([block.ids[r[1]] for r in rows], pa.int64()),
                    pa.array([round(r[2], 6) for r in rows], pa.float64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[4] for r in rows], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "first_word", "last_word"])

        found = stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema))
        result = found if result is None else result.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def without_leaks(docs: DataFrame, items: DataFrame, leak: float = LEAK) -> DataFrame:
    """The rows of `docs` that hold no item, all columns as they are."""
    at = docs.columns.index("text")
    for block in prepared(docs, items):

        def run(batches, block=block):
            import pyarrow as pa

            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[row[0] for row in leaks_in(batch.column(at), block, leak)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
