"""Arrow helpers for text stages: bounded slices, word codes, ragged gathers, joins of results to rows.

A word is a maximal run of characters other than space and U+0009..U+000D. Arrow splits a
slice of whole texts, and dictionary-encodes the words, so Python only handles each distinct
word of a slice once. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that a task handles at once (a longer single text is a slice of its own).
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The record batches cut so that a slice holds about ``limit`` bytes of ``text``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))
            pa.default_memory_pool().release_unused()  # workers live on; what a slice needed goes back


def unused(columns: list[str], prefix: str = "__") -> str:
    """``prefix``, lengthened until no column begins with it."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def plain(texts: pa.Array) -> pa.Array:
    """Nulls as empty texts, in a fresh array without an offset."""
    return pc.fill_null(texts.cast(pa.large_string()), "")


class Words:
    """The words of some texts: ``codes`` index ``vocab``; text i has codes[starts[i]:starts[i + 1]]."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy()
        encoded = lists.flatten().dictionary_encode()
        vocab, codes = encoded.dictionary, encoded.indices.to_numpy()
        empty = pc.index(vocab, "").as_py()
        if empty >= 0:  # the split leaves empty strings at the ends of a text
            keep = codes != empty
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            codes = codes[keep]
        self.vocab, self.codes, self.starts = vocab, codes, offsets.astype(np.int64)

    def __len__(self) -> int:
        return len(self.starts) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def doc(self) -> np.ndarray:
        """The text's index of each word."""
        return np.repeat(np.arange(len(self)), self.counts)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i], start[i] + 1, ... (length[i] of them) for all i in turn."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - length), length) + np.arange(total)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:starts[i + 1]], empty segments included."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[starts[1:]] - total[starts[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept between slices up to ``limit`` entries."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word.encode(), 0)
        return h

    def of(self, vocab: pa.Array) -> np.ndarray:
        words = vocab.to_pylist()
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def annotate(docs: DataFrame, text: str, schema: str, compute: Callable[[pa.RecordBatch], dict], keep: list[str] | None = None,
             limit: int = SLICE_BYTES) -> DataFrame:
    """Each row's ``keep`` columns (all of them by default) followed by the columns of ``schema``,
    which ``compute`` makes from a slice of (keep, text) of about ``limit`` bytes. A kept column whose name is in
    ``schema`` gives way to the computed one. Row-local: no shuffle."""
    made = T.StructType.fromDDL(schema)
    names = {f.name.lower() for f in made}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    read = list(dict.fromkeys([*kept, text]))
    out = T.StructType([*[docs.schema[c] for c in kept], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, limit):
            new = compute(part)
            cols = [part.column(c) for c in kept] + [new[f.name] for f in made]
            cols = [c if isinstance(c, pa.Array) else pa.array(c) for c in cols]
            del new
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *made.names])
            del cols

    return docs.select(*[docs[f"`{c}`"] for c in read]).mapInArrow(run, out)


def parts(vocab: pa.Array, pattern: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The matches of ``pattern`` (RE2, one group) in each lower-cased word, which must cover the word:
    (codes into the distinct parts, offsets of each word's codes, distinct parts)."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(vocab), pattern, r"\1 ")
    lists = pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(spaced))
    flat = lists.flatten().dictionary_encode()
    return flat.indices.to_numpy(), lists.offsets.to_numpy().astype(np.int64), flat.dictionary


def of_words(words: Words, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of whole texts in turn, and each text's start among them."""
    size = np.diff(offsets)[words.codes]
    out = codes[ragged(offsets[words.codes], size)]
    return out, np.concatenate([[0], np.cumsum(segment_sums(size, words.starts))])
