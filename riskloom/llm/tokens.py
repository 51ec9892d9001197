"""The word-end BPE tokenizer file of the packing and encoding operators.

ASCII white space separates pre-tokens, so a text's ids are its words' ids in turn. Words of
printable ASCII and plain Latin letters are lower-cased and split into pre-tokens by Arrow;
other words (and those that may hold a special token) go through the library's own normaliser and
pre-tokenizer. Only distinct pre-tokens are encoded; their ids are kept between slices up to a
bound of entries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that the Arrow path may split: no white space, no combining marks, no case exceptions.
PLAIN_WORD = "^[!-~À-ÖØ-öø-įı-ňŊ-ž]+$"
#: The file's pre-token pattern.
PRE_TOKEN = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"
WORD_END = "</w>"
#: A lower-cased word that is one pre-token.
LETTERS = "^[a-zß-öø-įı-ňŊ-ž]+$"


def _byte_alphabet() -> dict[int, str]:
    """Bytes as the characters of the byte-level alphabet: printable Latin-1 stays, the others follow U+0100."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(256 + i) for i, b in enumerate(moved)}


BYTE_ALPHABET = _byte_alphabet()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_tokenizer(path: str | None = None) -> str:
    """The tokenizer file's content; the driver reads it and ships it with the tasks (a few MB)."""
    with open(path or default_path(), encoding="utf-8") as f:
        return f.read()


class LibraryIds:
    """Ids of pre-tokens and of unusual words by the tokenizers library."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def pre_tokens(self, pre: list[str]) -> list[bytes]:
        """By the model alone: a lower-cased pre-token only lacks the byte alphabet of the file."""
        tokenize = self.tokenizer.model.tokenize
        return [np.array([t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_ALPHABET))], dtype="<u4").tobytes()
                for p in pre]

    def word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()


class IdTable:
    """Ids of strings, kept as flat arrays up to ``limit`` strings; ``make`` gives the ids of new ones as
    (ids in turn, offsets)."""

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit
        self.clear()

    def clear(self) -> None:
        self.keys = pa.array([], pa.large_string())
        self.pool, self.offsets = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def __call__(self, keys: pa.Array) -> np.ndarray:
        """Where each of some distinct strings is: its ids are pool[offsets[i]:offsets[i + 1]]."""
        keys = keys.cast(pa.large_string())
        at = pc.index_in(keys, value_set=self.keys)
        if len(self.keys) + at.null_count > self.limit and len(self.keys):
            self.clear()
            at = pa.nulls(len(keys), pa.int32())
        if at.null_count:
            new = keys.filter(at.is_null())
            pool, offsets = self.make(new)
            first = len(self.keys)
            self.keys = pa.concat_arrays([self.keys, new])
            self.pool = np.concatenate([self.pool, pool])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
            missing = at.is_null().to_numpy(zero_copy_only=False)
            out = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            out[missing] = first + np.arange(len(new))
            return out
        return at.to_numpy(zero_copy_only=False).astype(np.int64)

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the entries ``at`` in turn, offsets)."""
        size = self.offsets[at + 1] - self.offsets[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        return self.pool[np.repeat(self.offsets[at] - offsets[:-1], size) + np.arange(offsets[-1])], offsets


def flat_ids(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    return np.frombuffer(b"".join(blobs), dtype="<u4"), np.concatenate([[0], np.cumsum(size)])


class WordIds:
    """Ids of the distinct words of a slice; ``source`` encodes pre-tokens and unusual words. Words and
    pre-tokens that were seen before are looked up."""

    def __init__(self, source, limit: int = 400_000):
        self.source = source
        self.words = IdTable(self.new_words, limit)
        self.pre = IdTable(lambda keys: flat_ids(source.pre_tokens(keys.to_pylist())), limit)

    def __call__(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, offsets of each word's ids)."""
        return self.words.take(self.words(vocab))

    def new_words(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        usual = pc.and_(pc.match_substring_regex(vocab, PLAIN_WORD), pc.invert(pc.match_substring(vocab, "<|")))
        usual = usual.to_numpy(zero_copy_only=False)
        lower = pc.utf8_lower(vocab.filter(pa.array(usual)))
        spaced = pc.if_else(pc.match_substring_regex(lower, LETTERS), lower, "")
        mixed = pc.equal(spaced, "")
        spaced = pc.replace_with_mask(spaced, mixed, pc.replace_substring_regex(lower.filter(mixed), PRE_TOKEN, r"\1 "))
        lists = pc.ascii_split_whitespace(pc.utf8_rtrim_whitespace(spaced))
        flat = lists.flatten().dictionary_encode()
        at = self.pre(flat.dictionary)
        codes, cuts = flat.indices.to_numpy(), lists.offsets.to_numpy()
        of_usual, upto = self.pre.take(at[codes])
        odd = [self.source.word(w) for w in vocab.filter(pa.array(~usual)).to_pylist()]

        length = np.zeros(len(vocab), dtype=np.int64)
        start = np.zeros(len(vocab), dtype=np.int64)
        length[usual] = upto[cuts[1:]] - upto[cuts[:-1]]
        start[usual] = upto[cuts[:-1]]
        length[~usual] = [len(b) // 4 for b in odd]
        start[~usual] = upto[-1] + np.cumsum(length[~usual]) - length[~usual]
        pool = np.concatenate([of_usual, np.frombuffer(b"".join(odd), dtype="<u4")])
        offsets = np.concatenate([[0], np.cumsum(length)])
        return pool[np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])], offsets


#: One encoder of each kind and file in a worker process, shared by its tasks.
_MADE: dict[tuple, object] = {}


def once(key: tuple, make):
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = make()
    return _MADE[key]
