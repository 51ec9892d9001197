"""BPE encoding by backtracking over longest matches, decoding by an offset table.

An Aho-Corasick automaton over the vocabulary finds, in one pass over a pre-token, the longest
token that begins at each place. The encoder takes them from left to right; it accepts a token
only if the merges would keep it beside the token before it (the pair-compatibility table), else
tries the next shorter token that is its prefix, else goes back and marks the place as a dead
end. Each place is closed at most once, so the work is linear, and the ids are those that merging
by rank gives. Decoding gathers the tokens' bytes from one buffer by their offsets.

Defined results: a null text is empty (no ids, empty decoded text); repeated rows give equal rows;
an empty table gives no rows; computed columns replace kept columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm import text as tx
from riskloom.llm import tokens as tk

#: Added to the code of a pre-token's last symbol, which is a symbol of its own.
LAST = 0x4000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable Latin-1
    (no space, no soft hyphen), else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    held = set(shown)
    return [chr(b) if b in held else chr(next(hidden)) for b in range(256)]


def _closed(token: str) -> str:
    """A vocabulary string as symbols: one character each, the last one shifted at a word end."""
    if not token.endswith(tk.WORD_END):
        return token
    body = token[:-len(tk.WORD_END)]
    return body[:-1] + chr(ord(body[-1]) + LAST)


class Backtracking:
    """Encoder and decoder of a tokenizer file (a BPE model with word ends)."""

    def __init__(self, content: str):
        import ahocorasick
        from tokenizers import Tokenizer

        spec = json.loads(content)
        vocab: dict[str, int] = spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        library = Tokenizer.from_str(content)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special = special
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.byte_map = dict(enumerate(byte_symbols()))

        self.symbols = {i: _closed(t) for t, i in vocab.items()}
        self.ids = {s: i for i, s in self.symbols.items()}
        #: Merge rank of each token (bytes come before all merges), its two parts, and what a pair makes.
        self.rank = dict.fromkeys(vocab.values(), -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, both = (vocab[left], vocab[right]), vocab[left + right]
            self.made.setdefault(pair, rank)
            if both not in self.parts:
                self.parts[both], self.rank[both] = pair, rank
        self.automaton = ahocorasick.Automaton()
        for i, s in self.symbols.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        self.compatible: dict[tuple[int, int], bool] = {}

        texts = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in special.items()}}
        blobs = [(texts.get(i, "") + " ").encode() for i in range(max(texts) + 1)]
        self.table = np.frombuffer(b"".join(blobs), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])

    def prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, or -1."""
        if token not in self.shorter:
            s = self.symbols[token]
            self.shorter[token] = next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ids), -1)
        return self.shorter[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps ``left`` and ``right`` apart when each is whole.

        Going back through the merges, latest first, the pieces that touch at the border are the
        ones the merges saw at that time; a merge across it spoils the pair if it would have come
        before the merge that is being undone."""
        key = (left, right)
        if (known := self.compatible.get(key)) is not None:
            return known
        undone, ok = float("inf"), True
        while True:
            across = self.made.get((left, right))
            if across is not None and across < undone:
                ok = False
                break
            of_left, of_right = self.rank[left], self.rank[right]
            if of_left < 0 and of_right < 0:
                break
            if of_left > of_right:
                undone, left = of_left, self.parts[left][1]
            else:  # of two equal merges the left one comes first, so one across of the same rank also does
                undone, right = of_right + 0.5, self.parts[right][0]
        if len(self.compatible) > 500_000:
            self.compatible.clear()
        self.compatible[key] = ok
        return ok

    def symbols_ids(self, s: str) -> list[int]:
        """Ids of one pre-token given in symbols."""
        if (whole := self.ids.get(s)) is not None and self.rank[whole] >= 0 and self._itself(whole):
            return [whole]
        return self._walk(s)

    def _itself(self, token: int) -> bool:
        """Whether a token's own text is encoded as this token: its two parts fit up to its merge."""
        key = (token, -1)
        if key not in self.compatible:
            self.compatible[key] = self._walk(self.symbols[token]) == [token]
        return self.compatible[key]

    def _walk(self, s: str) -> list[int]:
        longest = [(0, -1)] * len(s)
        for end, found in self.automaton.iter(s):
            at = end - found[0] + 1
            if found[0] > longest[at][0]:
                longest[at] = found
        open_place = [True] * (len(s) + 1)
        out: list[int] = []
        at, token = 0, longest[0][1]
        while True:
            last = out[-1] if out else -1
            while token >= 0:
                end = at + len(self.symbols[token])
                if open_place[end] and (last < 0 or self.fits(last, token)):
                    break
                token = self.prefix(token)
            if token >= 0:
                out.append(token)
                at = end
                if at == len(s):
                    return out
                token = longest[at][1]
            else:  # nothing goes on from here: the token before gets shorter
                open_place[at] = False
                token = out.pop()
                at -= len(self.symbols[token])

    def pre_tokens(self, pre: list[str]) -> list[bytes]:
        out = []
        for p in pre:
            s = p.encode().decode("latin-1").translate(self.byte_map)
            out.append(np.array(self.symbols_ids(s[:-1] + chr(ord(s[-1]) + LAST)), dtype="<u4").tobytes())
        return out

    def word(self, word: str) -> bytes:
        """Ids of a word of any characters, special tokens included."""
        out: list[int] = []
        for part in self.special_pattern.split(word) if self.special_pattern else [word]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for s, _ in self.split(self.normalise(part)):
                    out += self.symbols_ids(s[:-1] + chr(ord(s[-1]) + LAST))
        return np.array(out, dtype="<u4").tobytes()

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The decoded bytes of consecutive texts of ``counts`` ids: tokens joined by a space."""
        size = np.diff(self.offsets)[ids]
        raw = self.table[tx.ragged(self.offsets[ids], size)].tobytes()
        ends = np.cumsum(tx.segment_sums(size, np.concatenate([[0], np.cumsum(counts)])))
        out, begin = [], 0
        for end in ends.tolist():
            out.append(raw[begin:max(begin, end - 1)])
            begin = end
        return out


def encode_texts(codec: Backtracking, words: tk.WordIds, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in turn, number of ids of each)."""
    found = tx.Words(texts)
    pool, offsets = words(found.vocab)
    size = np.diff(offsets)[found.codes]
    return pool[tx.ragged(offsets[found.codes], size)], tx.segment_sums(size, found.starts)


def encode(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, tokenizer: str | None = None,
           digests: bool = False) -> DataFrame:
    """``keep`` columns with ids array<int> and decoded string, or, with ``digests``, n_tokens long,
    ids_sha256 and decoded_sha256 (hex; ids as little-endian unsigned 32-bit integers)."""
    content = tk.read_tokenizer(tokenizer)
    key = ("backtracking", zlib.crc32(content.encode()))

    def compute(part: pa.RecordBatch) -> dict:
        codec, words = tk.once(key, lambda: (c := Backtracking(content), tk.WordIds(c)))
        ids, counts = encode_texts(codec, words, tx.plain(part.column(text)))
        decoded = codec.decode(ids, counts)
        if not digests:
            return {"ids": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids.astype(np.int32))),
                    "decoded": pa.array([d.decode() for d in decoded], pa.string())}
        raw, ends = memoryview(ids.astype("<u4").tobytes()), (np.cumsum(counts) * 4).tolist()
        return {"n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip([0, *ends], ends, strict=False)], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())}

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return tx.annotate(docs, text, schema, compute, keep)
