"""Token counts by a trie-shared dynamic program over a unigram model that is fitted to the corpus.

The model's pieces come from a public vocabulary file (it is never trained); their probabilities are
learned here. All documents' distinct pre-tokens are counted; from a start by Zipf's law of the file's
ranks, rounds of Viterbi training segment every distinct pre-token, weigh the pieces of its best
segmentation by its count, and take the smoothed shares as the new probabilities. A task returns one
row a piece, so the driver sees no more than the vocabulary.

A pre-token is a word with the file's word mark in front. A slice's distinct
pre-tokens, sorted, are the depth-first order of their trie: only the path to the current node is held,
and the forward score (the best log-probability of a segmentation of the prefix) and its token count are
computed once for each node, that is once for each shared prefix. The count at a pre-token's terminal
node is stored for its occurrences; counts of known words are kept by a worker, up to a bound.

A character without a piece costs its UTF-8 bytes in byte pieces, all of one probability. Of equal
scores the one with fewer tokens wins, then the one with the longer last piece. Defined results: a null or empty text has zero words and tokens; repeated rows give equal
rows (and count twice in the model); computed columns replace kept columns of the same name; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as tx
from riskloom.llm import tokens
from riskloom.session import cut_lineage

MARK = "▁"
#: Rounds of training, and uses added to every piece.
ROUNDS, SMOOTH = 2, 0.1
#: Bytes of text of a slice: larger ones repeat fewer words.
SLICE = 6 << 20
#: For a string that no piece ends in.
_NO_END = object()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_pieces(path: str | None = None) -> list[str]:
    """The file's ordinary pieces in rank order (control, unknown and byte pieces left out)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor()
    model.Load(path or default_path())
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Unigram:
    """Log-probabilities of pieces and of a byte; by Zipf's law, bytes behind all pieces, unless given."""

    def __init__(self, pieces: list[str], score: np.ndarray | None = None, shift: float = 2.7):
        if score is None:
            weight = 1.0 / (np.arange(len(pieces) + 256) + 1 + shift)
            score = np.log(weight / weight.sum())[[*range(len(pieces)), -1]]
        self.names, self.score = pieces, score
        self.pieces = dict(zip(pieces, score.tolist(), strict=False))
        self.byte = float(score[-1])
        #: Every end of a piece, with its score if it is a piece itself.
        self.ends: dict[str, float | None] = {}
        for p in pieces:
            for k in range(len(p) - 1, 0, -1):
                self.ends.setdefault(p[k:])
        self.ends.update(self.pieces)

    def walk(self, words: list[str]) -> Iterator[tuple[str, list[float], list[int], list[int]]]:
        """Each distinct word's path (the mark and the word) with the score, token count and last step of every
        prefix. A step is the begin of the last piece, or minus the number of bytes. The lists are reused."""
        pieces, ends = self.pieces, self.ends.get
        path, before = "", MARK
        scores, tokens, steps = [0.0], [0], [0]
        for word in sorted(words):
            path = MARK + word
            shared, most = 0, min(len(path), len(before))
            while shared < most and path[shared] == before[shared]:
                shared += 1
            shared = min(shared, len(scores) - 1)
            del scores[shared + 1:], tokens[shared + 1:], steps[shared + 1:]
            for end in range(shared + 1, len(path) + 1):
                last = path[end - 1]
                best, n, step = -1e300, 0, 0
                for begin in range(end - 1, -1, -1):
                    s = ends(path[begin:end], _NO_END)
                    if s is None:
                        continue
                    if s is _NO_END:
                        break
                    s += scores[begin]
                    if s > best or s == best and tokens[begin] < n:
                        best, n, step = s, tokens[begin] + 1, begin
                if last not in pieces:
                    size = len(last.encode())
                    s = scores[end - 1] + size * self.byte
                    if s > best or s == best and tokens[end - 1] + size < n:
                        best, n, step = s, tokens[end - 1] + size, -size
                scores.append(best)
                tokens.append(n)
                steps.append(step)
            yield path, scores, tokens, steps
            before = path

    def counts(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """(tokens, log-probability) of each pre-token (distinct words without the mark)."""
        return {path[1:]: (tokens[-1], scores[-1]) for path, scores, tokens, _ in self.walk(words)}

    def usage(self, weight: dict[str, int]) -> np.ndarray:
        """How often the best segmentations of the words, with their weights, use each piece, and bytes (last)."""
        index = {p: i for i, p in enumerate(self.names)}
        out = np.zeros(len(self.names) + 1, np.int64)
        for path, _, _, steps in self.walk(list(weight)):
            w, end = weight[path[1:]], len(path)
            while end:
                step = steps[end]
                if step < 0:
                    out[-1] -= step * w
                    end -= 1
                else:
                    out[index[path[step:end]]] += w
                    end = step
        return out

    def refitted(self, usage: np.ndarray, smooth: float = SMOOTH) -> Unigram:
        """The model of the shares in ``usage``, every piece and byte with ``smooth`` uses more."""
        uses = usage.astype(np.float64)
        uses[-1] /= 256
        uses += smooth
        return Unigram(self.names, np.log(uses / (uses[:-1].sum() + 256 * uses[-1])))


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) of all whole texts: counted by slices, then by a sum that is partial before its shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, text):
            words = tx.Words(tx.plain(part.column(text)))
            n = np.bincount(words.codes, minlength=len(words.vocab)).astype(np.int64)
            used = n > 0
            yield pa.RecordBatch.from_arrays([words.vocab.filter(pa.array(used)).cast(pa.string()), pa.array(n[used])], names=["word", "n"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, *, text: str = "text", pieces: str | None = None, rounds: int = ROUNDS) -> Unigram:
    """The unigram model after ``rounds`` of Viterbi training on all words of ``docs``."""
    model = Unigram(read_pieces(pieces))
    counted = cut_lineage(word_counts(docs, text).sortWithinPartitions("word"))  # neighbours share prefixes

    for _ in range(rounds):
        names, score = model.names, model.score

        def run(batches: Iterator[pa.RecordBatch], names=names, score=score) -> Iterator[pa.RecordBatch]:
            own, total = Unigram(names, score), np.zeros(len(names) + 1, np.int64)
            for batch in batches:
                total += own.usage(dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True)))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "uses"])

        usage = np.zeros(len(names) + 1, np.int64)
        for r in counted.mapInArrow(run, "piece int, uses bigint").groupBy("piece").agg(F.sum("uses").alias("uses")).collect():  # at most the vocabulary
            usage[r["piece"]] = r["uses"]
        model = model.refitted(usage)
    return model


class KnownCounts:
    """Counts of words already seen by this worker, in flat tables of up to ``limit`` words."""

    def __init__(self, model: Unigram, limit: int = 1_200_000):
        self.model, self.limit = model, limit
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.tokens, self.scores = np.zeros(0, np.int64), np.zeros(0, np.float64)

    def of(self, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        vocab = vocab.cast(pa.large_string())
        if len(self.words) + len(vocab) > self.limit:
            self.clear()
        at = pc.index_in(vocab, value_set=self.words)
        new = vocab.filter(at.is_null())
        if len(new):
            found = self.model.counts(names := new.to_pylist())
            n, s = zip(*(found[w] for w in names), strict=True)
            missing = at.is_null().to_numpy(zero_copy_only=False)
            at = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at[missing] = len(self.words) + np.arange(len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.tokens, self.scores = np.concatenate([self.tokens, np.array(n, np.int64)]), np.concatenate([self.scores, s])
        else:
            at = at.to_numpy(zero_copy_only=False)
        return self.tokens[at], self.scores[at]


def count_tokens(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, pieces: str | None = None,
                 model: Unigram | None = None) -> DataFrame:
    """``keep`` columns with n_words, n_chars (code points), n_tokens and log_prob of each whole text, by
    ``model`` or else by one that is fitted to ``docs``."""
    model = model or fit(docs, text=text, pieces=pieces)
    names, score = model.names, model.score
    key = ("unigram", hashlib.sha256(score.tobytes() + "\n".join(names).encode()).hexdigest())

    def compute(part: pa.RecordBatch) -> dict:
        known = tokens.once(key, lambda: KnownCounts(Unigram(names, score)))
        texts = tx.plain(part.column(text))
        words = tx.Words(texts)
        n, scores = known.of(words.vocab)
        return {"n_words": pa.array(words.counts, pa.int64()), "n_chars": pc.utf8_length(texts).cast(pa.int64()),
                "n_tokens": pa.array(tx.segment_sums(n[words.codes], words.starts), pa.int64()),
                "log_prob": tx.segment_sums(scores[words.codes], words.starts)}

    return tx.annotate(docs, text, "n_words bigint, n_chars bigint, n_tokens bigint, log_prob double", compute, keep, SLICE)
