"""Language ID by rank-order profiles of character n-grams.

Each word is cut into runs of letters, lower-cased and padded; its 1-, 2- and 3-grams are counted.
A language's profile is its ``size`` most frequent n-grams in rank order, over every training
document. A document's own profile is made of its ``size`` most frequent n-grams, known or not; its
distance to a language is the mean out-of-place distance of the ranks, with the largest one for n-grams
that the language's profile lacks. The nearest language wins.

Training uses documents with a language whose crc32 of the id (as text) modulo 3 is not 1; the
prediction sees the text alone. ``score`` is one minus the mean distance, divided by ``size``.

A text in a language that was not learned has few known n-grams in their places. ``least_scores`` gives
the score that a text of each language should reach, from the training documents' own scores: as far
below their 1 % quantile as that is below their median.

Defined results: a text that is null, empty or without a letter is ``und`` with score 0, and so is
every text if no language was learned; a text none of whose n-grams is known gets the first language
by name with score 0; equal distances go to the first language by name; equal counts rank by code
points; repeated rows count each time; a null id trains nothing and is not held out; computed columns
replace kept columns of the same name; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import text as tx

SIZE = 400
#: Cells (documents x distinct n-grams of a slice) of one matrix of n-gram counts at most.
CELLS = 1_000_000
#: Training documents from which a language's own least score is taken.
LEAST_TRAINED = 200
PART = r"(\pL+|[^\pL]+)"
_PAD = ord("_")


def held_out(doc_id, modulus: int = 3, remainder: int = 1):
    """Whether crc32 of the id as text leaves the held-out remainder (false for a null id)."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % modulus
    return F.coalesce(rest == remainder, F.lit(False))


def letter_runs(words: tx.Words) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(run of each letter run of all texts in turn, each text's start, distinct runs)."""
    codes, offsets, vocab = tx.parts(words.vocab, PART)
    run, starts = tx.of_words(words, codes, offsets)
    letters = pc.match_substring_regex(vocab, r"^\pL").to_numpy(zero_copy_only=False)
    number = np.cumsum(letters) - 1
    held = letters[run] if len(run) else np.zeros(0, bool)
    starts = np.concatenate([[0], np.cumsum(held)])[starts]
    return number[run[held]] if len(run) else run, starts, vocab.filter(pa.array(letters)).to_pylist()


def grams(runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram codes, run of each): up to three code points of the padded run, 21 bits each."""
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars = np.frombuffer(("_" + "__".join(runs) + "_").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    size = np.fromiter(map(len, runs), np.int64, len(runs)) + 2
    run = np.repeat(np.arange(len(runs)), size)
    one = chars != _PAD
    two = run[1:] == run[:-1]
    three = run[2:] == run[:-2]
    pair = chars[:-1] << 21 | chars[1:]
    triple = chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:]
    return (np.concatenate([chars[one], pair[two], triple[three]]),
            np.concatenate([run[one], run[:-1][two], run[:-2][three]]))


def training(docs: DataFrame, doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    return docs.where(F.col(lang).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SIZE) -> list[tuple[str, list[int]]]:
    """[(language, its n-gram codes in rank order)], by name: ``size`` codes a language at most."""
    train = training(docs, doc_id, lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for part in tx.slices(batches, "text"):
            run, starts, runs = letter_runs(tx.Words(tx.plain(part.column("text"))))
            code, of = grams(runs)
            distinct, number = np.unique(code, return_inverse=True)
            langs = part.column("lang").cast(pa.string()).dictionary_encode()
            of_token = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(starts))
            for k, name in enumerate(langs.dictionary.to_pylist()):
                weight = np.bincount(run[of_token == k], minlength=len(runs))
                n = np.bincount(number, weights=weight[of], minlength=len(distinct)) if len(code) else np.zeros(0)
                held = sums.setdefault(name, [])
                held.append((distinct[n > 0], n[n > 0].astype(np.int64)))
                if len(held) > 16:
                    sums[name] = [_added(held)]
        for name, held in sums.items():
            code, n = _added(held)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), pa.string()), pa.array(code), pa.array(n)], names=["lang", "gram", "n"])

    counted = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(count, "lang string, gram bigint, n bigint")
    sums = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = sums.withColumn("rank", rank).where(F.col("rank") <= size)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for r in top.select("lang", "rank", "gram").collect():  # ``size`` rows a language
        profiles.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return [(name, [g for _, g in sorted(profiles[name])]) for name in sorted(profiles)]


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, number = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    return code, np.bincount(number, weights=np.concatenate([n for _, n in held]), minlength=len(code)).astype(np.int64)


class Profiles:
    """Fitted profiles as one rank table over the n-grams that occur in any of them."""

    def __init__(self, profiles: list[tuple[str, list[int]]], size: int = SIZE):
        self.names, self.size = [n for n, _ in profiles], size
        self.known = np.unique(np.array([g for _, p in profiles for g in p], dtype=np.int64))
        self.ranks = np.full((len(profiles), len(self.known)), 2 * size, dtype=np.int64)  # lacking: far from any place
        for k, (_, p) in enumerate(profiles):
            self.ranks[k, np.searchsorted(self.known, np.array(p, dtype=np.int64))] = np.arange(len(p))

    def distances(self, doc: np.ndarray, at: np.ndarray, n: np.ndarray, docs: int) -> np.ndarray:
        """(documents, languages): mean out-of-place distance over ``size``; 1 for an empty profile.
        Entries (document, index among the known n-grams or -1, occurrences), by document and code point."""
        order = np.lexsort((-n, doc))
        doc, at = doc[order], at[order]
        total = np.bincount(doc, minlength=docs)
        place = np.arange(len(doc)) - (np.cumsum(total) - total)[doc]
        used = place < self.size
        own, known = np.minimum(total, self.size), used & (at >= 0)
        doc, at, place = doc[known], at[known], place[known]
        lost = self.size * (own - np.bincount(doc, minlength=docs))
        far = [lost + np.bincount(doc, weights=np.minimum(self.size, np.abs(r[at] - place)), minlength=docs) for r in self.ranks]
        return np.where(own[:, None] > 0, np.array(far).T / np.maximum(1, own)[:, None] / self.size, 1.0)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        run, starts, runs = letter_runs(tx.Words(texts))
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        code, of = grams(runs)
        distinct, g = np.unique(code, return_inverse=True)
        at = np.where(np.isin(distinct, self.known), np.searchsorted(self.known, distinct), -1)
        g = g[np.argsort(of, kind="stable")]
        size = np.bincount(of, minlength=len(runs))
        begin = np.cumsum(size) - size
        names, scores = [], np.zeros(len(texts))
        rows = max(1, CELLS // max(1, len(distinct)))
        for a in range(0, len(texts), rows):
            b = min(a + rows, len(texts))
            own = run[starts[a]:starts[b]]
            n = np.diff(starts[a:b + 1])
            cell = np.repeat(np.repeat(np.arange(b - a), n), size[own]) * len(distinct) + g[tx.ragged(begin[own], size[own])]
            counts = np.bincount(cell, minlength=(b - a) * len(distinct))
            held = np.flatnonzero(counts)
            far = self.distances(held // max(1, len(distinct)), at[held % max(1, len(distinct))], counts[held], b - a)
            best = far.argmin(axis=1)
            names += [self.names[k] if m else "und" for k, m in zip(best.tolist(), n.tolist(), strict=True)]
            scores[a:b] = np.where(n > 0, 1 - far.min(axis=1), 0.0)
        return names, scores


def identify(docs: DataFrame, profiles: list[tuple[str, list[int]]], *, text: str = "text", keep: list[str] | None = None, size: int = SIZE, prefix: str = "") -> DataFrame:
    """``keep`` columns with lang_pred and score (their names after ``prefix``) of every text."""
    model = Profiles(profiles, size)

    def compute(part: pa.RecordBatch) -> dict:
        names, scores = model.predict(tx.plain(part.column(text)))
        return {f"{prefix}lang_pred": pa.array(names, pa.string()), f"{prefix}score": scores}

    return tx.annotate(docs, text, f"{prefix}lang_pred string, {prefix}score double", compute, keep)


def least_scores(docs: DataFrame, profiles: list[tuple[str, list[int]]], *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SIZE) -> dict[str, float]:
    """{language: least score} from every training document that is found to be in its own language; a
    language with fewer than ``LEAST_TRAINED`` of them goes no higher than all languages together."""
    train = training(docs, doc_id, lang).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    scored = identify(train, profiles, keep=["lang"], size=size).where("lang = lang_pred")
    sums = scored.rollup("lang").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", [0.01, 0.5]).alias("q"))
    found = {r["lang"]: (r["n"], max(0.0, 2 * r["q"][0] - r["q"][1])) for r in sums.where("n > 0").collect()}  # a row a language
    every = found.pop(None, (0, 0.0))[1]
    return {name: least if n >= LEAST_TRAINED else min(least, every) for name, (n, least) in ((k, found.get(k, (0, every))) for k, _ in profiles)}
