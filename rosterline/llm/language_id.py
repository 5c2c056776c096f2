"""Language of texts by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word (a stretch of letters, in small
letters, with the vocabulary's blank before it) scores the sum over all its segmentations of the products of its pieces'
probabilities, by the forward algorithm; a text scores the sum of its words' logarithms, and a language's score is its
share after equal priors.

The probabilities come from expectation maximisation: forward and backward sums over the counted words of the labelled
rows give each piece's expected count, summed by language and piece on Spark. At most about ``train_rows`` labelled rows
are used: each language's share of the bound, taken by a hash of id and text, so that a rare language is learned too (all rows
below the bound). The driver holds vocabulary times languages numbers.

The whole text is used. Texts without letters, nulls and empties are ``und`` with score 0; with no learned language so
is every text. Letters the vocabulary lacks have a small fixed probability. Runs of over ``LONG`` letters (joined words, scripts
without blanks) go through the recursion one by one, scaled as they go, in a window of the longest piece; only training
cuts them. Equal scores go to the language that is first in order. Rows are scored independently: repeated rows alike, an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm import base
from rosterline.operators.joins import few_valued

BLANK = "▁"
WORD = re.compile(r"[^\W\d_]+")
LONG = 40  # letters up to which words share a matrix
CUT = re.compile(rf"[^\W\d_]{{1,{LONG}}}")
UNKNOWN = "und"
CHUNK = 2048  # words a matrix holds
STRETCH = 50_000  # words looked up at once


@lru_cache(maxsize=2)
def vocabulary(model_path: str) -> tuple[list[str], ahocorasick.Automaton]:
    """The small-letter pieces of a SentencePiece model in order, and the automaton over them."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    plain = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
    kept = sorted({p for p in plain if p == p.lower() and (p == BLANK or p.removeprefix(BLANK).isalpha())})
    automaton = ahocorasick.Automaton()
    for i, piece in enumerate(kept):
        automaton.add_word(piece, (i, len(piece)))
    automaton.make_automaton()
    return kept, automaton


class Lattice:
    """All pieces in a list of words, ordered by where they end; letters without a piece count as the last piece."""

    def __init__(self, words: list[str], automaton: ahocorasick.Automaton, unknown: int):
        row, start, end, piece, sizes = [], [], [], [], []
        for r, word in enumerate(words):
            text = BLANK + word
            covered = set()
            sizes.append(len(text))
            for last, (token, size) in automaton.iter(text):
                row.append(r)
                start.append(last + 1 - size)
                end.append(last + 1)
                piece.append(token)
                if size == 1:
                    covered.add(last)
            for at in range(len(text)):
                if at not in covered:
                    row.append(r)
                    start.append(at)
                    end.append(at + 1)
                    piece.append(unknown)
        row, start, end, piece = (np.array(x, np.int64) for x in (row, start, end, piece))
        order = np.argsort(end, kind="stable")
        self.row, self.start, self.end, self.piece = row[order], start[order], end[order], piece[order]
        self.sizes, self.width = np.array(sizes, np.int64), max(sizes, default=0) + 1
        self.cuts = np.searchsorted(self.end, np.arange(self.width + 1))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """alpha[word, end] for the probabilities of the lattice's pieces."""
        n = len(self.sizes)
        alpha = np.zeros((n, self.width))
        alpha[:, 0] = 1
        for e in range(1, self.width):
            part = slice(self.cuts[e], self.cuts[e + 1])
            alpha[:, e] = np.bincount(self.row[part], alpha[self.row[part], self.start[part]] * p[part], minlength=n)
        return alpha

    def log_totals(self, p: np.ndarray) -> np.ndarray:
        return np.log(np.maximum(self.forward(p)[np.arange(len(self.sizes)), self.sizes], 1e-300))

    def expected(self, p: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected number of uses of each lattice piece, each word counted ``weights`` times."""
        n = len(self.sizes)
        alpha, beta = self.forward(p), np.zeros((n, self.width))
        beta[np.arange(n), self.sizes] = 1
        order = np.argsort(-self.start, kind="stable")
        cuts = np.searchsorted(-self.start[order], -np.arange(self.width + 1), side="left"), np.searchsorted(-self.start[order], -np.arange(self.width + 1), side="right")
        for s in range(self.width - 1, -1, -1):
            part = order[cuts[0][s] : cuts[1][s]]
            if len(part):
                beta[:, s] += np.bincount(self.row[part], beta[self.row[part], self.end[part]] * p[part], minlength=n)
        total = np.maximum(alpha[np.arange(n), self.sizes], 1e-300)
        return alpha[self.row, self.start] * p * beta[self.row, self.end] * (weights / total)[self.row]


@dataclass
class Model:
    """Languages in order, and for each the probability of every piece (unknown letters last)."""

    model_path: str
    languages: list[str]
    p: np.ndarray
    memo: dict[str, int] = field(default_factory=dict, repr=False)
    scores: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"model_path": self.model_path, "languages": self.languages, "p": self.p, "memo": {}, "scores": None}

    def learn_words(self, words: list[str], most: int = 400_000) -> None:
        """Bring the scores of ``words`` (all different) into the memo, which is emptied when full."""
        if self.scores is None or len(self.memo) + len(words) > most:
            self.memo, self.scores = {}, np.zeros((0, len(self.languages)))
        new = [w for w in words if w not in self.memo]
        if not new:
            return
        kept, automaton = vocabulary(self.model_path)
        found, size = [], len(self.memo)
        for at in range(0, len(new), CHUNK):
            lattice = Lattice(new[at : at + CHUNK], automaton, len(kept))
            found.append(np.stack([lattice.log_totals(row[lattice.piece]) for row in self.p], axis=1))
        self.memo.update((w, size + k) for k, w in enumerate(new))
        if size + len(new) > len(self.scores):  # room for more at once
            grown = np.zeros((max(2 * len(self.scores), size + len(new), 16_384), len(self.languages)))
            grown[:size] = self.scores[:size]
            self.scores = grown
        self.scores[size : size + len(new)] = np.concatenate(found)

    def long_totals(self, word: str) -> np.ndarray:
        """Logarithm of the sum over all segmentations of a word of any length, for each language."""
        kept, automaton = vocabulary(self.model_path)
        room, text = max(map(len, kept)) + 1, BLANK + word
        # Sums up to the last places, by place modulo ``room``; ``logs`` is what has been divided out.
        sums, logs = np.zeros((room, len(self.languages))), np.zeros(len(self.languages))
        sums[0] = 1
        found = automaton.iter(text)
        ahead = next(found, None)
        for e in range(1, len(text) + 1):
            own = []
            while ahead is not None and ahead[0] + 1 == e:
                own.append(ahead[1])
                ahead = next(found, None)
            total = np.zeros(len(self.languages))
            for token, size in own:
                total += sums[(e - size) % room] * self.p[:, token]
            if not any(size == 1 for _, size in own):
                total += sums[(e - 1) % room] * self.p[:, -1]
            if total.min() < 1e-100:
                scale = np.maximum(total, 1e-300)
                sums, total, logs = sums / scale, total / scale, logs + np.log(scale)
            sums[e % room] = total
        return logs + np.log(np.maximum(sums[len(text) % room], 1e-300))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and share of each text."""
        languages, scores = [], []
        counted = [Counter(WORD.findall(t.lower())) for t in texts] if self.languages else [Counter() for _ in texts]
        # The words of many texts at once; a text with very many in stretches of its own.
        self.learn_words(list({w for c in counted if len(c) <= STRETCH for w in c if len(w) <= LONG}))
        for text, c in zip(texts, counted):
            if not self.languages or not any(map(str.isalpha, text)):
                languages.append(UNKNOWN)
                scores.append(0.0)
                continue
            total, names = np.zeros(len(self.languages)), [w for w in c if len(w) <= LONG]
            for word in c:
                if len(word) > LONG:
                    total += c[word] * self.long_totals(word)
            for at in range(0, len(names), STRETCH):
                part = names[at : at + STRETCH]
                if len(names) > STRETCH or any(w not in self.memo for w in part):
                    self.learn_words(part)
                rows = np.fromiter(map(self.memo.__getitem__, part), np.int64, len(part))
                total += np.fromiter(map(c.__getitem__, part), np.float64, len(part)) @ self.scores[rows]
            share = np.exp(total - total.max())
            best = int(np.argmax(total))
            languages.append(self.languages[best])
            scores.append(float(share[best] / share.sum()))
        return languages, scores


def train(labelled: DataFrame, model_path: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", train_rows: int = 20_000, rounds: int = 3, smoothing: float = 0.02) -> Model:
    """Fit on the rows of ``labelled`` that have a language; about ``train_rows`` of them at most."""
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("lang IS NOT NULL")
    spark = labelled.sparkSession
    base.small_batches(spark)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    n, languages = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if n > train_rows:
        grain = 1 << 30
        share = sizes.select("lang", (F.lit(grain * train_rows / languages) / F.col("n")).cast("long").alias("share"))
        rows = few_valued(rows, share, ["lang"], {"share": "share"})  # texts are not moved by their language
        rows = rows.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(grain)) < F.col("share")).select("doc_id", "lang", "text")

    def words(batches):
        held: Counter = Counter()

        def out():
            langs, names = zip(*held) if held else ((), ())
            result = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(names, pa.string()), pa.array(held.values(), pa.int64())], ["lang", "word", "n"])
            held.clear()
            return result

        with base.task():
            for batch in base.pieces(batches):
                for lang, text in zip(batch.column("lang").to_pylist(), base.texts(batch)):
                    for word, k in Counter(CUT.findall(text.lower())).items():
                        held[lang, word] += k
                if len(held) > 200_000:
                    yield out()
            yield out()

    counted = base.staged(rows.mapInArrow(words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = sorted(r[0] for r in counted.select("lang").distinct().collect())
    pieces, _ = vocabulary(model_path)
    p = np.full((len(languages), len(pieces) + 1), 1 / (len(pieces) + 1))
    place = {x: k for k, x in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast(p)

        def expect(batches, shared=shared):
            kept, automaton = vocabulary(model_path)
            sums = np.zeros((len(place), len(kept) + 1))
            for batch in base.pieces(batches, CHUNK):
                lattice = Lattice(batch.column("word").to_pylist(), automaton, len(kept))
                own = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)[lattice.row]
                expected = lattice.expected(shared.value[own, lattice.piece], batch.column("n").to_numpy().astype(float))
                sums += np.bincount(own * sums.shape[1] + lattice.piece, expected, minlength=sums.size).reshape(sums.shape)
            lang, piece = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(sums[lang, piece], pa.float64())], ["lang", "piece", "n"])

        summed = counted.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        shared.unpersist()
        counts = np.zeros_like(p)
        counts[summed["lang"], summed["piece"]] = summed["n"]
        counts[:, -1] = 0  # letters without a piece tell nothing: the same small share everywhere
        p = (counts + smoothing) / (counts + smoothing).sum(1, keepdims=True)
        p[:, -1] = 1e-7
    return Model(model_path, languages, p)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def body(batch):
        langs, scores = shared.value.predict(base.texts(batch))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return base.map_batches(base.keyed_text(docs, id_col, text_col), body, "doc_id long, lang_pred string, score double")


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; null for null ids."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def with_language(docs: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` that have a known language with at least ``least_score``; all columns stay."""
    base.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def accepted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with base.task():
            for text in texts:
                out: list[bool] = []
                values = [t or "" for t in text]
                for at in range(0, len(values), 512):
                    langs, scores = shared.value.predict(values[at : at + 512])
                    out += [x != UNKNOWN and s >= least_score for x, s in zip(langs, scores)]
                yield pd.Series(out, dtype=bool)

    return docs.filter(accepted(F.col(text_col)))


def held_out_predictions(docs: DataFrame, model_path: str, train_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out."""
    model = train(docs.filter(fold("doc_id", 5) != 0), model_path, train_rows=train_rows)
    found = identify(docs, model)
    return found.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
