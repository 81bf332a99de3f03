"""Toxic spans by a linear-chain conditional random field.

Only documents carry labels, so token labels are made first: a word whose
presence goes with the label (signed G test over all labelled training
documents, see ``lexicon``) is a toxic token where its document is labelled
toxic, and a clean one elsewhere.  A two-state chain is then fitted on
sentences of those documents by gradient ascent on the exact conditional
log-likelihood.  Scoring runs forward-backward over a whole text and gives each
token its marginal; stretches of tokens that carry no lexicon word are passed
in one step by a matrix power, so the marginals are exact for any length.  A
document's score is a logistic function of the expected number of toxic tokens
and the highest marginal, fitted on counts of all labelled training documents.

The classifier is fitted on a bounded sample: ``FIT_ROWS`` labelled training
documents in hash order give the words, at most ``FIT_SENTENCES`` of their
sentences the chain, and their counts per feature cell the logistic.  Training
documents that open with the same ten words count once, so copies don't vote.
Scoring reads every text whole and is narrow: no join, no shuffle.

Null and empty texts have no tokens and get the score of a text without toxic
words.  Without any labelled training rows, or with one class only, the score
is the share of toxic labels (0 without labels).  Repeated rows are scored row
by row; a null doc_id is never held out nor labelled.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import WordMemo, keep_rows, map_batches, prepare, raw_texts, split_words, stored

#: fixed sizes of what is learned: labelled documents, words of the lexicon, sentences for the chain, tokens of a fitted sentence
FIT_ROWS = 20_000
LEXICON_WORDS = 2_000
FIT_SENTENCES = 8_000
FIT_TOKENS = 64
#: characters that don't count at the ends of a word
EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_~`+=/\\"
#: tokens at each side of a lexicon word that get a marginal of their own
NEAR = 2
#: expected toxic tokens are counted in steps of 1/4 up to 8
CELLS, CELL_MAX = 4, 8


def is_held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def bare(word: bytes) -> bytes:
    return word.strip(EDGES)


def lexicon(labelled: DataFrame) -> dict[bytes, int]:
    """Words that go with the toxic label, numbered from 1.

    ``labelled`` has text and toxic.  A word is taken if the signed G statistic
    of its document counts passes 2 ln(words) + 6, a bound that holds whatever
    the number of words tried; the ``LEXICON_WORDS`` strongest are kept.
    """

    def make():
        def step(batch: pa.RecordBatch):
            toxic: dict[bytes, int] = {}
            clean: dict[bytes, int] = {}
            for text, label in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
                counts = toxic if label else clean
                for w in {bare(w) for w in split_words(text)}:
                    counts[w] = counts.get(w, 0) + 1
            words = list(toxic | clean)
            yield {"word": words, "toxic": [toxic.get(w, 0) for w in words], "clean": [clean.get(w, 0) for w in words]}

        return step

    words = map_batches(labelled.select("text", "toxic"), make, "word binary, toxic long, clean long").where("length(word) > 0")
    words = words.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where("a >= 3")
    n1, n0 = labelled.agg(F.sum(F.col("toxic")), F.sum(1 - F.col("toxic"))).first()
    if not n1 or not n0:
        return {}
    expected = (F.col("a") + F.col("b")) * (n1 / (n1 + n0))
    g = 2 * (F.col("a") * F.log(F.col("a") / expected) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / ((F.col("a") + F.col("b")) * (n0 / (n1 + n0))))).otherwise(0.0))
    # such words are at least half-way from the usual share of toxic documents to all
    up = F.col("a") / (F.col("a") + F.col("b")) >= (1 + n1 / (n1 + n0)) / 2
    scored = stored(words.select("word", g.alias("g"), up.alias("up")), "toxicity-words")
    tried = max(2, scored.count())
    best = scored.where(F.col("up") & (F.col("g") >= 2 * math.log(tried) + 6)).orderBy(F.desc("g"), "word").limit(LEXICON_WORDS).collect()
    return {bytes(r["word"]): k for k, r in enumerate(sorted(best, key=lambda r: r["word"]), 1)}


def coder(words: dict[bytes, int]) -> WordMemo:
    return WordMemo(lambda w: words.get(bare(w), 0))


def sentences(labelled: DataFrame, words: dict[bytes, int]) -> list[tuple[list[int], int]]:
    """A bounded sample of coded sentences with their document's label; sentences with lexicon words come first."""

    def make():
        codes = coder(words)

        def step(batch: pa.RecordBatch):
            out = []
            for text, label in zip(raw_texts(batch.column(0)), batch.column(1).to_pylist()):
                for line in (text or b"").replace(b". ", b".\n").split(b"\n"):
                    row = [codes[w] for w in split_words(line)]
                    out += [(row[k : k + FIT_TOKENS], label) for k in range(0, len(row), FIT_TOKENS)]
            yield {"codes": [r for r, _ in out], "toxic": [y for _, y in out]}

        return step

    rows = map_batches(labelled.select("text", "toxic"), make, "codes array<int>, toxic int")
    rows = rows.withColumn("hit", F.exists("codes", lambda c: c > 0))
    kinds = []
    for kind in ("hit", "not hit"):
        kinds += rows.where(kind).orderBy(F.xxhash64("codes", "toxic"), "codes").limit(FIT_SENTENCES // 2).collect()
    return [(r["codes"], r["toxic"]) for r in kinds]


class Chain:
    """Two-state chain: ``emit[code]`` and ``move[from, to]`` in log space, for state 0 clean and 1 toxic."""

    def __init__(self, size: int):
        self.emit, self.move = np.zeros((size, 2)), np.zeros((2, 2))

    def fit(self, rows: list[tuple[list[int], int]], steps: int = 100, rate: float = 0.5, ridge: float = 1e-4):
        """Gradient ascent (Adam) on the conditional log-likelihood of the token labels."""
        if not rows:
            return self
        # equal sentences, above all those without lexicon words, are one row with a weight
        total = len(rows)
        distinct = Counter((tuple(codes), toxic) for codes, toxic in rows)
        rows = sorted(distinct, key=lambda r: (-len(r[0]), r))
        weight = np.array([distinct[r] for r in rows], float)
        length = np.array([len(r[0]) for r in rows])
        code = np.zeros((len(rows), length[0]), np.int64)
        gold = np.zeros_like(code)
        for k, (codes, toxic) in enumerate(rows):
            code[k, : len(codes)] = codes
            gold[k, : len(codes)] = (np.array(codes) > 0) & bool(toxic)
        alive = np.arange(length[0]) < length[:, None]
        seen_emit = np.zeros_like(self.emit)
        each = np.broadcast_to(weight[:, None], code.shape)
        np.add.at(seen_emit, (code[alive], gold[alive]), each[alive])
        both = alive[:, 1:]
        seen_move = np.zeros((2, 2))
        np.add.at(seen_move, (gold[:, :-1][both], gold[:, 1:][both]), each[:, 1:][both])
        moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (self.emit, self.move)]
        for t in range(1, steps + 1):
            emit, move = self._expected(code, alive, weight)
            for x, g, m in ((self.emit, (seen_emit - emit) / total - ridge * self.emit, moments[0]), (self.move, (seen_move - move) / total - ridge * self.move, moments[1])):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.99 * m[1] + 0.01 * g * g
                x += rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-8)
        return self

    def _expected(self, code: np.ndarray, alive: np.ndarray, weight: np.ndarray):
        """Expected feature counts by forward-backward over all rows side by side."""
        rows, width = code.shape
        e = np.exp(self.emit - self.emit.max(axis=1, keepdims=True))[code]
        m = np.exp(self.move)
        f, b = np.zeros((width, rows, 2)), np.ones((width, rows, 2))
        f[0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, width):
            x = (f[t - 1] @ m) * e[:, t]
            f[t] = np.where(alive[:, t, None], x / x.sum(axis=1, keepdims=True), f[t - 1])
        for t in range(width - 2, -1, -1):
            x = (b[t + 1] * e[:, t + 1]) @ m.T
            b[t] = np.where(alive[:, t + 1, None], x / x.sum(axis=1, keepdims=True), 1.0)
        p = f * b
        p /= p.sum(axis=2, keepdims=True)
        emit, move = np.zeros_like(self.emit), np.zeros((2, 2))
        mask = alive.T
        for s in (0, 1):
            emit[:, s] = np.bincount(code.T[mask], weights=(p[..., s] * weight)[mask], minlength=len(emit))
        pair = f[:-1, :, :, None] * m * (b[1:] * e.transpose(1, 0, 2)[1:])[:, :, None, :]
        pair *= weight[None, :, None, None] / pair.sum(axis=(2, 3), keepdims=True)
        return emit, pair[alive.T[1:]].sum(axis=0)

    def marginals(self, codes: np.ndarray):
        """(positions, marginal of the toxic state) of the tokens in and near lexicon words.

        Tokens between them share one emission; such a stretch is one power of
        the 2x2 transfer matrix, scaled.
        """
        hits = np.flatnonzero(codes)
        if not len(hits):
            return hits, np.zeros(0)
        near = (hits[:, None] + np.arange(-NEAR, NEAR + 1)).ravel()
        at = np.unique(near[(near >= 0) & (near < len(codes))])
        e = np.exp(self.emit - self.emit.max(axis=1, keepdims=True))
        m = np.exp(self.move)
        plain = m * e[0]
        powers: dict[int, np.ndarray] = {}

        def stretch(n: int) -> np.ndarray:
            """Scaled transfer over n plain tokens."""
            if n not in powers:
                out, base, k = np.eye(2), plain / plain.max(), n
                while k:
                    if k & 1:
                        out = out @ base
                        out /= out.max()
                    base = base @ base
                    base /= base.max()
                    k >>= 1
                powers[n] = out
            return powers[n]

        gaps = np.diff(at) - 1
        steps = [stretch(int(g)) @ m if g else m for g in gaps]
        f = np.empty((len(at), 2))
        x = e[codes[at[0]]] if at[0] == 0 else (e[0] @ stretch(int(at[0]) - 1)) @ m * e[codes[at[0]]]
        f[0] = x / x.sum()
        for k, s in enumerate(steps):
            x = (f[k] @ s) * e[codes[at[k + 1]]]
            f[k + 1] = x / x.sum()
        b = np.empty_like(f)
        x = stretch(len(codes) - 1 - int(at[-1])) @ np.ones(2)
        b[-1] = x / x.sum()
        for k in range(len(steps) - 1, -1, -1):
            x = steps[k] @ (e[codes[at[k + 1]]] * b[k + 1])
            b[k] = x / x.sum()
        p = f * b
        return at, p[:, 1] / p.sum(axis=1)


def byte_spans(text: bytes | None, tokens: list[bytes], toxic: np.ndarray) -> list[dict]:
    """Runs of toxic tokens: first and last token, and their bytes in the text."""
    if not len(toxic):
        return []
    low, places, at = text.lower(), {}, 0
    wanted = set(toxic.tolist())
    for k in range(int(toxic[-1]) + 1):
        at = low.index(tokens[k], at)
        if k in wanted:
            places[k] = at, at + len(tokens[k])
        at += len(tokens[k])
    runs = np.split(toxic, np.flatnonzero(np.diff(toxic) > 1) + 1)
    return [{"first": int(r[0]), "last": int(r[-1]), "start": places[int(r[0])][0], "end": places[int(r[-1])][1]} for r in runs]


def features(expected, highest) -> np.ndarray:
    expected = np.minimum(np.asarray(expected, float), CELL_MAX)
    return np.stack([np.ones_like(expected), np.asarray(highest, float), np.sqrt(expected)], axis=1)


def fit_logistic(x: np.ndarray, y1: np.ndarray, n: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Newton steps for a logistic on counted cells."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, x.T @ (y1 - n * p) - ridge * w)
        w += move
        if np.abs(move).max() < 1e-9:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, toxic of a bounded sample of labelled documents that aren't held out; equal openings count once."""
    l = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    l = l.where(~is_held_out("__id")).orderBy(F.xxhash64("__id"), "__id", F.desc("toxic")).limit(fit_rows)
    # stored, so that its size is known and the texts needn't move
    l = stored(l.groupBy("__id").agg(F.max("toxic").alias("toxic")), "toxicity-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(l, "__id")
    rows = rows.withColumn("__opening", F.xxhash64(F.lower(F.substring_index("text", " ", 10))))
    # of equal openings the smallest row stands for all, however the table is partitioned
    first = rows.groupBy("__opening").agg(F.min(F.struct("__id", "toxic", "text")).alias("row"))
    return stored(first.select(F.col("row.__id").alias("doc_id"), "row.text", "row.toxic"), "toxicity-training")


class Scorer:
    """The fitted classifier, small enough to go to every task."""

    def __init__(self, words: dict[bytes, int], chain: Chain, weights: np.ndarray | None, share: float):
        self.words, self.chain, self.weights, self.share = words, chain, weights, share

    def scores(self, expected, highest) -> np.ndarray:
        if self.weights is None:
            return np.full(len(expected), self.share)
        return 1 / (1 + np.exp(-(features(expected, highest) @ self.weights)))


def marks(text: bytes | None, codes: WordMemo, chain: Chain):
    """Tokens of a text, positions of its marginals, and the marginals."""
    tokens = split_words(text)
    return tokens, *chain.marginals(np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens)))


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    train = training_rows(docs, labels)
    words = lexicon(train)
    chain = Chain(len(words) + 1).fit(sentences(train, words) if words else [])

    def make():
        codes = coder(words)

        def step(batch: pa.RecordBatch):
            p = [marks(t, codes, chain)[2] for t in raw_texts(batch.column(1))]
            yield {"toxic": batch.column(0), "expected": [float(x.sum()) for x in p], "highest": [float(x.max()) if len(x) else 0.0 for x in p]}

        return step

    cells = map_batches(train.select("toxic", "text"), make, "toxic int, expected double, highest double")
    cells = cells.select("toxic", (F.floor(F.least("expected", F.lit(CELL_MAX)) * CELLS) / CELLS).alias("expected"), F.round("highest", 1).alias("highest"))
    counted = sorted(cells.groupBy("expected", "highest").agg(F.sum("toxic").alias("y"), F.count("*").alias("n")).collect())
    y, n = (np.array([r[c] for r in counted], float) for c in ("y", "n"))
    share = float(y.sum() / n.sum()) if counted else 0.0
    if not 0 < share < 1:
        return Scorer(words, chain, None, share)
    return Scorer(words, chain, fit_logistic(features([r["expected"] for r in counted], [r["highest"] for r in counted]), y, n), share)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, expected, highest, spans of every row."""
    prepare(docs.sparkSession)
    scorer = fit(docs, labels)

    def make():
        codes = coder(scorer.words)

        def step(batch: pa.RecordBatch):
            expected, highest, spans = [], [], []
            for text in raw_texts(batch.column(2)):
                tokens, at, p = marks(text, codes, scorer.chain)
                expected.append(float(p.sum()))
                highest.append(float(p.max()) if len(p) else 0.0)
                spans.append(byte_spans(text, tokens, at[p >= 0.5]))
            score = scorer.scores(expected, highest)
            yield {"doc_id": batch.column(0), "held_out": batch.column(1), "score": score, "predicted": score >= 0.5, "expected": expected, "highest": highest, "spans": spans}

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, score double, predicted boolean, expected double, highest double, spans array<struct<first:int,last:int,start:int,end:int>>"
    return map_batches(rows, make, schema).withColumn("predicted", F.col("predicted").cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents not predicted toxic, each judged by its own text; all columns stay."""
    prepare(docs.sparkSession)
    scorer = fit(docs, labels)

    def make():
        codes = coder(scorer.words)

        def judge(texts: list[bytes | None]) -> list[bool]:
            p = [marks(t, codes, scorer.chain)[2] for t in texts]
            return (scorer.scores([float(x.sum()) for x in p], [float(x.max()) if len(x) else 0.0 for x in p]) < 0.5).tolist()

        return judge

    return keep_rows(docs, make)
