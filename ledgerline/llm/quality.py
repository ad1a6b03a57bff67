"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every whole text: good, bad, nothing found, or
too short to tell (which counts neither way).  Documents are counted by their pattern of
votes (at most 4 ** labellers patterns, whatever the corpus size), and
expectation-maximisation over these counts estimates the share of good documents and how
each labeller votes on good and on bad ones.  Every pattern then has a posterior, and the posteriors are the soft labels from which a linear
scorer over hashed character shapes is trained, so that texts on which the labellers are
silent get a score too.

The counts cover all documents.  The scorer is trained on a bounded sample
(``SAMPLE`` distinct texts or so, weighted by their rows); every document is scored.  Only the
text is read; gold labels are never used.

Defined cases: null and empty texts draw the votes of an empty text and are not kept;
repeated rows each count and keep their row; null ids are kept; an empty table gives no
rows; extra columns are ignored; a very long text is a slice of its own and read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import map_arrow
from .tables import staged
from .textarrays import BLANK_SEPARATED, U64, Words, byte_table, mix, slices, utf8

SAMPLE = 10_000
#: a text with so many times the rows of an average member of the sample is always in it
OFTEN = 10
DIMENSIONS = 2_048
EPOCHS = 100
BETTER = 1.5
_GOOD, _BAD, _SILENT, _TOO_SHORT = 1, 0, -1, -2


_LINES = byte_table(lambda b: b != 10)


def _distinct(w: Words) -> np.ndarray:
    """Number of distinct words (or lines) of each text."""
    doc = np.repeat(np.arange(len(w.first) - 1), w.counts())
    keys = np.sort(doc.astype(U64) << U64(50) | w.hash >> U64(14))
    if len(keys):
        doc = (keys[np.concatenate([[True], keys[1:] != keys[:-1]])] >> U64(50)).astype(np.int64)
    return np.bincount(doc, minlength=len(w.first) - 1)


def _repeats(w: Words) -> np.ndarray:
    """Number of words of each text that repeat the word before them."""
    again = np.zeros(len(w.hash), dtype=bool)
    again[1:] = w.hash[1:] == w.hash[:-1]
    again[w.first[:-1][w.counts() > 0]] = False
    return np.diff(np.concatenate([[0], np.cumsum(again)])[w.first]).astype(np.float64)


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts over each whole text: characters, letters, capitals, marks, stops, words, lines and distinct ones."""
    raw, off = utf8(texts)
    words, lines = Words(raw, off, BLANK_SEPARATED), Words(raw, off, _LINES)

    def count(mask):
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[off]).astype(np.float64)

    lead = (raw & 0xC0) != 0x80
    capital = (raw >= 65) & (raw <= 90)
    letter = capital | (raw >= 97) & (raw <= 122) | (raw >= 0xC3) & lead
    return {"chars": count(lead), "letters": count(letter), "capitals": count(capital), "marks": count(_MARKS[raw]),
            "stops": count((raw == 46) | (raw == 33) | (raw == 63)), "words": words.counts().astype(np.float64),
            "own_words": _distinct(words).astype(np.float64), "lines": lines.counts().astype(np.float64),
            "repeats": _repeats(words), "own_lines": _distinct(lines).astype(np.float64)}


#: ASCII characters that ordinary prose hardly uses
_MARKS = np.isin(np.arange(256), [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"])


def _vote(good, bad, short=False) -> np.ndarray:
    return np.where(short, _TOO_SHORT, np.where(bad, _BAD, np.where(good, _GOOD, _SILENT)))


def _few_marks(s):
    return _vote(False, s["marks"] > 0.04 * s["chars"], s["chars"] < 10)


def _few_capitals(s):
    return _vote(False, s["capitals"] > 0.4 * s["letters"], s["letters"] < 10)


def _varied_lines(s):
    return _vote(False, s["own_lines"] < 0.7 * s["lines"], s["lines"] < 4)


def _varied_words(s):
    share = s["own_words"] / np.maximum(s["words"], 1)
    return _vote(share > 0.3, share < 0.15, s["words"] < 20)


def _few_repeats(s):
    return _vote(False, s["repeats"] > 0.2 * s["words"], s["words"] < 5)


def _word_length(s):
    mean = s["letters"] / np.maximum(s["words"], 1)
    return _vote(False, (mean < 2) | (mean > 14), s["words"] == 0)


def _letters(s):
    return _vote(False, s["letters"] < 0.6 * s["chars"], s["words"] < 5)


def _sentences(s):
    pause = s["words"] / np.maximum(s["stops"], 1)
    return _vote((pause >= 2) & (pause <= 40) & (s["stops"] > 0), pause > 120, s["words"] < 8)


def _clean(s):
    return _vote((s["marks"] < 0.01 * s["chars"]) & (s["capitals"] < 0.15 * s["letters"]), False, s["chars"] == 0)


#: the heuristic labellers, in the order of a vote pattern
LABELLERS = (_few_marks, _few_capitals, _varied_lines, _varied_words, _few_repeats, _word_length, _letters,
             _sentences, _clean)


def votes_of(texts: pa.Array) -> np.ndarray:
    """One row of votes per text: 1 good, 0 bad, -1 nothing found, -2 too short to tell."""
    s = statistics(texts)
    return np.stack([f(s) for f in LABELLERS], axis=1).astype(np.int8)


def pattern_counts(docs: DataFrame) -> DataFrame:
    """(votes, n): number of documents with each pattern of votes.  A task sends each pattern once."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            for part in _parts(batch, "text"):
                rows, n = np.unique(votes_of(part.column(0)), axis=0, return_counts=True)
                for r, k in zip(rows, n.tolist()):
                    seen[r.tobytes()] = seen.get(r.tobytes(), 0) + k
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["votes", "n"])

    return map_arrow(docs.select("text"), run, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def _parts(batch, text):
    """Slices of at most 1024 rows: a feature row has ``DIMENSIONS`` numbers."""
    for part in slices(batch, text):
        for at in range(0, part.num_rows, 1024):
            yield part.slice(at, 1024)


class LabelModel:
    """Accuracies of the labellers and the posterior of each vote pattern, by expectation-maximisation."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, rounds: int = 200):
        k = votes.shape[1] if votes.size else 0
        self.share = 0.8
        # chance of each vote (good, bad, silent) on good and on bad documents: to begin with, a bad vote tells most
        self.chance = np.tile(np.array([[0.7, 0.02, 0.28, 1], [0.5, 0.4, 0.1, 1]])[:, None, :], (1, k, 1))
        at = np.where(votes == _GOOD, 0, np.where(votes == _BAD, 1, np.where(votes == _SILENT, 2, 3))) if k else votes
        self.posterior = np.zeros(len(counts))
        total = counts.sum()
        for _ in range(rounds if total else 0):
            logs = [np.log(self.chance[c][np.arange(k), at]).sum(axis=1) for c in (0, 1)]
            odds = np.clip(np.log(self.share / (1 - self.share)) + logs[0] - logs[1], -500, 500)
            self.posterior = 1 / (1 + np.exp(-odds))
            weight = np.stack([counts * self.posterior, counts * (1 - self.posterior)])
            self.share = float(np.clip(weight[0].sum() / total, 0.01, 0.99))
            for c in (0, 1):
                spoke = (weight[c][:, None] * (at < 3)).sum(axis=0)
                for v in range(3):
                    self.chance[c, :, v] = ((weight[c][:, None] * (at == v)).sum(axis=0) + 1) / (spoke + 3)
            # a labeller is better than chance: its bad votes are at least BETTER times as likely on bad documents
            self.chance[1, :, 1] = np.maximum(self.chance[1, :, 1], np.minimum(BETTER * self.chance[0, :, 1], 0.9))
            self.chance[0, :, 0] = np.maximum(self.chance[0, :, 0], self.chance[1, :, 0])
            self.chance[:, :, :3] /= self.chance[:, :, :3].sum(axis=2, keepdims=True)

    def accuracies(self) -> np.ndarray:
        """Per labeller: chance that a vote it gives is right, on good and on bad documents."""
        c = self.chance
        return np.stack([c[0, :, 0] / (c[0, :, 0] + c[0, :, 1]), c[1, :, 1] / (c[1, :, 0] + c[1, :, 1])], axis=1)


def label_model(docs: DataFrame) -> tuple[LabelModel, dict[bytes, float]]:
    """Fit the label model on the counts of all vote patterns; posterior by pattern."""
    rows = sorted((bytes(r["votes"]), r["n"]) for r in pattern_counts(docs).collect())  # at most 4 ** labellers rows
    votes = np.frombuffer(b"".join(v for v, _ in rows), dtype=np.int8).reshape(len(rows), len(LABELLERS))
    model = LabelModel(votes.astype(np.int64), np.array([n for _, n in rows], dtype=np.float64))
    return model, {v: float(p) for (v, _), p in zip(rows, model.posterior)}


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97  # a
_SHAPE[65:91] = 65  # A
_SHAPE[48:58] = 48  # 0
_SHAPE[128:] = 97  # letters beyond ASCII


#: features after the hashed ones: classes of text length and of the share of distinct words
_CLASSES = 8 + 12


def distinct_share(texts: pa.Array) -> np.ndarray:
    """Distinct words against words of each text, by their logarithms; 1 without words."""
    w = Words(*utf8(texts), BLANK_SEPARATED)
    return np.minimum(np.log1p(np.maximum(_distinct(w), 1)) / np.log1p(np.maximum(w.counts(), 1)), 1.0)


def shapes(texts: pa.Array, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Rows of square-rooted shares of hashed character-shape trigrams, and classes of length and repetition."""
    raw, off = utf8(texts)
    n, hashed = len(texts), dimensions - _CLASSES
    out = np.zeros((n, dimensions), dtype=np.float32)
    s = _SHAPE[raw].astype(U64)
    if len(s) > 2:
        gram = mix(s[:-2] | s[1:-1] << U64(8) | s[2:] << U64(16)) % U64(hashed)
        doc = np.repeat(np.arange(n), np.diff(off))
        inside = doc[:-2] == doc[2:]
        cell = doc[:-2][inside] * dimensions + gram[inside].astype(np.int64)
        out += np.bincount(cell, minlength=n * dimensions).reshape(n, dimensions)
    out = np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))
    length = np.minimum(np.log2(np.diff(off) + 1), 15.9)
    out[np.arange(n), hashed + (length // 2).astype(np.int64)] = 1
    out[np.arange(n), hashed + 8 + (distinct_share(texts) * 11.99).astype(np.int64)] = 1
    return out


def train(features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by gradient steps with momentum."""
    labels = labels.astype(np.float32)
    share = np.ones(len(labels)) if weights is None else weights
    share = (share / max(share.sum(), 1e-9)).astype(np.float32)
    w, b = np.zeros(features.shape[1], dtype=np.float32), 0.0
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(epochs):  # float32 throughout: the features are not copied
        p = 1 / (1 + np.exp(-np.clip(features @ w + b, -30, 30)))
        gap = (p - labels) * share
        vw, vb = 0.9 * vw - 1.0 * (gap @ features + np.float32(1e-5) * w), 0.9 * vb - 1.0 * float(gap.sum())
        w, b = w + vw, b + vb
    return w, b


def sample_texts(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, weight): about ``sample`` distinct texts, drawn by a hash, that stand for all rows.

    Rows of equal text count once, with their number as the weight, so the size keeps to the
    bound under any repetition.  Texts that hold ``OFTEN / sample`` of all rows or more (a
    tenth of the sample at most) are always in it; a drawn one stands for those left out.
    """
    n = docs.count()
    key = F.xxhash64(F.coalesce("text", F.lit("")), F.lit(23))
    counts = staged(docs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")), "quality-counts")
    often = F.col("n") * sample >= OFTEN * n
    heavy, light = counts.agg(F.count_if(often), F.count_if(~often)).first()
    rate = min(1.0, max(sample - heavy, 1) / max(light, 1))
    drawn = F.pmod(F.xxhash64("key", F.lit(29)), F.lit(1 << 30)) < int(rate * (1 << 30))
    kept = counts.where(often | drawn).select("key", F.when(often, F.col("n")).otherwise(F.col("n") / rate).cast("double").alias("weight"))
    # 16 bytes a row, about ``sample`` rows; each task keeps one text of a key before the shuffle
    rows = docs.withColumn("key", key).join(F.broadcast(kept), "key")
    return rows.groupBy("key").agg(F.max("weight").alias("weight"), F.min(F.coalesce("text", F.lit(""))).alias("text")).select("text", "weight")


def fit(docs: DataFrame, posterior: dict[bytes, float], sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Train the scorer on about ``sample`` distinct texts (``sample_texts``)."""

    def run(batches):
        xs, ys, ws = [], [], []
        for batch in batches:
            for part in _parts(batch, "text"):
                xs.append(shapes(part.column(0)))
                ys += [posterior[v.tobytes()] for v in votes_of(part.column(0))]
                ws.append(part.column(1).to_numpy())
        w, b = train(np.concatenate(xs), np.array(ys), np.concatenate(ws)) if xs else (np.zeros(DIMENSIONS), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float64())), pa.array([b])], names=["w", "b"])

    # the bounded sample is all that the one training task sees; in one order, so that reruns agree
    rows = staged(sample_texts(docs, sample), "quality-sample").coalesce(1).sortWithinPartitions("text")
    r = map_arrow(rows, run, "w array<double>, b double").first()
    return (np.array(r["w"]), float(r["b"])) if r else (np.zeros(DIMENSIONS), 0.0)


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5,
             sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, score of the scorer, kept (score at least ``threshold``)."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    _, posterior = label_model(d)
    shared = docs.sparkSession.sparkContext.broadcast(fit(d, posterior, sample))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches):
        w, b = shared.value
        for batch in batches:
            for part in _parts(batch, "text"):
                score = 1 / (1 + np.exp(-np.clip(shapes(part.column(1)) @ w + b, -30, 30)))
                score = np.where(np.diff(utf8(part.column(1))[1]) == 0, 0.0, score)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(score >= threshold)],
                                                 names=["doc_id", "score", "kept"])

    return map_arrow(d, run, f"doc_id {kind}, score double, kept boolean")
