"""Toxicity by the nearest labelled examples, in exact cosine, by a block-max inverted index.

Examples are a bounded sample of the labelled documents: about ``EXAMPLES`` ids, drawn by a
hash, one text for each (``sample``), and of these no more than make ``EXAMPLE_BYTES`` of
text.  Every word of an example is in the index, and vectors have the norm of the
full text.  A word weighs TF-IDF times how surely it tells the labels apart: the size of its
log odds ratio less ``ERRORS`` standard errors, at least ``FLOOR`` (the same whatever the share
of toxic examples, and for words of either label).  No word is dropped: one that tells
nothing weighs little and still counts in cosines and norms, and words that no example holds
count in the norm of a query as the rarest words do.  (TF-IDF without that factor finds too
little: README.)

The examples are ordered by groups of similar texts, within a group by label, and cut into
blocks of ``BLOCK``.  Postings of a word stand apart for each block, and for each word and block
the index knows the greatest weight, so a query has a bound for every block: the sum of its
weights times those maxima.  It scores its ``FIRST_BLOCKS`` most promising blocks, and then
only the blocks whose bound is not below its k-th best cosine so far; the postings of the
others are skipped.  The few words common in a group have full postings: they are dense rows,
multiplied for all queries at once, and the best such sum of a block replaces their maxima in
its bound.  Sums are float32 with a known rounding error; examples that can be among the
``k`` nearest within that error are computed again in float64, so the ``k`` nearest are exact
(ties: the earlier example).

The neighbours vote with weight 1 / (0.1 + distance), against a prior of the examples
without any word.  Votes of the examples themselves, each left out of its own
vote, are pooled into a non-falling curve that turns votes into probabilities.  Evidence:
the nearest examples, their cosines and labels.

Only the text is an input of a score.  Index and curve are the broadcast part; their size
is bounded by the two parameters of the sample, not by the corpus.

Defined cases: null and empty texts have no word and get the score of such
examples; without labelled rows every score is 0; rows with null label or id teach
nothing, ids labelled twice count with their greatest label; an id with several texts
teaches with one of them; repeated rows each keep their row; an empty table gives no rows; a
very long text is one slice of its own and taken whole; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .language import held_out
from .shipping import map_arrow
from .textarrays import ALPHANUMERIC, U64, Words, member, slices, utf8

EXAMPLES = 8_000
#: bytes of the examples' texts together (the last one may exceed them)
EXAMPLE_BYTES = 64 << 20
#: standard errors that a word's log odds ratio has to exceed to weigh more than the least
ERRORS = 2.0
FLOOR = 0.1
#: groups of similar examples, at least GROUP_EXAMPLES each on average
GROUPS = 8
GROUP_EXAMPLES = 1_024
#: share of the examples from which a word is in the matrix of a group (smaller groups: a greater share)
COMMON = 0.04
NEAREST = 25
PRIOR = 2.0
#: queries searched in one go
QUERIES = 64
#: examples whose greatest weights are known together
BLOCK = 64
#: blocks a query scores before the others are measured against its k-th best
FIRST_BLOCKS = 4


def word_counts(texts: pa.Array, vocabulary: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, word, count), by text and word; words as hashes or places in ``vocabulary``."""
    w = Words(*utf8(texts), ALPHANUMERIC)
    doc = np.repeat(np.arange(len(texts)), w.counts())
    word = w.hash
    if vocabulary is not None:
        word = member(word, vocabulary)
        doc, word = doc[word >= 0], word[word >= 0]
    order = np.lexsort((word, doc))
    doc, word = doc[order], word[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])])) if len(doc) else \
        np.zeros(0, np.int64)
    return doc[new], word[new], np.diff(np.append(new, len(doc)))


def word_labels(examples: DataFrame) -> DataFrame:
    """(word, n, toxic): examples that hold each word, and how many of them are toxic."""

    def run(batches):
        total = np.zeros(0, U64), np.zeros((0, 2))
        for batch in batches:
            for part in slices(batch, "text"):
                doc, word, _ = word_counts(part.column(0))
                toxic = part.column(1).to_numpy(zero_copy_only=False)[doc]
                u, at = np.unique(np.concatenate([total[0], word]), return_inverse=True)
                n = np.zeros((len(u), 2))
                rows = np.concatenate([total[1], np.stack([np.ones(len(doc)), toxic], axis=1)])
                for k in range(2):
                    n[:, k] = np.bincount(at, rows[:, k], minlength=len(u))
                total = u, n
        yield pa.RecordBatch.from_arrays([pa.array(total[0].astype(np.int64)), *(pa.array(total[1][:, k].astype(np.int64)) for k in range(2))],
                                         names=["word", "n", "toxic"])

    found = map_arrow(examples.select("text", F.col("toxic").cast("int").alias("toxic")), run, "word long, n long, toxic long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def telling(n_word: np.ndarray, toxic_word: np.ndarray, n: int, toxic: int) -> np.ndarray:
    """How surely each word tells the labels apart (log odds ratio less its error, at least ``FLOOR``)."""
    a, b = toxic_word + 0.5, n_word - toxic_word + 0.5
    c, d = toxic - toxic_word + 0.5, n - toxic - (n_word - toxic_word) + 0.5
    return np.maximum(np.abs(np.log(a * d / (b * c))) - ERRORS * np.sqrt(1 / a + 1 / b + 1 / c + 1 / d), FLOOR)


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + length[i] - 1 of all i."""
    return np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)


def _error(n):
    """A sum of n products of a cosine is off by n + 4 roundings at most, twice for two of them."""
    return 2 * (n + 8) * 2.0 ** -23


class Index:
    """Block-max inverted index: exact nearest examples by the cosine of their weighted TF-IDF vectors."""

    def __init__(self, words, rows: list, n: int, nearest: int = NEAREST, block: int = BLOCK, weights=None,
                 groups: int | None = None):
        words = np.asarray(words, dtype=np.int64).reshape(-1, 2)
        order = np.argsort(words[:, 0].astype(U64), kind="stable")
        self.vocabulary = words[order, 0].astype(U64)
        df = words[order, 1].astype(np.float64)
        weights = np.ones(len(df)) if weights is None else np.asarray(weights)[order]
        # the last place is that of words no example holds
        self.idf = np.append((np.log(max(n, 1) / np.maximum(df, 1)) + 1) * weights,
                             (np.log(max(n, 1)) + 1) * (weights.min() if len(weights) else 1.0))
        self.k, self.block = nearest, block
        rows = sorted(rows, key=lambda r: r["doc_id"])
        filled = [r for r in rows if len(r["words"])]
        self.ids = [r["doc_id"] for r in filled]
        self.labels = np.array([r["toxic"] for r in filled], dtype=np.float64)
        bare = [r["toxic"] for r in rows if not len(r["words"])]
        whole = [r["toxic"] for r in rows]
        base = sum(whole) / len(whole) if whole else 0.0
        self.prior = (sum(bare) + base) / (len(bare) + 1) if rows else 0.0
        self.first = np.concatenate([[0], np.cumsum([len(r["words"]) for r in filled])]).astype(np.int64)
        self.words, self.counts = (np.concatenate([np.asarray(r[c], dtype=np.int32) for r in filled] or [np.zeros(0, np.int32)])
                                   for c in ("words", "counts"))
        self.groups = max(1, min(GROUPS, len(filled) // GROUP_EXAMPLES)) if groups is None else groups
        self.curve: tuple[np.ndarray, np.ndarray] | None = None
        self.shared = self.weights = None
        self.scored = self.wanted = 0  # blocks scored, and blocks of all queries

    def __getstate__(self):
        """Words and counts of the examples; the rest is made of them where it is used."""
        kept = ("vocabulary", "idf", "k", "block", "ids", "labels", "prior", "first", "words", "counts", "groups")
        return {k: self.__dict__[k] for k in kept} | {"curve": None, "shared": None, "weights": None, "scored": 0, "wanted": 0}

    def arranged(self) -> Index:
        """Order the examples, cut them into blocks, and post their words by block with the greatest weights."""
        if self.weights is not None:
            return self
        m, v, groups = len(self.ids), len(self.vocabulary), self.groups
        owner = np.repeat(np.arange(m), np.diff(self.first))
        x = (1 + np.log(self.counts)) * self.idf[self.words]
        weights = x / np.sqrt(np.bincount(owner, x * x, minlength=m))[owner]
        group = self._groups(owner, groups)
        self.order = np.lexsort((np.arange(m), self.labels, group))  # place in the order -> example
        place = np.empty(m, dtype=np.int64)
        place[self.order] = np.arange(m)
        bounds = np.searchsorted(group[self.order], np.arange(groups + 1))
        # no block crosses a group
        edges = [np.arange(low, high, self.block) for low, high in zip(bounds[:-1], bounds[1:])]
        self.edges = np.append(np.concatenate(edges), m).astype(np.int64)
        block_of = np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))
        self.dense, posted = [], np.ones(len(owner), dtype=bool)
        for g in range(groups):
            low, high = int(bounds[g]), int(bounds[g + 1])
            if low == high:
                continue
            mine = np.flatnonzero(group[owner] == g)
            common = np.flatnonzero(np.bincount(self.words[mine], minlength=v) >= max(COMMON * np.sqrt(m * (high - low)), 1))
            column = np.full(v, -1, dtype=np.int32)
            column[common] = np.arange(len(common))
            mine = mine[column[self.words[mine]] >= 0]
            matrix = np.zeros((len(common), high - low), dtype=np.float32)
            matrix[column[self.words[mine]], place[owner[mine]] - low] = weights[mine]
            posted[mine] = False
            self.dense.append((low, high, column, matrix))
        rest = np.flatnonzero(posted)
        rest = rest[np.lexsort((place[owner[rest]], self.words[rest]))]
        self.posted = place[owner[rest]].astype(np.int32)
        self.posted_weights = weights[rest].astype(np.float32)
        # one entry for each word and block: where its postings are, and the greatest weight among them
        word, block = self.words[rest], block_of[self.posted]
        new = np.ones(len(rest), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (block[1:] != block[:-1])
        self.entry_start = np.append(np.flatnonzero(new), len(rest))
        self.entry_block = block[new].astype(np.int32)
        self.entry_most = np.maximum.reduceat(self.posted_weights, self.entry_start[:-1]) if len(rest) else np.zeros(0, np.float32)
        self.entries = np.searchsorted(word[new], np.arange(v + 1))
        # whether the query at hand holds each word, and where
        self.held, self.at = np.zeros(v, dtype=bool), np.zeros(v, dtype=np.int32)
        self.weights = weights
        return self

    def _groups(self, owner: np.ndarray, groups: int) -> np.ndarray:
        """A group number for each example, by a few rounds of means over the most frequent words."""
        m = len(self.ids)
        if groups < 2 or m < groups:
            return np.zeros(m, dtype=np.int64)
        often = np.argsort(-np.bincount(self.words, minlength=len(self.vocabulary)), kind="stable")[:512]
        column = np.full(len(self.vocabulary), -1)
        column[often] = np.arange(len(often))
        mine = np.flatnonzero(column[self.words] >= 0)
        seen = np.zeros((m, len(often)), dtype=np.float32)
        seen[owner[mine], column[self.words[mine]]] = 1
        seen /= np.maximum(np.sqrt(seen.sum(axis=1, keepdims=True)), 1)
        means = seen[np.linspace(0, m - 1, groups).astype(np.int64)]
        for _ in range(10):
            means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9)
            likeness = seen @ means.T
            group = np.argmax(likeness, axis=1)
            # a group that lost all its texts starts again from the text that is least like its own group
            lonely = iter(np.argsort(likeness.max(axis=1), kind="stable"))
            means = np.stack([seen[group == g].mean(axis=0) if (group == g).any() else seen[next(lonely)] for g in range(groups)])
        return group

    def vector(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known words and their weights, normalised over all words (-1: one that no example holds)."""
        x = (1 + np.log(counts)) * self.idf[words]
        x = x / np.sqrt((x * x).sum())
        return words[words >= 0], x[words >= 0]

    def nearest(self, words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of greatest cosine (exact; ties: the earlier one) among those that share a word."""
        return self.nearest_of([self.vector(words, counts)], k)[0]

    def nearest_of(self, queries: list, k: int) -> list:
        """``nearest`` of each query vector."""
        self.arranged()
        out = []
        for at in range(0, len(queries), QUERIES):
            part = queries[at:at + QUERIES]
            for (words, q), rough, least in zip(part, *self._rough(part, k)):
                out.append(self._exact(words, q, rough, least, k))
        return out

    def _rough(self, queries: list, k: int) -> tuple[np.ndarray, np.ndarray]:
        """float32 cosines of each query with the examples (by place) of the blocks that can hold a neighbour
        (less of it elsewhere), and a cosine that its k-th neighbour has at least."""
        words = np.concatenate([w for w, _ in queries])
        q = np.concatenate([x for _, x in queries]).astype(np.float32)
        n, m, blocks = len(queries), len(self.ids), len(self.edges) - 1
        sizes = np.array([len(w) for w, _ in queries])
        query = np.repeat(np.arange(n), sizes)
        sums = np.zeros((n, m), dtype=np.float32)
        for low, high, column, matrix in self.dense:
            at = column[words]
            some = at >= 0
            mine = np.zeros((n, len(matrix)), dtype=np.float32)
            mine[query[some], at[some]] = q[some]
            sums[:, low:high] = mine @ matrix
        # entries of the queries' words, and the bound of each block: its best sum so far and the greatest weights
        number = self.entries[words + 1] - self.entries[words]
        entry = _ranges(self.entries[words], number)
        of, x = np.repeat(query, number), np.repeat(q, number)
        key = of * blocks + self.entry_block[entry]
        bound = np.bincount(key, x * self.entry_most[entry], minlength=n * blocks).astype(np.float64).reshape(n, blocks)
        bound += np.maximum.reduceat(sums, self.edges[:-1], axis=1)

        def score(wanted):
            use = np.flatnonzero(wanted.ravel()[key])
            start = self.entry_start[entry[use]]
            length = self.entry_start[entry[use] + 1] - start
            at = _ranges(start, length)
            products = self.posted_weights[at] * np.repeat(x[use], length)
            sums.ravel()[:] += np.bincount(np.repeat(of[use] * m, length) + self.posted[at], products, minlength=n * m)

        k_blocks = min(FIRST_BLOCKS, blocks)
        best = np.argpartition(-bound, k_blocks - 1, axis=1)[:, :k_blocks]
        first = np.zeros((n, blocks), dtype=bool)
        np.put_along_axis(first, best, True, axis=1)
        score(first)
        # the k-th best of the first blocks
        place = self.edges[best][:, :, None] + np.arange(self.block)
        inside = place < self.edges[best + 1][:, :, None]
        seen = np.where(inside, np.take_along_axis(sums, np.minimum(place, m - 1).reshape(n, -1), axis=1).reshape(place.shape), 0).reshape(n, -1)
        least = np.partition(seen, seen.shape[1] - k, axis=1)[:, seen.shape[1] - k] if seen.shape[1] >= k else np.zeros(n)
        # room for the roundings of a bound and of the cosines it is measured against
        more = (bound >= (least - _error(sizes) - 1e-6 * least)[:, None]) & (bound > 0) & ~first
        score(more)
        self.scored += int(first.sum() + more.sum())
        self.wanted += n * blocks
        return sums, least

    def _exact(self, words: np.ndarray, q: np.ndarray, rough: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        error = _error(len(words))
        found = np.flatnonzero(rough >= max(least - error, 1e-30))
        if len(found) > k:
            near = rough[found]
            found = found[near >= np.partition(near, len(near) - k)[len(near) - k] - error]
        found = np.sort(self.order[found])
        if not len(found):
            return np.zeros(0, np.int64), np.zeros(0)
        length = self.first[found + 1] - self.first[found]
        at = _ranges(self.first[found], length)
        held, place = self.held, self.at
        held[words], place[words] = True, np.arange(len(words))
        at_word = self.words[at]
        both = np.flatnonzero(held[at_word])
        held[words] = False
        owner = np.repeat(np.arange(len(found)), length)[both]
        cosines = np.bincount(owner, q[place[at_word[both]]] * self.weights[at[both]], minlength=len(found))
        order = np.lexsort((found, -np.round(cosines, 12)))[:k]
        return found[order], np.minimum(cosines[order], 1.0)

    def vote(self, best: np.ndarray, cosines: np.ndarray) -> float:
        w = 1 / (0.1 + (1 - cosines))
        prior = PRIOR * 1 / (0.1 + 1)
        return float(((w * self.labels[best]).sum() + prior * self.prior) / (w.sum() + prior))

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Pool the votes of left-out examples into a non-falling curve vote -> share of toxic ones."""
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []
        for group in np.array_split(order, max(1, min(100, len(order) // 20))):
            if len(group):
                pools.append([votes[group].sum(), labels[group].sum(), len(group)])
                while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
                    last = pools.pop()
                    pools[-1] = [a + b for a, b in zip(pools[-1], last)]
        if len(pools) > 1:
            self.curve = (np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools]))

    def score(self, vote: float, curve) -> float:
        """The curve's probability, half and half with the vote it corrects."""
        return vote if curve is None else float(0.5 * vote + 0.5 * np.interp(vote, *curve))

    def left_out_votes(self, examples: list[int]) -> list[float]:
        self.arranged()
        at = [slice(self.first[e], self.first[e + 1]) for e in examples]
        out = []
        for e, (best, cosines) in zip(examples, self.nearest_of([(self.words[s].astype(np.int64), self.weights[s]) for s in at], self.k + 1)):
            other = best != e
            out.append(self.vote(best[other][:self.k], cosines[other][:self.k]))
        return out

    def broadcast(self, spark):
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast(self)
        return self.shared


def sample(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """About ``examples`` labelled rows (doc_id, text, toxic): ids drawn by a hash, one text for each id.

    The rows stay near the bound however often an id is repeated: each task keeps one text of an id
    before anything is shuffled.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > examples:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < int(examples / n * (1 << 30)))
    # 16 bytes a row, about EXAMPLES rows at most
    rows = docs.join(F.broadcast(known), "doc_id")
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))


def within_bytes(rows: DataFrame, most: int = EXAMPLE_BYTES) -> DataFrame:
    """The examples, in the order of a hash of their id, until their texts hold ``most`` bytes together.

    Ids and sizes of the bounded sample are summed up in one task; texts stay where they are.
    """
    sizes = rows.select("doc_id", F.octet_length("text").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    kept = sizes.withColumn("before", before).where(F.coalesce("before", F.lit(0)) < most).select("doc_id")
    return rows.join(F.broadcast(kept), "doc_id", "left_semi")


def learn(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, nearest: int = NEAREST) -> Index:
    """Words, index and curve from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    from .tables import staged

    spark = docs.sparkSession
    rows = within_bytes(staged(sample(docs, labels, examples), "toxicity-examples"))
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    # words of a bounded sample: 24 bytes a word
    found = word_labels(rows).toArrow()
    word, n_word, toxic_word = (found.column(k).to_numpy() for k in range(3))
    places = spark.sparkContext.broadcast(np.sort(word.astype(U64)))

    def vectors(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                doc, word, count = word_counts(part.column(1), places.value)
                first = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     *(pa.array([x[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())
                       for x in (word, count))], names=["doc_id", "toxic", "words", "counts"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = map_arrow(rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")), vectors,
                     f"doc_id {kind}, toxic int, words binary, counts binary").collect()
    made = [{"doc_id": r["doc_id"], "toxic": r["toxic"], "words": np.frombuffer(r["words"], np.int32),
             "counts": np.frombuffer(r["counts"], np.int32)} for r in made]
    index = Index(np.stack([word, n_word], axis=1), made, n, nearest, weights=telling(n_word, toxic_word, n, toxic))
    if index.ids:
        shared = index.broadcast(spark)

        def left_out(batches):
            for batch in batches:
                at = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.left_out_votes(at), pa.float64())], names=["e", "vote"])

        numbers = spark.range(0, len(index.ids), 1, spark.sparkContext.defaultParallelism)
        votes = sorted(map_arrow(numbers, left_out, "e long, vote double").collect())
        index.calibrate(np.array([r["vote"] for r in votes]), index.labels)
    return index


def predict(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, score, evidence (nearest examples: id, cosine, label)."""
    shared, curve = index.broadcast(docs.sparkSession), index.curve
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = pa.struct([("doc_id", pa.from_numpy_dtype(np.int64)), ("cosine", pa.float64()), ("toxic", pa.int32())])

    def run(batches):
        ix = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                doc, word, count = word_counts(part.column(1))
                word = member(word, ix.vocabulary)
                first = np.searchsorted(doc, np.arange(part.num_rows + 1))
                scores, evidence = np.full(part.num_rows, ix.prior), [[] for _ in range(part.num_rows)]
                some = np.flatnonzero(np.diff(first)) if ix.ids else []
                queries = [ix.vector(word[first[i]:first[i + 1]], count[first[i]:first[i + 1]]) for i in some]
                for i, (best, cosines) in zip(some, ix.nearest_of(queries, ix.k)):
                    if len(best):
                        scores[i] = ix.score(ix.vote(best, cosines), curve)
                    evidence[i] = [{"doc_id": ix.ids[e], "cosine": float(c), "toxic": int(ix.labels[e])}
                                   for e, c in zip(best[:5].tolist(), cosines)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(evidence, pa.list_(item))],
                                                 names=["doc_id", "score", "evidence"])

    return map_arrow(docs, run, f"doc_id {kind}, score double, evidence array<struct<doc_id:bigint,cosine:double,toxic:int>>")


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
          **options) -> DataFrame:
    """Learn from the labels that are not held out; score every document."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.where(~held_out(F.col(doc_id))).select(F.col(doc_id).alias("doc_id"), F.col(toxic).alias("toxic"))
    p = predict(d, learn(d, known, **options))
    return p.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
