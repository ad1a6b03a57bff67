"""MinHash near-duplicates by an inverted join over signature coordinates.

Each whole text becomes the set of its distinct 5-word shingles and a signature of
``COORDINATES`` minima.  Texts with equal sets form one class and go on as one node.
Nodes are posted under each (coordinate, value) pair.  Two nodes that agree on at least
``MATCHES`` coordinates also agree on one of the rarest ``shared - MATCHES + 1`` shared
coordinates of each (prefix filter over one global order, rarest first), so only those
postings are merged and frequent values (a passage in a third of the texts) are skipped.

Merging never writes out the pairs within a list:

1. each node meets the most central node of each of its lists (the one that shares most
   values overall, such as the original among its edited copies); pairs that agree on
   enough coordinates are confirmed on the full shingle sets, and the links give components;
2. only lists that still hold two or more components are looked at again.  They are cut
   into blocks, and blocks are compared with each other inside tasks: first by signatures
   and sketches, to name the nodes that have a possible partner in another component, and
   then, on the full shingle sets of those nodes alone, to find a link.  A pair is looked
   at in one of the lists it shares, and two components that got linked are not compared
   further, so only links leave a task.

What can be linked is thus linked or already connected; a group of thousands of copies
costs one confirmed pair per node instead of one per pair.

Before a pair is confirmed, a finer sketch (the least shingle of each of 256 ranges of
hashes) has to allow the similarity within 4.75 standard deviations.  A pair of similarity
0.75 agrees on fewer than 21 of 48 coordinates in about 1 of a million cases; that, the
sketch's 1 in a million and equal 50-bit shingle hashes are the only ways a link can be missed
or made.

Defined cases: null texts and texts without words have no shingles, are linked with
nothing and are kept; fewer than five words are one shingle; repeated rows are copies of
each other and each keep their row; null ids take part, and count as no id when the
smallest id of a component is taken; extra columns are ignored (kept by ``deduplicated``); a
very long text is a slice of its own, and its set takes 8 bytes a shingle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shipping import map_arrow, ship
from .tables import staged
from .textarrays import BLANK_SEPARATED, U64, Words, annotate, fresh_name, mix, ngrams, run_starts, slices, utf8

SHINGLE_WORDS = 5
COORDINATES = 48
MATCHES = 21
PERCENT = 75
#: bins of the finer sketch, a byte each
BINS = 256
#: nodes of a posting list compared with each other in one go, and bytes of their sets
BLOCK_NODES = 1024
BLOCK_BYTES = 32 << 20
#: nodes of a longer list are posted anew under their rarest shingles
HOT_NODES = 4096

_DOC_BITS = U64(14)
_MULTIPLIERS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_ADDENDS = mix(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F))

FEATURES = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("set_id", T.BinaryType()),
                         T.StructField("signature", T.BinaryType()), T.StructField("sketch", T.BinaryType())])
SET_ID = T.StructType(FEATURES.fields[:2])


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles (50-bit hashes, ascending) of each text and each text's range."""
    w = Words(*utf8(texts), BLANK_SEPARATED)
    pos, ends = run_starts(w.first, SHINGLE_WORDS)
    shingles = ngrams(w.hash, SHINGLE_WORDS)[pos] >> _DOC_BITS
    doc = np.repeat(np.arange(len(texts)), np.diff(ends))
    counts = w.counts()
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    if len(short):
        whole = np.zeros(len(short), dtype=U64)
        for n in range(1, SHINGLE_WORDS):
            mine = counts[short] == n
            if mine.any():
                whole[mine] = ngrams(w.hash, n)[w.first[:-1][short[mine]]]
        shingles = np.concatenate([shingles, whole >> _DOC_BITS])
        doc = np.concatenate([doc, short])
    keys = np.sort(doc.astype(U64) << (U64(64) - _DOC_BITS) | shingles)
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    owner = (keys >> (U64(64) - _DOC_BITS)).astype(np.int64)
    return keys & U64((1 << 50) - 1), np.searchsorted(owner, np.arange(len(texts) + 1))


def _grouped(texts: pa.Array):
    for at in range(0, len(texts), 1 << int(_DOC_BITS)):
        yield texts.slice(at, 1 << int(_DOC_BITS))


def _features(texts: pa.Array, signed: bool) -> list[pa.Array]:
    shingles, first = shingle_sets(texts)
    n = np.diff(first)
    some = np.flatnonzero(n)
    at = first[:-1][some]
    ids = np.zeros((len(texts), 2), dtype=U64)
    signature = np.zeros((len(texts), COORDINATES), dtype=np.uint32)
    sketch = np.zeros((len(texts), BINS), dtype=np.uint8)
    if len(some):
        for j, salt in enumerate((U64(1), U64(0x5851F42D4C957F2D))):
            ids[some, j] = np.add.reduceat(mix(shingles ^ salt), at) + n[some].astype(U64)
        if signed:
            for j in range(COORDINATES):
                drawn = ((shingles * _MULTIPLIERS[j] + _ADDENDS[j]) >> U64(32)).astype(np.uint32)
                signature[some, j] = np.minimum.reduceat(drawn, at)
            # shingles ascend in each text: the first of a range of hashes is the least
            doc = np.repeat(np.arange(len(texts)), n)
            cell = doc * BINS + (shingles >> U64(42)).astype(np.int64)
            least = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            sketch.reshape(-1)[cell[least]] = (mix(shingles[least]) % U64(255)).astype(np.uint8) + 1

    def binary(rows):
        return pa.array([r.tobytes() if k else None for r, k in zip(rows, n.tolist())], pa.binary())

    return [pa.array(n, pa.int64()), binary(ids), *([binary(signature), binary(sketch)] if signed else [])]


def features(texts: pa.Array) -> list[pa.Array]:
    """Set size, 128-bit set hash, signature and finer sketch of each text."""
    return [pa.concat_arrays(c) for c in zip(*[_features(t, True) for t in _grouped(texts)])]


def set_ids(texts: pa.Array) -> list[pa.Array]:
    return [pa.concat_arrays(c) for c in zip(*[_features(t, False) for t in _grouped(texts)])]


def similar(a: pa.Array, b: pa.Array, percent: int = PERCENT) -> np.ndarray:
    """Whether the full shingle sets of the texts a[i] and b[i] are similar enough."""
    out = np.zeros(len(a), dtype=bool)
    step = (1 << int(_DOC_BITS)) // 2
    for at in range(0, len(a), step):
        x, xf = shingle_sets(a.slice(at, step))
        y, yf = shingle_sets(b.slice(at, step))
        for i in range(len(xf) - 1):
            out[at + i] = is_similar(x[xf[i]:xf[i + 1]], y[yf[i]:yf[i + 1]], percent)
    return out


def _postings(nodes: DataFrame) -> DataFrame:
    """(key, node): the coordinate number and value of each signature coordinate."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
            keys = rows.astype(np.int64) | np.arange(COORDINATES, dtype=np.int64) << 32
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), COORDINATES))],
                names=["key", "node"])

    return map_arrow(nodes.select("node", "signature"), run, "key long, node long")


def likely(sig_a: np.ndarray, sig_b: np.ndarray, fine_a: np.ndarray, fine_b: np.ndarray) -> np.ndarray:
    """Estimated similarity, row by row; 0 where signatures agree too rarely or sketches rule it out."""
    ok = (sig_a == sig_b).sum(axis=-1) >= MATCHES
    filled = np.maximum(((fine_a | fine_b) != 0).sum(axis=-1), 1)
    equal = ((fine_a == fine_b) & (fine_a != 0)).sum(axis=-1)
    p = PERCENT / 100
    return np.where(ok & (equal >= p * filled - 4.75 * np.sqrt(p * (1 - p) * filled)), equal / filled, 0.0)


def is_similar(s: np.ndarray, t: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets (ascending arrays of distinct values) are similar enough."""
    if percent * max(len(s), len(t)) > 100 * min(len(s), len(t)):
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(s) + len(t) - both)


def _rows(column, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, width)


def _agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those whose signatures and sketches agree and whose set sizes allow it."""
    s = nodes.select("node", "n_shingles", "signature", "sketch")
    j = (pairs.join(s.toDF("a", "n_a", "s_a", "f_a"), "a").join(s.toDF("b", "n_b", "s_b", "f_b"), "b")
              .where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ok = likely(*(_rows(part.column(k), np.uint32, COORDINATES) for k in (2, 3)),
                            *(_rows(part.column(k), np.uint8, BINS) for k in (4, 5)))
                yield part.select([0, 1]).filter(pa.array(ok > 0))

    return map_arrow(j.select("a", "b", "s_a", "s_b", "f_a", "f_b"), run, "a long, b long")


def _node_texts(need: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes: a text of the class, looked up by id and set."""
    need = need.join(nodes.select("node", "doc_id", "set_id"), "node")
    rows = docs.join(need.select(F.col("doc_id").alias("wanted")).distinct(),
                     docs["doc_id"].eqNullSafe(F.col("wanted")), "left_semi")
    rows = annotate(rows.select("text"), "text", set_ids, SET_ID, "f")
    return need.select("node", "set_id").join(rows.select(F.col("f")["set_id"].alias("set_id"), "text"), "set_id") \
               .dropDuplicates(["node"]).select("node", "text")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    need = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    texts = staged(_node_texts(need, nodes, docs), "neardup-texts")
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield part.select([0, 1]).filter(pa.array(similar(part.column(2), part.column(3))))

    return map_arrow(both.select("a", "b", "text_a", "text_b"), run, "a long, b long")


def _shingles(texts: DataFrame) -> DataFrame:
    """(node, shingles): the full shingle set of each node as bytes."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                for at in range(0, part.num_rows, 1 << int(_DOC_BITS)):
                    rows = part.slice(at, 1 << int(_DOC_BITS))
                    values, first = shingle_sets(rows.column(1))
                    sets = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                    yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return map_arrow(texts, run, "node long, shingles binary")


class _Group:
    """The nodes of one list in two blocks (or one block with itself)."""

    def __init__(self, table: pa.Table):
        self.node, self.label, self.size, block = (table[c].to_numpy() for c in ("node", "label", "n_shingles", "block"))
        self.signature = _rows(table["signature"], np.uint32, COORDINATES)
        self.sketch = _rows(table["sketch"], np.uint8, BINS)
        self.key, p, q = (table[c][0].as_py() for c in ("key", "p", "q"))
        self.prefix = table["prefix"].to_pylist()
        self.left, self.right, self.same = np.flatnonzero(block == p), np.flatnonzero(block == q), p == q

    def partners(self):
        """(i, r): a node of the left block and its possible partners in other components, likeliest first.

        A pair belongs to the least of the lists that both nodes stand in.
        """
        sets = [set(x) for x in self.prefix]
        for i in self.left:
            r = self.right[self.label[self.right] != self.label[i]]
            if self.same:
                r = r[self.node[r] > self.node[i]]
            r = r[100 * np.minimum(self.size[r], self.size[i]) >= PERCENT * np.maximum(self.size[r], self.size[i])]
            if not len(r):
                continue
            chance = likely(self.signature[r], self.signature[i], self.sketch[r], self.sketch[i])
            r = r[np.argsort(-chance, kind="stable")][:np.count_nonzero(chance)]
            r = [k for k in r.tolist() if min(sets[i] & sets[k]) == self.key]
            if r:
                yield int(i), r


def _possible(table: pa.Table) -> pa.Table:
    """Nodes of a group that have a possible partner."""
    g, named = _Group(table), set()
    for i, r in g.partners():
        named |= {i, *r}
    return table.select(["key", "p", "q", "block", "node", "label"]).take(pa.array(sorted(named), pa.int64()))


def _linked(table: pa.Table) -> pa.Table:
    """Links of a group on full sets, no more than connect its components."""
    g = _Group(table)
    sets = [np.frombuffer(x, dtype=U64) for x in table["shingles"].to_pylist()]
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    pairs = []
    for i, r in g.partners():
        for k in r:
            a, b = find(g.label[i]), find(g.label[k])
            if a != b and is_similar(sets[i], sets[k]):
                root[a] = b
                pairs.append((int(g.node[i]), int(g.node[k])))
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def _shared_lists(prefixes: DataFrame, nodes: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, node, label) of every posting, and (key, n, size) of the lists that hold more than one component."""
    named = prefixes.select("node", F.explode("prefix").alias("key")).join(labels, "node", "left").select(
        "key", "node", F.coalesce("label", "node").alias("label"))
    lists = (named.join(nodes.select("node", "n_shingles"), "node").groupBy("key")
                  .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
                       F.sum("n_shingles").alias("size"))
                  .where(F.col("low") != F.col("high")).select("key", "n", "size"))
    return named, staged(lists, "neardup-lists")


def _in_blocks(named: DataFrame, lists: DataFrame) -> DataFrame:
    """(key, p, q, block, node, label): each node of a list in every pair of blocks that its block is in."""
    n_blocks = F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(8 * F.col("size") / BLOCK_BYTES)).cast("int")
    return (named.join(lists, "key")
                 .withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
                 .select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                         "block", "node", "label"))


def _compared(prefixes: DataFrame, named: DataFrame, lists: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between different components of the given lists."""
    about = nodes.select("node", "n_shingles", "signature", "sketch").join(prefixes.select("node", "prefix"), "node")
    rows = _in_blocks(named, lists)
    ship(rows.sparkSession)
    group = ["key", "p", "q"]
    near = rows.join(about, "node").groupBy(*group).applyInArrow(
        _possible, "key long, p int, q int, block int, node long, label long")
    near = staged(near, "neardup-possible")
    texts = _node_texts(near.select("node").distinct(), nodes, docs)
    full = near.join(about, "node").join(_shingles(texts), "node")
    return full.groupBy(*group).applyInArrow(_linked, "a long, b long")


def _finer(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, prefix): the rarest shingles of each wanted node, by their frequency among those nodes.

    Sets of similarity p share p of the shingles of each, so they share one of the rarest
    n - p * n + 1 of each.  What is common to most wanted nodes (a passage) comes last in that
    order: it is in a prefix only where it makes more than p of a text.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values, off = utf8(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(U64).astype(np.int64)), pa.array(np.repeat(part.column(0).to_numpy(), np.diff(off) // 8))],
                    names=["key", "node"])

    posted = staged(map_arrow(_shingles(_node_texts(wanted, nodes, docs)), run, "key long, node long"), "neardup-shingles")
    often = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    held = posted.join(often, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("e"))
    length = F.size("e") - F.ceil(F.size("e") * PERCENT / 100).cast("int") + 1
    shared = F.filter(F.slice("e", F.lit(1), length), lambda x: x["n"] > 1)
    return held.select("node", shared["key"].alias("prefix")).where(F.size("prefix") > 0)


def _unmet(prefixes: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between different components out of the lists that hold more than one component.

    Nodes of lists longer than ``HOT_NODES`` are posted anew, under their rarest shingles.
    """
    named, lists = _shared_lists(prefixes, nodes, labels)
    found = _compared(prefixes, named, lists.where(F.col("n") <= HOT_NODES), nodes, docs)
    hot = lists.where(F.col("n") > HOT_NODES)
    if hot.isEmpty():
        return found
    wanted = staged(named.join(hot.select("key"), "key", "left_semi").select("node").distinct(), "neardup-hot")
    finer = staged(_finer(wanted, nodes, docs), "neardup-finer")
    return found.unionAll(_compared(finer, *_shared_lists(finer, nodes, labels), nodes, docs))


def node_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of every document row, and one node per distinct shingle set (columns doc_id, text)."""
    rows = annotate(docs, "text", features, FEATURES, "f").select("doc_id", "f.*")
    rows = staged(rows, "neardup-rows")
    nodes = (rows.where(F.col("n_shingles") > 0).groupBy("set_id")
                 .agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"),
                      F.min("signature").alias("signature"), F.min("sketch").alias("sketch"))
                 .select(F.monotonically_increasing_id().alias("node"), "set_id", "doc_id", "n_shingles", "signature", "sketch"))
    return rows, staged(nodes, "neardup-nodes")


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, label): the component of every node linked to another."""
    postings = _postings(nodes)
    lists = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    keys = F.slice("e", F.lit(1), F.size("e") - (MATCHES - 1))["key"]
    prefixes = (postings.join(lists, "key").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("e"))
                .where(F.size("e") >= MATCHES)
                .select("node", F.aggregate("e", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("met"), keys.alias("prefix")))
    prefixes = staged(prefixes, "neardup-prefixes")
    posted = prefixes.select("node", "met", F.explode("prefix").alias("key"))
    centres = posted.groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("centre"))
    stars = (posted.join(centres, "key").where(F.col("node") != F.col("centre"))
             .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    found = staged(_confirmed(staged(_agreeing(stars, nodes), "neardup-pairs"), nodes, docs), "neardup-links")
    labels = components(found)
    more = staged(_unmet(prefixes, nodes, labels, docs), "neardup-links")
    return labels if more.isEmpty() else components(found.unionAll(more))


def _groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Document rows with features, and (set_id, component_id) of every distinct set."""
    rows, nodes = node_table(docs)
    named = nodes.join(links(docs, nodes), "node", "left").select(
        "set_id", "doc_id", F.coalesce("label", "node").alias("label"))
    # one set a component, also where several have the smallest id, or none has an id
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "set_id"))
    least = named.groupBy("label").agg(chosen.alias("least")).select(
        "label", F.col("least")["doc_id"].alias("component_id"), F.col("least")["set_id"].alias("kept_set"))
    return rows, named.join(least, "label").select("set_id", "component_id", (F.col("set_id") == F.col("kept_set")).alias("first"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: set size, component (its smallest id), whether it is kept."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, groups = _groups(d)
    j = rows.select("doc_id", "n_shingles", "set_id").join(groups, "set_id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return j.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group (that of the smallest id, once), with its columns as they were."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    _, groups = _groups(d)
    out, s, i, key = (fresh_name(n, docs.columns) for n in ("__set", "__kept_set", "__kept_id", "__key"))
    keep = groups.where("first").select(F.col("set_id").alias(s), F.col("component_id").alias(i))
    marked = annotate(docs, text, set_ids, SET_ID, out)
    cols = [marked[c] for c in docs.columns]
    bare = marked.where(marked[out]["n_shingles"] == 0).select(*cols)
    kept = marked.join(keep, (marked[out]["set_id"] == F.col(s)) & marked[doc_id].eqNullSafe(F.col(i)), "left_semi")
    one = kept.withColumn(key, F.col(out)["set_id"]).dropDuplicates([key])
    return one.select(*[one[c] for c in docs.columns]).unionAll(bare)
