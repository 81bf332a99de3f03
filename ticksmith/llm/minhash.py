"""Near-duplicate documents by one-permutation MinHash.

A document's set holds the 64-bit hashes of its distinct five-word shingles
(A-Z lower-cased, words split at white space; with fewer words the whole
sequence is one shingle).  One pass hashes each set into ``BINS`` bins of one
permutation; an empty bin borrows from the first occupied bin of its own
random order (optimal densification).  ``ROWS`` bins make a band, and documents
that agree on a band share a bucket.

* Texts with equal sets form one class; only classes take part further on.
* Each bucket proposes a star: its smallest class against the others.
  Candidates are confirmed on the full sets (100 * common >= 75 * union).
* Where a bucket still spans several components, a second star around a
  centre drawn per bucket is confirmed, and then all members still apart are
  compared block against block inside tasks.  Nothing is capped: a link that
  shares a bucket is either confirmed or already implied by its component.

With 32 bands of 4 rows a pair at similarity 0.75 misses all buckets with
probability 0.684 ** 32, about 5e-6.

Empty or null texts have n_shingles 0 and link with nothing.  Rows with a null
doc_id get a null component and are kept.  Repeated rows of one doc_id are
reported once per row; where they have different texts, each row has the
component of its own text.  Extra columns are ignored by ``near_duplicates``
and kept by ``keep_one_per_group``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import ODD, U64, arrow_schema, components, hashed_words, map_batches, mix64, prepare, raw_texts, shingle_hashes, stored, word_hashes

SHINGLE = 5
BINS = 128
ROWS = 4
BANDS = BINS // ROWS
#: members of a bucket that are compared with each other in one task, and shingles per product
BLOCK = 256
COLUMNS = 8192
SHIFT = U64(64 - 7)  # the top 7 bits name one of 128 bins


def donor_orders() -> np.ndarray:
    """For each bin, its own random order of all bins, itself first."""
    rng = np.random.default_rng(20240817)
    orders = np.argsort(rng.random((BINS, BINS)), axis=1)
    own = np.arange(BINS)[:, None]
    return np.concatenate([own, orders[orders != own].reshape(BINS, BINS - 1)], axis=1)


def signature(shingles: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Densified one-permutation signature of a sorted, non-empty set of hashes."""
    starts = np.searchsorted(shingles, np.arange(BINS, dtype=U64) << SHIFT)
    ends = np.append(starts[1:], len(shingles))
    filled = starts < ends
    if not filled.all():
        donors = orders[np.arange(BINS), filled[orders].argmax(axis=1)]
    else:
        donors = np.arange(BINS)
    return shingles[np.minimum(starts, len(shingles) - 1)][donors]


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=U64) * ODD
    for k in range(ROWS):
        h = mix64(h * ODD + parts[:, k])
    return h.view(np.int64)


def shingle_set(text: bytes | None, memo) -> np.ndarray:
    return np.unique(shingle_hashes(hashed_words(text, memo), SHINGLE))


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, bands, h): node is a digest of the whole set, null when empty; h a hash of the text."""

    def make():
        memo, orders = word_hashes(), donor_orders()

        def step(batch: pa.RecordBatch):
            sizes, nodes, bands = [], [], []
            for text in raw_texts(batch.column(1)):
                s = shingle_set(text, memo)
                sizes.append(len(s))
                nodes.append(digest(s) if len(s) else None)
                bands.append(band_keys(signature(s, orders)) if len(s) else None)
            yield {"doc_id": batch.column(0), "n_shingles": sizes, "node": nodes, "bands": bands, "h": batch.column(2)}

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    return map_batches(rows, make, "doc_id long, n_shingles long, node binary, bands array<bigint>, h long")


def full_sets(docs: DataFrame) -> DataFrame:
    """(node, shingles): the sorted set of hashes as bytes."""

    def make():
        memo = word_hashes()

        def step(batch: pa.RecordBatch):
            sets = [shingle_set(text, memo) for text in raw_texts(batch.column(0))]
            yield {"node": [digest(s) for s in sets], "shingles": [s.tobytes() for s in sets]}

        return step

    return map_batches(docs.select("text"), make, "node binary, shingles binary")


def similar(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, U64), np.frombuffer(b, U64)
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def confirm(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    pairs = edges.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")

    def make():
        def step(batch: pa.RecordBatch):
            cols = [batch.column(k).to_pylist() for k in range(4)]
            hit = [(a, b) for a, b, sa, sb in zip(*cols) if similar(sa, sb, percent)]
            yield {"a": [a for a, _ in hit], "b": [b for _, b in hit]}

        return step

    return map_batches(pairs, make, "a binary, b binary")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, as blocked products over the shingles that both sides hold."""
    sides = [np.concatenate(x) for x in (left, right)]
    held = np.intersect1d(*sides)
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    places = [np.searchsorted(held, s) for s in sides]
    inside = [(p < len(held)) & (held[np.minimum(p, len(held) - 1)] == s) if len(held) else np.zeros(len(s), bool) for p, s in zip(places, sides)]
    counts = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(held), COLUMNS):
        part = []
        for k, x in enumerate((left, right)):
            use = inside[k] & (places[k] >= start) & (places[k] < start + COLUMNS)
            m = np.zeros((len(x), min(COLUMNS, len(held) - start)), np.float32)
            m[rows[k][use], places[k][use] - start] = 1
            part.append(m)
        counts += part[0] @ part[1].T
    return counts


def links_within(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one bucket whose components differ.

    Every pair is compared on the full sets, block against block inside a
    task; a bucket of any size is cut into blocks of ``BLOCK``, and only links
    that join two components leave the task.  Buckets with the same members
    are compared once.
    """
    same = members.groupBy("bucket").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("mark"), F.count("*").alias("size"))
    once = same.groupBy("mark", "size").agg(F.min("bucket").alias("bucket"))
    blocks = members.join(once.select("bucket", "size"), "bucket").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    blocks = blocks.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = blocks.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp").join(sets, "node")
    target = arrow_schema(members.sparkSession, "a binary, b binary")

    def compare(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("own", "node", "comp", "shingles"))))
        side = [[(n, c, np.frombuffer(s, U64)) for o, n, c, s in rows if o == k] for k in (i, j)]
        if not all(side) or len({c for x in side for _, c, _ in x}) < 2:
            return target.empty_table()
        sizes = [np.array([len(s) for *_, s in x]) for x in side]
        common = common_counts(*[[s for *_, s in x] for x in side])
        linked = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common)
        found = []
        group_of: dict[bytes, bytes] = {}

        def root(c):
            while group_of.get(c, c) != c:
                c = group_of[c]
            return c

        for x, y in zip(*np.nonzero(linked)):
            (a, ca, _), (b, cb, _) = side[0][x], side[1][y]
            if (ra := root(ca)) != (rb := root(cb)):
                group_of[max(ra, rb)] = min(ra, rb)
                found.append((a, b))
        return pa.table([[a for a, _ in found], [b for _, b in found]], schema=target)

    return tasks.groupBy("bucket", "i", "j").applyInArrow(compare, "a binary, b binary")


def linked_classes(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures, classes, labels): the rows, the distinct sets, and the component of each linked one."""
    prepare(docs.sparkSession)
    sig = stored(signatures(docs), "minhash-signatures")
    classes = sig.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    members = classes.select("node", "rep", "n", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.count("*").alias("size")).where("size > 1")
    shared = stored(members.join(buckets, "bucket").select("bucket", "node", "rep", "n", "c", "size"), "minhash-buckets")

    def fits(n: str, m: str):
        return F.expr(f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})")

    stars = shared.where(fits("n", "c.n")).where("node <> c.node").select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct()
    wanted = stored(shared.select("rep").where("rep is not null").distinct().withColumnRenamed("rep", "doc_id"), "minhash-candidates")
    sets = stored(full_sets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")).dropDuplicates(["node"]), "minhash-sets")
    links = confirm(stars, sets, percent).checkpoint()
    labels = components(links, "a", "b")

    def apart(frame: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of buckets that span several components, with their component."""
        m = frame.join(labels.withColumnRenamed("component", "label"), frame["node"] == labels["node"], "left").select(frame["*"], F.coalesce("label", frame["node"]).alias("comp"))
        split = m.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
        return m.join(split, "bucket", "left_semi")

    more = apart(shared.where("size > 2"), labels).checkpoint()
    if not more.isEmpty():
        centres = more.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("bucket", "node").alias("h"), "node", "n", "comp")).alias("d"))
        again = more.join(centres, "bucket").where("comp <> d.comp and node <> c.node and d.node <> c.node").where(fits("n", "d.n"))
        again = again.select(F.least("node", "d.node").alias("a"), F.greatest("node", "d.node").alias("b")).distinct()
        links = links.unionByName(confirm(again, sets, percent)).checkpoint()
        labels = components(links, "a", "b")
        rest = apart(more.drop("comp"), labels).select("bucket", "node", "comp").checkpoint()
        last = links_within(rest, sets, percent).checkpoint()
        if not last.isEmpty():
            labels = components(links.unionByName(last), "a", "b")

    return sig, classes, labels


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    sig, classes, labels = linked_classes(docs, percent)
    # the smallest doc_id of each component, over classes and then over their members
    owner = classes.select("node", "rep").join(labels, "node").groupBy("component").agg(F.min("rep").alias("least_id"))
    merged = labels.join(owner, "component").select("node", "least_id")
    ids = classes.select("node", "rep").join(merged, "node", "left").select("node", F.coalesce("least_id", "rep").alias("class_id"))
    out = sig.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_per_group(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row of each group of near copies, of its smallest doc_id; all columns stay.

    Rows are judged one by one, by doc_id and text: an id that occurs with
    several texts loses only those that are copies, and repeated rows stay
    once.  A null doc_id comes after all others.  Texts without words stay.
    """
    sig, _, labels = linked_classes(docs, percent)
    rows = sig.where("node is not null").join(labels, "node", "left").select("doc_id", "h", F.coalesce("component", "node").alias("group"))
    pairs = rows.groupBy("group", "doc_id", "h").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    first = pairs.groupBy("group").agg(F.min(order).alias("first"), F.sum("n").alias("size")).where("size > 1").drop("size")
    judged = stored(pairs.join(first, "group").select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), (order != F.col("first")).alias("__gone"), "n"), "minhash-judged")
    known = docs.withColumns({"__row_id": F.col("doc_id").cast("long"), "__row_h": F.xxhash64("text")})

    def same(marks: DataFrame):
        return known["__row_id"].eqNullSafe(marks["__id"]) & (known["__row_h"] == marks["__h"])

    gone = judged.where("__gone").select("__id", "__h").distinct()
    again = judged.where("not __gone and n > 1").select("__id", "__h")
    left = known.join(gone, same(gone), "left_anti")
    if not again.isEmpty():
        once = left.join(again, same(again), "left_semi").dropDuplicates(["__row_id", "__row_h"])
        left = left.join(again, same(again), "left_anti").unionByName(once)
    return left.drop("__row_id", "__row_h")
